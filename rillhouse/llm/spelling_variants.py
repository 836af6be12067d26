"""Spelling variants by permuterm rotations: words that differ by one character share a rotation.

A word is closed with a terminator, and at each of its characters the rotation that ends with this
character is taken: `rest` is what stands before it, round the terminator. Words that differ in
that character alone have the same `rest`; a word that lacks it has `rest` as a whole rotation of
its own. Sorted, such rows stand together, so one scan of each group sees every neighbour. A group
holds one word per character that can be put in at one place, so the alphabet bounds it.

A character that is doubled can be taken away at two places with the same result; only the last
of equal neighbours counts as an insertion, so each pair of words meets in exactly one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.llm.common import stored

#: The letters of a word after lower-casing, the places that lose a character, the end of a word.
LETTERS = "[A-Za-zÀ-ÿ]+"
DAMAGED = 97
END = "$"
LEAST_CHARS, LEAST_COUNT, RATIO = 5, 3, 2
#: Longer rotations are held by their digest, as all rotations of a word have its length.
LONG = 64


def lowered(run: Column) -> Column:
    """A-Z in lower case and nothing else; an all-ASCII run has as many bytes as characters."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(run) == F.octet_length(run), F.lower(run)).otherwise(F.translate(run, upper, upper.lower()))


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """`word, n` of the words of all texts, after the hashed runs have lost a character.

    A null text has no words, a null id counts as an empty one, repeated rows count as often as
    they stand. Words are counted in the map task before they are shuffled.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", lowered(F.col("run")).alias("run"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    h = F.crc32(name.cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.select(F.when(h % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """`rest, word, n, whole, inserts`: the rotations of every word.

    `whole` rows stand for the word itself, as it is rotated around each gap; the others lack the
    character after the gap, and `inserts` says whether taking it away is the one way to count.
    """
    gaps = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("gap"))
    head, tail = F.substring(F.col("word"), F.lit(1), F.col("gap")), lambda skip: F.substring(F.col("word"), F.col("gap") + 1 + skip, F.length("word"))
    at = lambda place: F.substring(F.col("word"), place, F.lit(1))
    rest = lambda skip: F.concat(tail(skip), F.lit(END), head)
    both = gaps.select(
        "word", "n",
        F.explode(F.array(
            F.struct(rest(0).alias("rest"), F.lit(True).alias("whole"), F.lit(False).alias("inserts")),
            F.when(
                F.col("gap") < F.length("word"),
                F.struct(rest(1).alias("rest"), F.lit(False).alias("whole"), (at(F.col("gap") + 1) != at(F.col("gap") + 2)).alias("inserts")),
            ),
        )).alias("r"),
    ).where("r is not null")
    key = F.when(F.length("r.rest") <= LONG, F.col("r.rest")).otherwise(F.sha2(F.col("r.rest").cast("binary"), 256))
    return both.select(key.alias("rest"), "word", "n", "r.whole", "r.inserts")


def scanned(words: DataFrame) -> DataFrame:
    """`word, n_near, best` for each word and each of its groups with a neighbour.

    `best` is `(-n, word)` of the neighbour that comes first by falling count, then by code points.
    No pair is written: counts and the first two rows of a group answer for all its members.
    """
    rows = rotations(words).withColumn("order", F.struct((-F.col("n")).alias("fewer"), F.col("word").alias("name")))
    group, kind = Window.partitionBy("rest"), Window.partitionBy("rest", "whole").orderBy("order")
    lacking = ~F.col("whole")
    seen = rows.select(
        "word", "whole", "inserts",
        F.count("*").over(group).alias("size"),
        F.count(F.when(lacking, 1)).over(group).alias("others"),
        F.count(F.when(F.col("inserts"), 1)).over(group).alias("longer"),
        F.min(F.when(F.col("whole"), F.col("order"))).over(group).alias("shorter"),
        F.min(F.when(F.col("inserts"), F.col("order"))).over(group).alias("best_longer"),
        F.first("order").over(kind).alias("first"),
        F.lead("order").over(kind).alias("second"),
        F.row_number().over(kind).alias("rank"),
    ).where("size > 1")
    below = F.when(F.col("inserts"), F.col("shorter"))
    peer = F.when(F.col("rank") > 1, F.col("first")).otherwise(F.col("second"))
    n_near = F.when(F.col("whole"), F.col("longer")).otherwise(F.col("others") - 1 + F.when(below.isNotNull(), 1).otherwise(0))
    best = F.when(F.col("whole"), F.col("best_longer")).otherwise(F.least(peer, below))
    return seen.select("word", n_near.alias("n_near"), best.alias("best")).where("n_near > 0")


def near_words(words: DataFrame) -> DataFrame:
    """`word, near` of every ordered pair of distinct words that are one character apart; `words` has `word, n`."""
    rows = rotations(words)
    one, two = rows.alias("one"), rows.alias("two")
    near = (F.col("one.whole") & F.col("two.inserts")) | (F.col("two.whole") & F.col("one.inserts")) | (~F.col("one.whole") & ~F.col("two.whole"))
    met = one.join(two, (F.col("one.rest") == F.col("two.rest")) & (F.col("one.word") != F.col("two.word")) & near)
    return met.select(F.col("one.word").alias("word"), F.col("two.word").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """`word, root` of words with a `form`: forms are followed to the last, twice as far each round.

    A form is at least twice as frequent, so a chain is short and never closes.
    """
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if found.join(further, "root", "left_semi").isEmpty():
            return found
        moved = found.join(further, "root", "left")
        found = stored(moved.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per word: `word, form, root, n, n_near, form_n`.

    The form is the most frequent of the words one character apart, the first by code points of
    equals, if it is at least `ratio` (2 or more) times as frequent. `docs` needs `doc_id` and `text`; other
    columns are ignored, and no row, text or word gives an empty result.
    """
    counts = stored(word_counts(docs, least_chars, least_count), "words")
    alone = counts.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("struct<fewer:bigint,name:string>").alias("best"))
    met = scanned(counts).select("word", F.lit(None).cast("bigint").alias("n"), "n_near", "best")
    near = alone.unionAll(met).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    takes = -F.col("best.fewer") >= ratio * F.col("n")
    near = near.select(
        "word", "n", "n_near", F.when(takes, F.col("best.name")).alias("form"), F.when(takes, -F.col("best.fewer")).alias("form_n")
    )
    near = stored(near, "forms")
    last = roots(near.where("form is not null"))
    return near.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
