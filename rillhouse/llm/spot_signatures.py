"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

Everything is DataFrame functions. A text is lower-cased, its words joined by single spaces and
split at runs of anchors; the three content words from each place after an anchor on, later
anchors left out, are hashed to one signature. A fingerprint is the set of a text's signatures.
Texts without a word after an anchor take chains from every word, so only wordless texts have no signature.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.llm.common import stored

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has have he in is it its not of on or she that the this to was were "
    "which will with der die das den dem des ein eine und ist im mit von zu auf für nicht sich auch als wie "
    "le la les un une du et est en dans par pour que qui sur au aux pas avec el los las del al es lo se su "
    "una y con como más para"
).split()
CHAIN = 3
SIMILARITY = Fraction(4, 5)


def normal_words(text: Column) -> Column:
    """Lower-cased words of letters and digits, joined by single spaces, with a space at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def with_signatures(df: DataFrame, text: str, into: str) -> DataFrame:
    """`df` with the sorted distinct 32-bit signatures of a text column as an array column."""
    anchors = "|".join(sorted(set(ANCHORS)))
    normal, spans, words = f"{into}_normal", f"{into}_spans", f"{into}_words"
    cut = df.withColumn(normal, normal_words(F.col(text)))
    # One anchor a match: a repeated group would recurse as deep as a text repeats a word.
    pieces = F.split(normal, f"(?<= )(?:{anchors}) ", -1)
    cut = cut.withColumn(spans, F.filter(pieces, lambda s, i: (i == 0) | (s != "")))
    n = F.size(spans)

    def joined(i: Column) -> Column:
        # Three spans after an anchor hold three content words, unless the text ends.
        following = F.concat_ws("", *[F.get(spans, i + j) for j in range(CHAIN)])
        return F.hash(F.substring_index(F.trim(following), " ", CHAIN))

    def chained(i: Column) -> Column:
        return F.hash(F.array_join(F.slice(words, i, CHAIN), " "))

    # Without a word after an anchor, every word starts a chain.
    cut = cut.withColumn(words, F.when(n == 1, F.filter(F.split(normal, " "), lambda w: w != "")))
    last = F.greatest(F.size(words) - (CHAIN - 1), F.lit(1))
    plain = F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(1), last), chained)).otherwise(F.array().cast("array<int>"))
    anchored = F.transform(F.sequence(F.lit(1), n - 1), joined)
    signatures = F.array_sort(F.array_distinct(F.when(n == 1, plain).otherwise(anchored)))
    return cut.withColumn(into, signatures).drop(normal, spans, words)


def likeness(one: str, two: str) -> Column:
    """Jaccard similarity of two signature arrays; two empty ones are equal."""
    shared = F.size(F.array_intersect(one, two))
    union = F.size(one) + F.size(two) - shared
    return F.when(union == 0, 1.0).otherwise(shared / union).cast("double")


def text_form(signatures: str) -> Column:
    """A fingerprint as text: its signatures in hexadecimal digits, in order."""
    return F.array_join(F.transform(signatures, lambda s: F.substring(F.hex(F.lit(1 << 32) + s.cast("bigint")), -8, 8)), "")


def length_partitions(similarity: Fraction, longest: int) -> list[int]:
    """Lower bounds of set lengths such that similar sets lie in one partition or in neighbours."""
    bounds = [1]
    while bounds[-1] <= longest:
        bounds.append(int(bounds[-1] / similarity) + 1)
    return bounds


def near_pairs(prints: DataFrame, similarity: Fraction = SIMILARITY) -> DataFrame:
    """`a, b, jaccard` of every pair of different fingerprints that reaches the similarity.

    `prints` has `key` (one per fingerprint) and `signatures`. Sets are partitioned by length;
    within a partition and its neighbour, only the rarest signatures of each set are indexed, as
    many as a similar set cannot all miss, and the lengths prune pairs before any set is compared.
    """
    p, q = similarity.numerator, similarity.denominator
    prints = prints.where(F.size("signatures") > 0).select("key", "signatures", F.size("signatures").alias("n"))
    flat = prints.select("key", "n", F.explode("signatures").alias("signature"))
    counts = flat.groupBy("signature").agg(F.count("*").alias("seen"))
    order = Window.partitionBy("key").orderBy("seen", "signature")
    ranked = flat.join(counts, "signature").withColumn("rank", F.row_number().over(order))
    # A similar set shares at least ceil(n * p / q) signatures, so one of the first n - that + 1.
    rare = ranked.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * p / q) + 1)
    longest = prints.agg(F.max("n")).first()[0] or 1
    bounds = F.array(*[F.lit(b) for b in length_partitions(similarity, longest)])
    band = F.size(F.filter(bounds, lambda b: b <= F.col("n")))
    rare = stored(rare.select("key", "n", "rank", "signature", band.alias("band")), "rare-signatures")
    one, two = rare.alias("one"), rare.withColumn("band", F.explode(F.array("band", F.col("band") - 1))).alias("two")
    pairs = one.join(
        two,
        (F.col("one.signature") == F.col("two.signature"))
        & (F.col("one.band") == F.col("two.band"))
        & ((F.col("one.n") < F.col("two.n")) | (F.col("one.n") == F.col("two.n")) & (F.col("one.key") < F.col("two.key")))
        & (F.col("one.n") * q >= F.col("two.n") * p)
        # Positions: what is left of both sets after this signature must still be enough.
        & ((F.least(F.col("one.n") - F.col("one.rank"), F.col("two.n") - F.col("two.rank")) + F.least("one.rank", "two.rank")) * (p + q)
           >= (F.col("one.n") + F.col("two.n")) * p),
    ).select(F.col("one.key").alias("a"), F.col("two.key").alias("b")).distinct()
    left = prints.select(F.col("key").alias("a"), F.col("signatures").alias("left_set"))
    right = prints.select(F.col("key").alias("b"), F.col("signatures").alias("right_set"))
    near = pairs.join(left, "a").join(right, "b").withColumn("jaccard", likeness("left_set", "right_set"))
    return near.where(F.col("jaccard") >= p / q).select("a", "b", "jaccard")


def successors(docs: DataFrame) -> DataFrame:
    """`doc_id, n_chars, next_id` of every id: the next one in ascending order, the first after the last.

    Ids alone are dealt by ranges; only the first and last id of each range meet in one task.
    """
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.length(F.coalesce("text", F.lit("")))).alias("n_chars"))
    ranged = ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    firsts = ranged.groupBy("part").agg(F.min("doc_id").alias("first"))
    whole = Window.orderBy("part")
    lowest = F.min("first").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("part", F.coalesce(F.lead("first").over(whole), lowest).alias("beyond"))
    within = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    linked = ranged.withColumn("next_id", within).join(firsts, "part")
    return linked.select("doc_id", "n_chars", F.coalesce("next_id", "beyond").alias("next_id"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per id: `doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_signatures`.

    The edited text is the first part of a text, then the first `floor(n_chars / 2)` code points
    of the next document, or all of its if it has fewer. A null text is empty. Rows that repeat an
    id with the same text give one row each per row of the next id; rows without an id have no
    place in the order and are left out. A single document is its own successor.
    """
    texts = docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = stored(successors(docs), "successors")
    before = order.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("before_id"), F.expr("n_chars div 2").cast("int").alias("take"))
    # Each document hands its beginning and its fingerprint to the one before it.
    own = with_signatures(texts, "text", "signatures")
    heads = own.join(before, "doc_id").select(
        F.col("before_id").alias("doc_id"), F.expr("substring(text, 1, take)").alias("head"), F.col("signatures").alias("next_signatures")
    )
    both = own.join(heads, "doc_id")
    n = F.length("text")
    edited = F.concat(F.expr("substring(text, 1, length(text) - length(text) div 2)"), F.col("head"))
    both = both.select("doc_id", n.cast("bigint").alias("n_chars"), "signatures", "next_signatures", edited.alias("edited"))
    both = with_signatures(both, "edited", "edited_signatures")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        text_form("signatures").alias("fingerprint"),
        text_form("edited_signatures").alias("edited_fingerprint"),
        likeness("signatures", "edited_signatures").alias("near_edited"),
        likeness("signatures", "next_signatures").alias("near_next"),
        F.size("signatures").cast("bigint").alias("n_signatures"),
    )
