"""Benchmark decontamination with a distributed positional inverted index.

The index stores, for each training token that can take part in a match, its term, document and
position. A match is a run of neighbouring test terms, so tokens outside such runs are not stored.
Matching starts from the rarest term of each test window: its postings give the diagonals
(document, item, document position minus item position). The other terms' lists, offset to the
same diagonal, are then intersected with them, and runs of hits become matches. With `slack`, a
term may stand that many words off the diagonal, which gives proximity matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.llm.common import alnum_words, small_batches, stored

WINDOW = 10
#: Bound of the distinct test terms, which are broadcast; a larger test set must be given in parts.
MAX_TERMS = 2_000_000


def _item_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for item, text in zip(frame["item_id"], frame["text"]):
            words = alnum_words(text or "")
            rows += [(item, len(words), at, word) for at, word in enumerate(words)]
        yield pd.DataFrame(rows, columns=["item_id", "n_item", "off", "word"]).astype({"item_id": "int64", "n_item": "int32", "off": "int32"})


def item_terms(benchmark: DataFrame) -> DataFrame:
    """`item_id, n_item, off, word` of every word of every item; repeated rows and null ids go."""
    rows = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    return rows.mapInPandas(_item_words, "item_id bigint, n_item int, off int, word binary")


def _kept(known: np.ndarray, span: int) -> np.ndarray:
    """Whether each position lies in a run of at least `span` known terms."""
    edge = np.diff(np.concatenate(([0], known.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = np.zeros(len(known) + 1, np.int64)
    long = ends - starts >= span
    np.add.at(out, starts[long], 1)
    np.add.at(out, ends[long], -1)
    return np.cumsum(out[:-1]) > 0


def _postings(frames: Iterator[pd.DataFrame], terms: dict[bytes, int], short: set[int], span: int, least: int, slack: int) -> Iterator[pd.DataFrame]:
    get = terms.get
    for frame in frames:
        rows = []
        for row, doc_id, text in zip(frame["row"], frame["doc_id"], frame["text"]):
            words = alnum_words(text or "")
            ids = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
            known = ids >= 0
            keep = known if slack else _kept(known, span)
            if short and not slack:
                few = known & np.isin(ids, np.fromiter(short, np.int32))
                keep = keep | _kept(few, least)
            at = np.flatnonzero(keep)
            rows.append((row, doc_id, len(words), ids[at], at.astype(np.int32)))
        yield pd.DataFrame(rows, columns=["row", "doc_id", "n_words", "terms", "places"])


def build_index(docs: DataFrame, words: DataFrame, window: int = WINDOW, slack: int = 0) -> DataFrame:
    """Write and reread `row, doc_id, n_words, terms, places`: one row per document,
    with the term ids and positions of its postings in position order.

    `words` has `term, word, short, least` of every test term; `short` marks terms of items with
    fewer words than a window, whose runs need only `least` words.
    """
    spark = docs.sparkSession
    if words.count() > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} distinct test words; run parts of the test set one by one")
    found = [(r["word"], r["term"], r["short"]) for r in words.select("word", "term", "short").toLocalIterator()]
    least = words.agg(F.min("least")).first()[0] or window
    shared = spark.sparkContext.broadcast(({bytes(w): t for w, t, _ in found}, {t for _, t, s in found if s}))
    # Ids pass as text: beside a null, pandas would hold them as floats.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    index = rows.mapInPandas(
        lambda f: _postings(f, *shared.value, window, least, slack),
        "row bigint, doc_id string, n_words bigint, terms array<int>, places array<int>",
    )
    return stored(index.withColumn("doc_id", F.col("doc_id").cast("bigint")), "positional-index")


def _matches(items: DataFrame, postings: DataFrame, window: int, slack: int) -> DataFrame:
    """`row, item_id, start, off, n, exact`: runs of hits that cover a window or a short item."""
    counts = postings.groupBy("term").agg(F.count("*").alias("n"))
    # The rarest term of each window, the first of equals; a window starts at every place it fits.
    span = F.least(F.col("n_item"), F.lit(window))
    ahead = Window.partitionBy("item_id").orderBy("off").rowsBetween(0, window - 1)
    ranked = items.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = F.min(F.struct("n", "off", "term")).over(ahead)
    rarest = ranked.withColumn("best", best).where(F.col("off") <= F.col("n_item") - span).where("best.n > 0")
    rarest = rarest.select("item_id", F.col("best.off").alias("off"), F.col("best.term").alias("term")).distinct()
    seeds = postings.join(rarest, "term").select("row", "item_id", (F.col("at") - F.col("off")).alias("diagonal")).distinct()

    places = seeds.join(items.select("item_id", "n_item", "off", "term"), "item_id")
    moves = F.explode(F.sequence(F.lit(-slack), F.lit(slack)))
    wanted = places.select("row", "item_id", "n_item", "diagonal", "off", "term", moves.alias("move"))
    wanted = wanted.withColumn("at", F.col("diagonal") + F.col("off") + F.col("move"))
    hits = wanted.join(postings, ["row", "at", "term"]).groupBy("row", "item_id", "n_item", "diagonal", "off").agg(
        F.min(F.abs("move")).alias("moved")
    )
    along = Window.partitionBy("row", "item_id", "diagonal").orderBy("off")
    runs = hits.withColumn("run", F.col("off") - F.row_number().over(along))
    runs = runs.groupBy("row", "item_id", "n_item", "diagonal", "run").agg(
        F.min("off").alias("off"), F.count("*").alias("n"), (F.max("moved") == 0).alias("exact")
    )
    runs = runs.where(F.col("n") >= F.least(F.col("n_item"), F.lit(window)))
    return runs.select("row", "item_id", (F.col("diagonal") + F.col("off")).alias("start"), "off", F.col("n").cast("int").alias("n"), "exact")


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = 0) -> tuple[DataFrame, DataFrame]:
    """The index's documents `row, doc_id, n_words` and the matches
    `row, item_id, start, off, n, exact`, each a run of `n` item words from item word `off` that
    stands in the document from word `start`. Runs are at least a window, or a whole short item.
    """
    small_batches(docs.sparkSession)
    terms = item_terms(benchmark)
    size = F.when(F.col("n_item") < window, F.col("n_item"))
    words = terms.groupBy("word").agg(F.count(size).alias("short"), F.min(size).alias("least"))
    words = words.select("word", (F.xxhash64("word")).alias("hash"), (F.col("short") > 0).alias("short"), "least")
    numbered = words.withColumn("term", F.row_number().over(Window.orderBy("hash", "word")) - 1)
    numbered = stored(numbered.select("word", "term", "short", "least"), "test-terms")
    items = stored(terms.join(numbered.select("word", "term"), "word").drop("word"), "test-items")
    index = build_index(docs, numbered, window, slack)
    postings = index.where(F.size("terms") > 0).select("row", F.explode(F.arrays_zip("terms", "places")).alias("p"))
    postings = postings.select("row", F.col("p.terms").alias("term"), F.col("p.places").alias("at"))
    return index.select("row", "doc_id", "n_words"), stored(_matches(items, postings, window, slack), "matches")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = 0) -> DataFrame:
    """One row per row of `docs`: `doc_id, n_words, n_hit, n_items, items_sha256, contaminated`.

    Null and empty texts have no words and no hits, items without words match nothing, items with
    a null id are ignored, repeated rows stay, other columns are ignored. An empty benchmark
    contaminates nothing.
    """
    rows, matches = find_matches(docs, benchmark, window, slack)
    # Matched stretches that touch are joined before their words are counted.
    spans = matches.select("row", "start", (F.col("start") + F.col("n")).alias("end")).distinct()
    order = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("low", F.greatest(F.col("start"), F.coalesce(before, F.lit(0))))
    hit = spans.groupBy("row").agg(F.sum(F.greatest(F.col("end") - F.col("low"), F.lit(0))).alias("n_hit"))
    named = matches.select("row", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("row").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"))
    found = hit.join(named, "row")
    out = rows.join(found, "row", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


ORACLE = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, place, place + least(len(w), 10) - 1), ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS place FROM item_words WHERE len(w) > 0 AND item_id IS NOT NULL)
), sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, place, array_to_string(list_slice(w, place, place + n - 1), ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS place FROM doc_words, sizes)
), hits AS (SELECT doc_id, place, places.n, item_id FROM places JOIN windows USING (n, key)),
hit_words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(place, place + n)) AS word FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
