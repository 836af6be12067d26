"""Removal of repeated passages: hash units of words, group digests, keep the earliest occurrence.

Lines are not the units here: passages start and end inside lines, and short lines that many
documents share are no passages. The unit is a run of `length` words, wherever it starts, so a
passage is found whole however it is set, and what is shorter stays.

Hashing every unit of every text would move more than the texts. Two passes hash what matters:

1. Of the runs of half that length, each text gives the smallest hash of every `half` neighbours.
   Two equal units hold an equal one of these seeds, as the choice depends on the words alone.
2. Texts with a seed that some other place has too give the units whose own seed is such a one.
   Units are grouped by digest, and all but the first by `(doc_id, place)` are marked.

Equal texts are one class throughout: its first document stands for it, the others are repeats.
Digests are grouped by their smallest place, which is partial in the map task; only marked digests
are joined back, where AQE can split a hot one, because the other side has one row per digest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import mix, small_batches, space_word_hashes, stored
from rillhouse.llm.jaccard_join import text_chunks

#: Words of the shortest passage that counts as one: more than fifty.
LENGTH = 51
WORD = re.compile("[^ \t-\r]+")
#: What a null id ranks as: before all others.
FIRST_ID = -(1 << 63)


def _class(text: Column) -> Column:
    """What tells texts apart: 16 bytes; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _id() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(FIRST_ID))


def chunk_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, in order, with A-Z lower-cased, and where each text's words start."""
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    words, starts = space_word_hashes(b" ".join(raw))
    ends = np.cumsum([len(r) + 1 for r in raw])
    return words, np.concatenate([[0], np.searchsorted(starts, ends)])


def run_hashes(words: np.ndarray, span: int) -> np.ndarray:
    """Hashes of every `span` neighbouring words."""
    rolled = np.zeros(max(0, len(words) - span + 1), np.uint64)
    for j in range(span if len(rolled) else 0):
        rolled = rolled * np.uint64(0xFF51AFD7ED558CCD) + words[j : j + len(rolled)]
    return mix(rolled + np.uint64(span))


def seeds(runs: np.ndarray, among: int) -> np.ndarray:
    """For every `among` neighbouring hashes the place of the smallest, the first of equals."""
    if len(runs) < among:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(runs, among)
    return views.argmin(axis=1) + np.arange(len(views))


def _seed_rows(frames: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    span, among, seen = (length + 1) // 2, length - (length + 1) // 2 + 1, set()
    for frame in frames:
        at = 0
        for texts in text_chunks(frame["text"]):
            classes = frame["class"].iloc[at : at + len(texts)].tolist()
            at += len(texts)
            words, bounds = chunk_words(texts)
            runs = run_hashes(words, span)
            out: list[tuple] = []
            for i, name in enumerate(classes):
                # Copies within a task give their seeds once.
                if bounds[i + 1] - bounds[i] < length or name in seen:
                    continue
                seen.add(name)
                places = np.unique(seeds(runs[bounds[i] : bounds[i + 1] - span + 1], among))
                out.append((runs[bounds[i] + places].view(np.int64), [name] * len(places), places.astype(np.int32)))
            if out:
                hashes, names, places = zip(*out)
                yield pd.DataFrame({
                    "seed": np.concatenate(hashes), "class": [n for x in names for n in x], "place": np.concatenate(places),
                })


def _unit_rows(frames: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    span, among, seen = (length + 1) // 2, length - (length + 1) // 2 + 1, set()
    for frame in frames:
        for doc_id, name, text, repeated in zip(frame["id"], frame["class"], frame["text"], frame["places"]):
            if name in seen:
                continue
            seen.add(name)
            words, _ = chunk_words([text])
            units = np.flatnonzero(np.isin(seeds(run_hashes(words, span), among), repeated))
            digests = run_hashes(words, length)[units]
            yield pd.DataFrame({
                "digest": digests.view(np.int64), "id": np.full(len(units), doc_id, np.int64),
                "class": [name] * len(units), "place": units.astype(np.int32),
            }, columns=["digest", "id", "class", "place"])


def classes_of(docs: DataFrame) -> DataFrame:
    """`class, first_id, later` of every text: its smallest id, and whether another id has it too."""
    ids = docs.select(_class(F.col("text")).alias("class"), _id().alias("id"))
    found = ids.groupBy("class").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    return stored(found.select("class", "first_id", (F.col("first_id") < F.col("last_id")).alias("later")), "classes")


def repeated_units(docs: DataFrame, classes: DataFrame, length: int = LENGTH) -> DataFrame:
    """`class, marks` of every text with units that an earlier place has: the word numbers at which
    they start, each with the id of the document that has the unit first."""
    texts = docs.where(F.length("text") >= 2 * length - 1).select(_id().alias("id"), _class(F.col("text")).alias("class"), "text")
    found = texts.select("class", "text").mapInPandas(lambda f: _seed_rows(f, length), "seed bigint, class binary, place int")
    found = stored(found, "seeds")
    spot = F.struct("class", "place")
    shared = found.groupBy("seed").agg(F.min(spot).alias("low"), F.max(spot).alias("high")).where("low <> high").select("seed")
    # Stored, so that the join has a plain exchange on both sides and a hot seed can be split.
    shared = stored(shared, "shared-seeds")
    places = found.join(shared, "seed").groupBy("class").agg(F.collect_set("place").alias("places"))
    places = places.join(classes, "class").select("class", F.col("first_id").alias("id"), "places")
    # One row of each class has the smallest id, so a class of many copies meets as one text.
    units = texts.join(places, ["class", "id"]).select("id", "class", "text", "places")
    units = stored(units.mapInPandas(lambda f: _unit_rows(f, length), "digest bigint, id bigint, class binary, place int"), "units")
    spot = F.struct("id", "class", "place")
    first = units.groupBy("digest").agg(F.min(spot).alias("first"), F.max(spot).alias("last")).where("first <> last").select("digest", "first")
    first = stored(first, "first-units")
    marked = units.join(first, "digest").where(spot != F.col("first"))
    mark = F.struct("place", F.col("first.id").alias("first_id"))
    return marked.groupBy("class").agg(F.sort_array(F.collect_set(mark)).alias("marks"))


def _cut(length: int):
    def cut(text: pd.Series, own: pd.Series, first: pd.Series, marks: pd.Series) -> pd.DataFrame:
        rows = []
        for t, doc, start, found in zip(text, own, first, marks):
            later = pd.notna(start) and int(start) < int(doc)
            if not t or (found is None and not later):
                rows.append((t, len(WORD.findall(t or "")), 0, []))
                continue
            spans = [m.span() for m in WORD.finditer(t)]
            gone, source = np.zeros(len(spans) + 1, np.int64), {}
            if later and len(spans) >= length:
                gone[0], gone[-1], source = 1, -1, {0: int(start)}
            elif found is not None and not later:
                for mark in found:
                    gone[mark["place"]] += 1
                    gone[mark["place"] + length] -= 1
                    source[mark["place"]] = mark["first_id"]
            edge = np.diff(np.concatenate([[0], (np.cumsum(gone[:-1]) > 0).astype(np.int8), [0]]))
            passages, kept, at, removed = [], [], 0, 0
            for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                low, high = spans[a][0], spans[b - 1][1]
                passages.append({"start": low, "length": high - low, "words": b - a, "first_doc": None if source[a] == FIRST_ID else source[a]})
                kept.append(t[at:low])
                at, removed = high, removed + b - a
            rows.append(("".join([*kept, t[at:]]), len(spans), removed, passages))
        return pd.DataFrame(rows, columns=["text", "n_words", "n_removed", "passages"])

    return cut


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All columns of `docs`, the text without its repeated passages, and the columns beside it:
    `n_words`, `n_removed` (words) and `passages`, an array of `(start, length, words, first_doc)`
    with code-point offsets into the original text.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; a unit is `length` of them in a row. Words
    of a unit that stands at an earlier place by `(doc_id, place)`, of another document or of the
    same, go, from the first one's start to the last one's end of each run; all else stays as it
    is. A null text stays null; rows that repeat an id and text are one document and alike; rows
    of one id with other texts rank by a hash of the text; null ids come first. Texts of fewer words are never changed.
    Clashing column names of the input are replaced by the new ones.
    """
    small_batches(docs.sparkSession)
    fresh = [c for c in docs.columns if c not in ("n_words", "n_removed", "passages")]
    docs = docs.select(*fresh)
    classes = classes_of(docs)
    marks = repeated_units(docs, classes, length)
    known = classes.join(marks, "class", "left").where(F.col("later") | F.col("marks").isNotNull())
    known = known.select(F.col("class").alias("_class"), F.col("first_id").alias("_first"), F.col("marks").alias("_marks"))
    joined = docs.withColumn("_id", _id()).join(known, _class(F.col("text")) == F.col("_class"), "left")
    shape = "text string, n_words bigint, n_removed bigint, passages array<struct<start:int,length:int,words:int,first_doc:bigint>>"
    # Ids pass as text: beside a null, pandas would hold them as floats.
    cut = F.pandas_udf(_cut(length), shape)("text", F.col("_id").cast("string"), F.col("_first").cast("string"), "_marks")
    done = joined.withColumn("_cut", cut)
    columns = [F.col("_cut.text").alias(c) if c == "text" else F.col(f"`{c}`") for c in fresh]
    return done.select(*columns, "_cut.n_words", "_cut.n_removed", "_cut.passages")


ORACLE = r"""
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t FROM documents
), spread AS (
  SELECT doc_id, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS pos FROM tokens
), placed AS (
  SELECT doc_id, token, pos, regexp_matches(token, '[^\x20\x09-\x0D]') AS word,
         coalesce(sum(length(token)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM spread
), words AS (
  SELECT doc_id, pos, start, token, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS place FROM placed WHERE word
), lists AS (
  SELECT doc_id, list(translate(token, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ORDER BY place) AS w FROM words GROUP BY doc_id
), units AS (
  SELECT doc_id, place, sha256(array_to_string(list_slice(w, place + 1, place + 51), ' ')) AS key
  FROM (SELECT doc_id, w, unnest(range(len(w) - 50)) AS place FROM lists WHERE len(w) > 50)
), marked AS (
  SELECT doc_id, place FROM (SELECT doc_id, place, row_number() OVER (PARTITION BY key ORDER BY doc_id, place) AS rank FROM units) WHERE rank > 1
), gone AS (
  SELECT DISTINCT doc_id, place FROM (SELECT doc_id, unnest(range(place, place + 51)) AS place FROM marked)
), runs AS (
  SELECT doc_id, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run, pos, start, length(token) AS n
  FROM gone JOIN words USING (doc_id, place)
), passages AS (
  SELECT doc_id, min(pos) AS low, max(pos) AS high, min(start) AS start, max(start + n) - min(start) AS length, count(*) AS words
  FROM runs GROUP BY doc_id, run
), kept AS (
  SELECT p.doc_id, string_agg(token, '' ORDER BY pos) AS text
  FROM placed p WHERE NOT EXISTS (SELECT 1 FROM passages q WHERE q.doc_id = p.doc_id AND p.pos BETWEEN q.low AND q.high) GROUP BY p.doc_id
), listed AS (
  SELECT doc_id, count(*) AS n, sum(words) AS words,
         string_agg(CAST(start AS BIGINT) || ':' || CAST(length AS BIGINT), ',' ORDER BY start) AS spans
  FROM passages GROUP BY doc_id
), sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.text, '') AS text, CAST(coalesce(s.n, 0) AS BIGINT) AS n_words,
       CAST(coalesce(l.words, 0) AS BIGINT) AS n_removed, CAST(coalesce(l.n, 0) AS BIGINT) AS n_passages,
       coalesce(l.spans, '') AS passages
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN listed l USING (doc_id) LEFT JOIN sizes s USING (doc_id)
"""
