"""Language proportions of a document by expectation-maximisation over n-gram likelihoods.

Each learned language has trigram probabilities, smoothed and hashed into a fixed number of
buckets. A document is a mixture: each of its words comes from one language, with the likelihood
of the word's trigrams. Expectation-maximisation estimates the proportions of all languages, then
of the sets of the one, two, ... up to all most probable ones; the set with the greatest likelihood
less a penalty for each further language is chosen. A document is left alone once the penalty of a
larger set outweighs the greatest likelihood that any mixture could reach.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.llm.common import id_remainder, mix, stored

BUCKETS = 1 << 16
#: Bound of the sample that each language is learned from, chosen by a hash of the id.
TRAIN_DOCS = 2_000
STEPS, RESTRICTED_STEPS = 12, 6
#: Documents are estimated together up to about so many characters.
CHUNK_CHARS = 200_000
UNKNOWN = "und"
RESULT = "lang_pred string, score double, languages array<struct<lang:string,share:double>>"
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point 2 if it is a letter, 1 if it is a mark that may stand inside a word, else 0."""
    if not _LETTERS:
        kinds = ({"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1))
        _LETTERS.append(np.fromiter(kinds, np.uint8, sys.maxunicode + 1))
    return _LETTERS[0]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each letter's trigram, and where in that list each word starts; a text of marks
    without a letter has none."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = letters()[np.minimum(points, sys.maxunicode)]
    points = np.where(kinds if (kinds == 2).any() else 0, points, 0)
    points = np.concatenate(([0], points, [0])).astype(np.uint64)
    inside = points > 0
    middle = np.flatnonzero(inside)
    if not len(middle):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    packed = (points[middle - 1] << np.uint64(42)) | (points[middle] << np.uint64(21)) | points[middle + 1]
    starts = np.flatnonzero(~inside[middle - 1])
    return (mix(packed) & np.uint64(BUCKETS - 1)).astype(np.int64), starts


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}
    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"]):
            if lang not in totals:
                totals[lang] = np.zeros(BUCKETS, np.int64)
            totals[lang] += np.bincount(trigrams(text)[0], minlength=BUCKETS)
    for lang, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": counts[at]})


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log-probabilities by bucket, from documents not held out.

    Held out are rows whose id's crc32 as text is 1 modulo 3, and rows without an id.
    """
    known = docs.where("lang is not null and text is not null").where(id_remainder(F.col("doc_id"), 3) != 1)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = known.select("doc_id", "lang", rank.alias("rank")).where(F.col("rank") <= train_docs).select("doc_id", "lang").distinct()
    sample = known.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    counts = sample.select("lang", "text").mapInPandas(_counts, "lang string, bucket int, n bigint")
    counts = stored(counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "trigrams")
    table = counts.toPandas()
    langs = sorted(table["lang"].unique())
    grid = np.zeros((BUCKETS, len(langs)))
    grid[table["bucket"], table["lang"].map({name: i for i, name in enumerate(langs)}).to_numpy(dtype=int)] = table["n"]
    everywhere = grid.sum(axis=1, keepdims=True) + 0.1
    prior = everywhere / everywhere.sum(axis=0)
    smoothed = (grid + 500 * prior) / (grid.sum(axis=0) + 500) if langs else grid
    return langs, np.log(smoothed).astype(np.float32)


def _shares(like: np.ndarray, doc_starts: np.ndarray, of: np.ndarray, sizes: np.ndarray, allowed: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions by document after `steps`, and the log-likelihood that they were stepped from."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    total = None
    for _ in range(steps):
        weighted = like * share[of]
        total = weighted.sum(axis=1, keepdims=True)
        share = np.add.reduceat(weighted / total, doc_starts, axis=0) / sizes[:, None]
    return share, np.add.reduceat(np.log(total[:, 0]), doc_starts)


def mixtures(table: np.ndarray, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """For each text the shares over all languages and over the selected ones; None without a letter."""
    found = [trigrams(t) for t in texts]
    out: list = [None] * len(texts)
    full = [i for i, (b, _) in enumerate(found) if len(b)]
    if not full or not table.shape[1]:
        return out
    sizes = np.array([len(found[i][1]) for i in full])
    offsets = np.cumsum([0] + [len(found[i][0]) for i in full[:-1]])
    words = np.concatenate([found[i][1] + o for i, o in zip(full, offsets)])
    logs = np.add.reduceat(table[np.concatenate([found[i][0] for i in full])], words, axis=0)
    peak = logs.max(axis=1, keepdims=True)
    # Likelihoods are kept relative to the best language of a word, so none underflows to zero.
    like = np.exp(np.maximum(logs - peak, -60)).astype(np.float64)
    doc_starts = np.cumsum([0, *sizes[:-1]])
    of = np.repeat(np.arange(len(full)), sizes)
    everything = np.ones((len(full), table.shape[1]))
    share, _ = _shares(like, doc_starts, of, sizes, everything, STEPS)
    order = np.argsort(-share, axis=1, kind="stable")
    best, best_share = np.full(len(full), -np.inf), share.copy()
    penalty = 0.5 * np.log(sizes) + 2.0
    # By concavity no mixture is likelier than this, whatever its shares.
    total = (like * share[of]).sum(axis=1, keepdims=True)
    slope = np.add.reduceat(like / total, doc_starts, axis=0) / sizes[:, None]
    bound = np.add.reduceat(np.log(total[:, 0]), doc_starts) + sizes * np.log(slope.max(axis=1))
    left = np.arange(len(full))
    for k in range(1, table.shape[1] + 1):
        more = bound[left] - (k - 1) * penalty[left] > best[left]
        if not more.any():
            break
        if not more.all():
            like, left = like[more[of]], left[more]
            of = np.repeat(np.arange(len(left)), sizes[left])
            doc_starts = np.cumsum([0, *sizes[left][:-1]])
        allowed = np.zeros((len(left), table.shape[1]))
        np.put_along_axis(allowed, order[left, :k], 1.0, axis=1)
        steps = RESTRICTED_STEPS if k > 1 else 1
        part, gain = _shares(like, doc_starts, of, sizes[left], allowed, steps)
        gain = gain - (k - 1) * penalty[left]
        better = gain > best[left]
        best[left] = np.where(better, gain, best[left])
        best_share[left] = np.where(better[:, None], part, best_share[left])
    for at, i in enumerate(full):
        out[i] = (share[at], best_share[at] / best_share[at].sum())
    return out


def identified(langs: list[str], table: np.ndarray, text: Column) -> Column:
    """A struct column of type RESULT for a text column."""

    def run(texts: pd.Series) -> pd.DataFrame:
        rows, chunk, size = [], [], 0

        def flush() -> None:
            for found in mixtures(table, chunk):
                if found is None:
                    rows.append((UNKNOWN, 0.0, []))
                else:
                    share, kept = found
                    top = int(np.argmax(kept))
                    names = [(langs[i], float(kept[i])) for i in np.argsort(-kept) if kept[i] > 0]
                    rows.append((langs[top], float(min(1.0, share[top])), names))
            chunk.clear()

        for t in texts:
            chunk.append(t or "")
            size += len(chunk[-1])
            if size > CHUNK_CHARS:
                flush()
                size = 0
        flush()
        return pd.DataFrame(rows, columns=["lang_pred", "score", "languages"])

    return F.pandas_udf(run, RESULT)(text)


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """`doc_id, held_out, lang_pred, score, languages` of every row of `docs`.

    `languages` are the selected ones with their shares, `score` is the share of `lang_pred` among
    all. A null text, or one without a letter, is `und` with score 0, as is every text when nothing
    can be learned. Rows without an id are held out; repeated rows stay; other columns are ignored.
    """
    langs, table = learn(docs, train_docs)
    held = F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(True))
    rows = docs.select("doc_id", held.alias("held_out"), identified(langs, table, F.col("text")).alias("l"))
    return rows.select("doc_id", "held_out", "l.*")
