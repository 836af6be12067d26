"""Toxic passages as maximum-scoring segments of token log-odds.

A term's score is its log-odds between toxic and clean documents under Dirichlet priors that
follow the whole corpus of the sample, kept only where it is significant. A token takes the score
of the most significant of its terms, which are the word and its beginnings, so that inflected
forms count; a token without one has a small negative score. A linear-time scan finds all maximal segments. Their scores are turned into
evidence by extreme-value statistics (Karlin-Altschul), joined over the segments of a document by
the sum statistic, and mapped to a probability by a logistic fit on the sample.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import id_remainder, small_batches, stored

WORD = re.compile(r"[^\W\d_]+")
#: Bound of the labelled sample that the model is fitted on; rows are chosen by a hash of the id.
TRAIN_DOCS = 20_000
#: Bound of the terms kept in the model, the most significant first.
MAX_TERMS = 20_000
PRIOR = 100.0
MIN_Z = 4.0
DRIFT = 0.4
LOW, HIGH = -2.0, 6.0
#: Letters of the beginnings that count as terms beside the word.
STEMS = (3, 4, 5, 6)
#: Words whose scores a worker keeps at hand.
CACHED = 200_000
RESULT = (
    "score double, predicted int, n_words bigint, "
    "passages array<struct<start:int,end:int,score:double,evidence:double>>"
)


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def terms_of(word: str) -> list[str]:
    """The word itself and its beginnings, those marked with a star."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


class Scores(dict):
    """Scores by word: looked up by term once, then kept. A word without a term has None."""

    def __init__(self, terms: dict[str, tuple[float, float]]):
        super().__init__()
        self.terms = terms

    def __missing__(self, word: str) -> float | None:
        known = [self.terms[t] for t in terms_of(word) if t in self.terms]
        if len(self) >= CACHED:
            self.clear()
        self[word] = value = max(known)[1] if known else None
        return value


@dataclass
class Model:
    """`(significance, score)` by term, the extreme-value constants and the logistic weights."""

    terms: dict[str, tuple[float, float]]
    decay: float = 1.0
    log_k: float = 0.0
    weights: tuple[float, ...] = (0.0, 1.0, 0.0, 0.0)

    def evidence(self, score: float, n_words: int) -> float:
        """Minus the log of the number of segments this good in so many clean words."""
        return self.decay * score - self.log_k - math.log(max(n_words, 1))


def segments(scores: Scores, tokens: list[str]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments `[start, end)` of the tokens, by the linear-time scan.

    Tokens without a score of their own cost DRIFT each; only scored tokens are visited.
    """
    hits = [(i, s) for i, s in enumerate(map(scores.__getitem__, tokens)) if s is not None]
    if not hits:
        return []
    kept: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum after
    links: list[int] = []  # the nearest earlier segment with a smaller sum before, or -1
    total, last = 0.0, 0
    for i, s in hits:
        total -= DRIFT * (i - last)
        last = i + 1
        before, total = total, total + s
        if s <= 0:
            continue
        start, end, low, high = i, i + 1, before, total
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= low:
                j = links[j]
            if j < 0 or kept[j][3] >= high:
                break
            start, low = kept[j][0], kept[j][2]
            del kept[j:], links[j:]
        kept.append((start, end, low, high))
        links.append(j)
    return [(start, end, high - low) for start, end, low, high in kept]


def joint_evidence(each: list[float]) -> tuple[float, int]:
    """The sum statistic over the best `r` segments, at the `r` that says most, and that `r`."""
    best, at, total, log_r = 0.0, 0, 0.0, 0.0
    for r, one in enumerate(sorted((e for e in each if e > 0), reverse=True), 1):
        total += one
        log_r += math.log(r)
        joint = total - (r - 1) * math.log(max(total, 1.0)) + log_r + (log_r - math.log(r))
        if r == 1 or joint > best:
            best, at = joint, r
    return best, at


def features(model: Model, n_words: int, scores: list[float], hits: int) -> list[float]:
    """Intercept, joint evidence, number of toxic tokens and of words, for the logistic map."""
    joint, _ = joint_evidence([model.evidence(s, n_words) for s in scores])
    return [1.0, joint, math.log1p(hits), math.log1p(n_words)]


def toxic_tokens(scores: Scores, tokens: list[str]) -> int:
    return sum(1 for s in map(scores.__getitem__, tokens) if s is not None and s > 0)


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts = (Counter(), Counter())
        for toxic, text in zip(frame["toxic"], frame["text"]):
            counts[toxic].update({t for w in set(words(text)) for t in terms_of(w)})
        terms = list(counts[0].keys() | counts[1].keys())
        yield pd.DataFrame({"term": terms, "clean": [counts[0][t] for t in terms], "bad": [counts[1][t] for t in terms]})


def _likeness_key(text: pd.Series) -> pd.Series:
    """One hash for texts that are alike: the smallest over their three-word windows."""
    def low(t: str | None) -> str:
        tokens = words(t)
        return min((hash_text(" ".join(tokens[i : i + 3])) for i in range(max(1, len(tokens) - 2))), default="")
    return text.map(low)


def hash_text(text: str) -> str:
    import zlib

    return f"{zlib.crc32(text.encode('utf-8', 'surrogatepass')):08x}"


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> DataFrame:
    """`(doc_id, text, toxic)`: a bounded sample of labelled documents that are not held out.

    Held out are ids whose crc32 as text is 0 modulo 5. Null labels and ids do not count, a
    document with several labels is toxic if one says so, and near copies of equal label count once.
    """
    small_batches(docs.sparkSession)
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.where(id_remainder(F.col("doc_id"), 5) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    alike = F.pandas_udf(_likeness_key, "string")
    return rows.withColumn("alike", alike("text")).dropDuplicates(["toxic", "alike"]).drop("alike")


def fit(sample: DataFrame, max_terms: int = MAX_TERMS) -> Model:
    """Fit the model on `(text, toxic)` rows; without rows of both labels every score is the base rate."""
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not size.get(0) or not size.get(1):
        rate = size.get(1, 0) / max(1, sum(size.values()))
        return Model({}, weights=(math.log((rate + 0.01) / (1.01 - rate)), 0.0, 0.0, 0.0))
    counts = sample.select("text", "toxic").mapInPandas(_counts, "term string, clean bigint, bad bigint")
    counts = stored(counts.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad")), "terms")
    all_clean, all_bad = counts.where("term not like '%*'").agg(F.sum("clean"), F.sum("bad")).first()
    share = (F.col("clean") + F.col("bad")) / (all_clean + all_bad)
    prior = share * PRIOR + 0.05
    bad, clean = F.col("bad") + prior, F.col("clean") + prior
    odds = F.log(bad / (all_bad + PRIOR - bad)) - F.log(clean / (all_clean + PRIOR - clean))
    # Signed root of the likelihood ratio: a term absent from clean text can be significant too.
    both = F.col("clean") + F.col("bad")
    ratio = sum(
        F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) * (all_clean + all_bad) / (both * n))).otherwise(0.0)
        for c, n in (("clean", all_clean), ("bad", all_bad))
    )
    z = F.signum(odds) * F.sqrt(F.greatest(2 * ratio, F.lit(0.0)))
    scored = counts.select("term", odds.alias("odds"), z.alias("z"))
    kept = scored.where(F.abs("z") >= MIN_Z).orderBy(F.desc(F.abs("z")), "term").limit(max_terms).collect()
    terms = {r["term"]: (abs(r["z"]), min(HIGH, max(LOW, r["odds"])) - DRIFT) for r in kept}
    model = Model(terms)
    rows = sample.select("text", "toxic").mapInPandas(
        lambda frames: _segment_rows(frames, terms),
        "toxic int, n_words bigint, hits bigint, found array<double>, values array<double>",
    )
    rows = [tuple(r) for r in rows.toLocalIterator()]
    # The decay solves E[exp(decay * score)] = 1 over the tokens of clean documents.
    clean_words = max(1, sum(n for toxic, n, *_ in rows if not toxic))
    seen = Counter(v for toxic, *_, values in rows if not toxic for v in values)
    values = np.array([*seen, -DRIFT])
    shares = np.array([*seen.values(), clean_words - sum(seen.values())], float) / clean_words
    if not any(v > 0 for v in seen):  # no toxic token in clean text: one half of one
        values, shares = np.append(values, HIGH - DRIFT), np.append(shares, 0.5 / clean_words)
    low, high = 1e-3, 50.0
    for _ in range(80):
        model.decay = (low + high) / 2
        low, high = (low, model.decay) if float(shares @ np.exp(model.decay * values)) > 1 else (model.decay, high)
    best = sorted(s for toxic, _, _, found, _ in rows if not toxic for s in found)
    if best:
        at = best[len(best) // 2]
        more = len(best) - bisect.bisect_left(best, at)
        model.log_k = math.log(more) - math.log(clean_words) + model.decay * at
    else:
        model.log_k = -1.0
    x = np.array([features(model, n, found, hits) for _, n, hits, found, _ in rows])
    model.weights = tuple(logistic(x, np.array([r[0] for r in rows], float)).tolist())
    return model


def _segment_rows(frames: Iterator[pd.DataFrame], terms: dict) -> Iterator[pd.DataFrame]:
    scores = Scores(terms)
    for frame in frames:
        rows = []
        for toxic, text in zip(frame["toxic"], frame["text"]):
            tokens = words(text)
            values = [v for v in map(scores.__getitem__, tokens) if v is not None]
            found = [s for _, _, s in segments(scores, tokens)]
            rows.append((toxic, len(tokens), sum(v > 0 for v in values), found, values))
        yield pd.DataFrame(rows, columns=["toxic", "n_words", "hits", "found", "values"])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Newton's method for a ridge logistic regression; the first column is the intercept."""
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1]) * ridge
    keep[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def scored(model: Model, text: Column) -> Column:
    """A struct column of type RESULT for a text column; a null text counts as empty."""

    scores = Scores(model.terms)

    def score(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            tokens = words(text)
            found = [(a, b, s, model.evidence(s, len(tokens))) for a, b, s in segments(scores, tokens)]
            x = features(model, len(tokens), [s for _, _, s, _ in found], toxic_tokens(scores, tokens))
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(model.weights, x))))))
            passages = []
            if found and any(e > 0 for *_, e in found):
                spans = [m.span() for m in WORD.finditer((text or "").lower())]
                passages = [(spans[a][0], spans[b - 1][1], s, e) for a, b, s, e in found if e > 0]
            rows.append((p, int(p >= 0.5), len(tokens), passages))
        return pd.DataFrame(rows, columns=["score", "predicted", "n_words", "passages"])

    return F.pandas_udf(score, RESULT)(text)


def score_documents(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """`doc_id, held_out, score, predicted, n_words, passages` of every row of `docs`.

    `passages` holds the significant segments as offsets into the lower-cased text. Null and empty
    texts have the score of no evidence; a null `doc_id` is scored and counts as held out. Repeated
    rows stay; other columns are ignored; an empty table gives no row.
    """
    model = fit(stored(training_rows(docs, labels, train_docs), "toxic-sample"))
    held = F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(True))
    rows = docs.select("doc_id", held.alias("held_out"), scored(model, F.col("text")).alias("found"))
    return rows.select("doc_id", "held_out", "found.*")
