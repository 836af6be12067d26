"""SentencePiece encoding and decoding of a BPE model, as a lattice of pieces over each word.

A text is cut where no piece can cross: before a run of word marks and around line ends. For each
distinct word all substrings up to the longest piece are matched with the piece table, and the
edges are folded from left to right. Piece scores of a BPE model are merge ranks, so the path with
the greatest sum is not what the model's own encoder returns; the fold therefore keeps, at each
position, the one edge that may follow the best edge before it: two neighbouring pieces may stand
together only if merging their joined text gives just these two. That is linear in a word's length
and gives the model's own ids.
"""

from __future__ import annotations

import itertools
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import small_batches
from rillhouse.llm.jaccard_join import text_chunks

MARK = "▁"
UNIT = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
#: Entries each worker keeps of words and of piece pairs, some 200 bytes each; a full table starts anew.
CACHED = 400_000
RESULT = "ids array<int>, n_tokens bigint, decoded string"


@dataclass
class Pieces:
    """The piece table: ids and scores of ordinary pieces, the length of the longest piece in each of
    their beginnings (1 if there is none), and what each id stands for."""

    ids: dict[str, int]
    scores: dict[str, float]
    names: list[str | bytes]
    byte_ids: list[int]
    longest: int
    heads: dict[str, int]
    pairs: dict[str, dict[str, bool]] = field(default_factory=dict)
    n_pairs: int = 0
    edges: dict[tuple[str, int], list] = field(default_factory=dict)
    words: dict[str, bytes] = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "pairs": {}, "n_pairs": 0, "edges": {}, "words": {}}


def read_pieces(model_file: str) -> Pieces:
    """The piece table of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids, scores, names, byte_ids = {}, {}, [], [0] * 256
    for i in range(model.vocab_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            names.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            names.append(b"")
        else:
            ids[name], scores[name] = i, model.get_score(i)
            names.append(name.replace(MARK, " ").encode())
    if any("\n" in p or MARK in p.lstrip(MARK) for p in ids):
        raise ValueError("pieces that cross words are not supported")
    heads = {}
    for head in sorted({p[:n] for p in ids for n in range(1, len(p) + 1)}, key=len):
        heads[head] = len(head) if head in ids else heads.get(head[:-1], 1)
    return Pieces(ids, scores, names, byte_ids, max(map(len, ids)), heads)


def merged(pieces: Pieces, text: str, parts_left: int = 1) -> list[str]:
    """The model's merges of a short text: always the best-scored neighbours, the leftmost of equals."""
    parts = list(text)
    while len(parts) > parts_left:
        best, at = None, -1
        for i in range(len(parts) - 1):
            score = pieces.scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def _edge(pieces: Pieces, piece: str, side: int) -> list[tuple[str, float]]:
    """The parts that stand at one side of a piece while it is merged, the piece first, each with
    the score of the merge that consumes it; empty if merging the piece's text does not give it."""
    known = pieces.edges.get((piece, side))
    if known is None:
        known, part, consumed = [], piece, -np.inf
        if merged(pieces, piece) == [piece]:
            while True:
                known.append((part, consumed))
                if len(part) == 1:
                    break
                consumed = pieces.scores[part]
                part = merged(pieces, part, 2)[side]
        pieces.edges[(piece, side)] = known
    return known


def _follows(pieces: Pieces, left: str, right: str) -> bool:
    """Whether merging the joined text leaves just these two: no part at the end of `left` merges
    with one at the start of `right` before either is consumed on its own side."""
    before, after = _edge(pieces, left, -1) if left else [], _edge(pieces, right, 0)
    fits = bool(after) and bool(before or not left)
    for one, gone in before if fits else []:
        for two, lost in after:
            score = pieces.scores.get(one + two)
            if score is not None and score > gone and score >= lost:
                fits = False
    pieces.n_pairs += 1
    if pieces.n_pairs >= CACHED:
        pieces.pairs.clear()
        pieces.n_pairs = 0
    return fits


def best_path(pieces: Pieces, word: str) -> list[str]:
    """Fold the lattice from left to right along its one consistent path, longest edges first.

    Edges are the substrings in the piece table, and single characters without a piece. Only one
    consistent path leads to a position, so a position that no edge leaves consistently is given up
    for good, and the next shorter edge before it is tried: the work is linear in a word's length.
    """
    heads, pairs, size = pieces.heads, pieces.pairs, len(word)
    path, dead, start, length = [], set(), 0, 0
    while start < size:
        if not length:
            end = start + 1
            while end < size and word[start : end + 1] in heads:
                end += 1
            length = heads.get(word[start:end], 1)
        piece, before = word[start : start + length], path[-1] if path else ""
        known = pairs.get(before)
        if known is None:
            known = pairs[before] = {}
        fits = known.get(piece)
        if fits is None:
            fits = known[piece] = _follows(pieces, before, piece)
        if fits and start + length not in dead:
            path.append(piece)
            start, length = start + length, 0
        elif length > 1:
            length = heads[piece[:-1]]
        elif path:
            dead.add(start)
            length = len(path.pop())
            start -= length
        else:
            return merged(pieces, word)
    return path


def word_ids(pieces: Pieces, word: str) -> bytes:
    """Ids of a word as little-endian 32-bit integers; characters without a piece become bytes."""
    known = pieces.words.get(word)
    if known is None:
        out = []
        for part in best_path(pieces, word):
            one = pieces.ids.get(part)
            out += [one] if one is not None else [pieces.byte_ids[b] for b in part.encode("utf-8", "replace")]
        known = struct.pack(f"<{len(out)}i", *out)
        if len(pieces.words) >= CACHED:
            pieces.words.clear()
        if len(word) <= 64:
            pieces.words[word] = known
    return known


def encode(pieces: Pieces, text: str | None) -> np.ndarray:
    if not text:
        return np.zeros(0, "<i4")
    units = UNIT.findall(MARK + text.replace(" ", MARK))
    get, full = pieces.words.get, word_ids
    return np.frombuffer(b"".join([get(u) or full(pieces, u) for u in units]), "<i4")


def decode(pieces: Pieces, ids) -> str:
    """The text of ids: pieces joined, byte pieces as UTF-8, without the mark put before the text."""
    text = b"".join(map(pieces.names.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _encoded(batches: Iterator[pa.RecordBatch], pieces: Pieces) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, column = 0, batch.column("text")
        for texts in text_chunks(t.as_py() for t in column):
            ids = [encode(pieces, t) for t in texts]
            ends = np.cumsum([0, *map(len, ids)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(at, len(texts)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32())),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.array([decode(pieces, i.tolist()) for i in ids], pa.string()),
                ],
                names=["doc_id", "ids", "n_tokens", "decoded"],
            )
            at += len(texts)


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """`doc_id, ids, n_tokens, decoded` of every row of `docs`.

    Null and empty texts have no ids and decode to an empty text; repeated rows and null ids stay;
    other columns are ignored. A literal word mark in a text decodes to a space, as in the library.
    A task holds the results of some 200,000 characters at a time, or of one longer text.
    """
    small_batches(docs.sparkSession)
    pieces = read_pieces(model_file)
    of = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _encoded(batches, pieces), f"doc_id {of}, {RESULT}")


def word_table(docs: DataFrame, column: str = "text") -> DataFrame:
    """Distinct `word`s of a text column, cut as `encode` cuts them."""
    marked = F.concat(F.lit(MARK), F.replace(column, F.lit(" "), F.lit(MARK)))
    words = F.regexp_extract_all(marked, F.lit(f"{MARK}+[^{MARK}\\n]*|[^{MARK}\\n]+|\\n"), F.lit(0))
    return docs.where(F.length(column) > 0).select(F.explode(words).alias("word")).distinct()


def relational_lattice(words: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """`word, edges` from distinct `word`s and the piece table `(piece, id)`: substrings up to
    `longest` characters are exploded, joined to the pieces by equality and grouped by word.
    `edges` are `(end, start, id)` in order; characters without a piece have the id -1.
    """
    starts = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start"))
    spans = starts.select(
        "word", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("word") - F.col("start")))).alias("n")
    )
    parts = spans.select("word", "start", "n", F.expr("substring(word, start + 1, n)").alias("piece"))
    joined = parts.join(table, "piece", "left").where("id is not null or n = 1")
    edge = F.struct((F.col("start") + F.col("n")).alias("end"), "start", F.coalesce("id", F.lit(-1)).alias("id"))
    return joined.groupBy("word").agg(F.array_sort(F.collect_list(edge)).alias("edges"))


def best_paths(lattices: DataFrame, scores: list[float]) -> DataFrame:
    """`word, ids`: Viterbi over each lattice by Spark's `aggregate`, greatest sum of scores first.

    This is the fold for models whose scores are log-probabilities (unigram models).
    """
    table = F.array(*[F.lit(float(s)) for s in scores])
    blank = F.expr("array(struct(0.0D AS total, cast(array() AS array<int>) AS ids))")

    def step(paths: Column, edge: Column) -> Column:
        before = F.element_at(paths, edge["start"] + 1)
        score = F.when(edge["id"] < 0, F.lit(-1e3)).otherwise(F.element_at(table, edge["id"] + 1))
        path = F.struct((before["total"] + score).alias("total"), F.concat(before["ids"], F.array(edge["id"])).alias("ids"))
        fresh = F.size(paths) <= edge["end"]
        better = path["total"] > F.element_at(paths, edge["end"] + 1)["total"]
        return (
            F.when(fresh, F.concat(paths, F.array(path)))
            .when(better, F.concat(F.slice(paths, F.lit(1), edge["end"]), F.array(path)))
            .otherwise(paths)
        )

    return lattices.select("word", F.aggregate("edges", blank, step, lambda p: F.element_at(p, -1)["ids"]).alias("ids"))


def pieces_table(spark, pieces: Pieces) -> DataFrame:
    """`(piece, id)` rows of the piece table; a vocabulary file bounds its size."""
    return spark.createDataFrame(pd.DataFrame(list(itertools.islice(pieces.ids.items(), None)), columns=["piece", "id"]), "piece string, id int")
