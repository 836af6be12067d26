"""What the text operators share: shared folders, stored steps, word hashes, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = 0xFFFFFFFFFFFFFFFF
#: An odd base; its inverse modulo 2**64 undoes the shift of a word's place in the buffer.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Blocks keep the table of powers, and so the memory of a task, independent of the text's length.
POWERS = 1 << 16
#: Whether a written step's shuffle files go when its write ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of the rows that go to a Python worker at once; Spark's own bounds are 10,000 rows and 64 MB.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`; a local one only where that is unset, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="llm-", dir=os.environ.get("TMPDIR", "/tmp"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back, so lost executors do not undo it.

    Once the step is written nothing reads the shuffles behind it, so Spark is told to remove them.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of texts for Python workers in bytes, whatever the texts' length.

    The setting stays with the session, as the caller plans and runs what an operator returns; a
    session's own setting is left alone.
    """
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def discard(*steps: DataFrame) -> None:
    """Empty the folders of stored steps that no later plan reads; what is given is no frame any more.

    No row comes from Python, which would start workers of another kind beside those of the UDFs.
    """
    for step in steps:
        files = step.inputFiles()
        if files:
            columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in step.schema]
            nothing = step.sparkSession.range(0).select(*columns)
            nothing.write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int) -> np.ndarray:
    out = np.empty(POWERS, np.uint64)
    out[0] = 1
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(BASE), _powers(INVERSE)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges `[start, end)`, which are ascending and do not overlap."""
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    weighted = (data.astype(np.uint64) + np.uint64(1)) * mix(np.arange(256, dtype=np.uint64) + np.uint64(1))[data]
    lengths = ends - starts
    top = int(lengths.max())
    if top <= POWERS and len(data) <= POWERS:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(weighted * _UP[: len(data)], out=sums[1:])
        out = (sums[ends] - sums[starts]) * _DOWN[starts]
    else:
        at = 0
        while at < len(starts):
            # As many ranges as fit one block; a longer range is folded block by block.
            stop = int(np.searchsorted(ends, starts[at] + POWERS, side="right"))
            if stop > at:
                low, high = int(starts[at]), int(ends[stop - 1])
                sums = np.zeros(high - low + 1, np.uint64)
                np.cumsum(weighted[low:high] * _UP[: high - low], out=sums[1:])
                out[at:stop] = (sums[ends[at:stop] - low] - sums[starts[at:stop] - low]) * _DOWN[starts[at:stop] - low]
                at = stop
            else:
                whole, shift = 0, 1
                for low in range(int(starts[at]), int(ends[at]), POWERS):
                    part = weighted[low : min(low + POWERS, int(ends[at]))]
                    whole = (whole + shift * int(np.sum(part * _UP[: len(part)]))) & MASK
                    shift = shift * pow(BASE, POWERS, 1 << 64) & MASK
                out[at] = whole
                at += 1
    return mix(out + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def space_word_hashes(lowered: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words `[^\\x20\\x09-\\x0D]+` of UTF-8 bytes, and where each word starts."""
    data = np.frombuffer(lowered, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    starts = np.flatnonzero(edge == 1)
    return range_hashes(data, starts, np.flatnonzero(edge == -1)), starts


#: bytes.translate table: A-Z to a-z, other ASCII outside 0-9 and a-z to a space.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def alnum_words(text: str) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text with A-Z lower-cased, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(ALNUM).split()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """`(node, component)` of an undirected graph `(a, b)`; a component is its smallest node.

    Alternates large and small stars: every node's greater neighbours, then its smaller ones,
    move to the smallest. Only minima are gathered by node, so no neighbourhood sits in one task.
    """
    link = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.select(link.alias("e")).select("e.a", "e.b").where("a <> b").distinct(), name)
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        last, edges = edges, stored(moved.unionAll(low.select("a", F.col("low").alias("b"))).distinct(), name)
        discard(last)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
