"""Token ids as length-delimited binary records with masked checksums and an offset index.

A record is `<u64 length> <u32 masked crc of the length> <payload> <u32 masked crc of the payload>`
and a payload `<u8 has id> <u8 bytes of an id> <i64 doc_id> <ids...>`, all little-endian. Ids take two
bytes where the vocabulary allows it. Each shard `*.bin` has an
index `*.idx` of `<u64 offset> <u64 length>` per record, for shuffled reads. Shards follow the
order of `doc_id`; a manifest names the shards of the attempts that won, so a task that ran twice
leaves an unused file and nothing else.

Texts are encoded where they are read; only ids are stored, sorted and moved. A batch of texts is
cut into chunks by Arrow, each different chunk is encoded once by the library, and numpy gathers the
ids of all texts.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillhouse.llm.common import shared_folder, stored

END_ID = 2
#: Bytes of text that are cut at once, and of the table of encoded chunks that a worker keeps; a full one starts anew.
BATCH_BYTES, KEPT_BYTES = 8 << 20, 80 << 20
#: Chunks that are encoded as one text.
JOINED = 64
#: Rough bytes of an entry of that table beside its chunk and ids.
ENTRY_BYTES = 200
HEAD, ID, ENTRY, CRC = struct.Struct("<Q"), struct.Struct("<?Bq"), struct.Struct("<QQ"), struct.Struct("<I")
CUT = re.compile(r"(?= \S)")
#: A piece that starts with it has no space before it; texts that hold it are encoded whole.
MARK = "\x01"
#: Where a letter ends and ASCII punctuation or a line end begins, the pre-tokenizer cuts too.
BREAK = ("([A-Za-zÀ-ÖØ-öø-ÿ])([!-/:-@\\[-`{-~\n])", f"\\1 {MARK}\\2")
NO_SPACE, NOTHING = pa.scalar(MARK, pa.large_string()), pa.scalar("", pa.large_string())


def masked(data: bytes) -> int:
    """The checksum, rotated and shifted so that a record of records keeps telling errors apart."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


class Encoder:
    """A byte-level tokenizer file of the tokenizers library, with encoded chunks kept.

    The pre-tokenizer always cuts before a single space that a non-space follows, whatever stands
    before it, and behind a letter that no letter follows, so texts are encoded chunk by chunk. A text that holds the string of a special token
    is encoded whole, as the library looks for those first.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A byte-level piece has one character per byte.
        sizes = {i: len(p) for p, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.bytes_of = np.array([sizes.get(i, 1) for i in range(max(sizes) + 1)], np.int64)
        self.kept: dict[str, bytes] = {}
        self.kept_bytes = 0

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def _joined(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of different chunks; those that start with a cut are encoded as one text, which
        spares the library most of its work per call, and told apart by the bytes of their ids."""
        alone = [c for c in chunks if c[:1] != " " or c[1:2].isspace() or len(c) < 2]
        out = dict(zip(alone, (x.tobytes() for x in self._library(alone)))) if alone else {}
        rest = [c for c in chunks if c not in out]
        groups = [rest[a : a + JOINED] for a in range(0, len(rest), JOINED)]
        for group, ids in zip(groups, self._library(["".join(g) for g in groups]) if groups else ()):
            ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in group])
            bounds = np.concatenate([[0], np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1]).tolist()
            out.update((c, ids[a:b].tobytes()) for c, a, b in zip(group, bounds[:-1], bounds[1:]))
        return out

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks, from the table where it has them."""
        if self.kept_bytes > KEPT_BYTES:
            self.kept, self.kept_bytes = {}, 0
        missing = list({c for c in chunks if c not in self.kept})
        fresh = self._joined(missing)
        out = [fresh[c] if c in fresh else self.kept[c] for c in chunks]
        for c, ids in fresh.items():
            if len(c) <= 64:
                self.kept[c] = ids
                self.kept_bytes += ENTRY_BYTES + len(c) + len(ids)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of whole texts, each as little-endian integers of the vocabulary's width."""
        texts = [t or "" for t in texts]
        marked = pc.replace_substring_regex(pa.array(texts, pa.large_string()), *BREAK)
        parts = pc.split_pattern(marked, " ")
        pieces, offsets = parts.values, parts.offsets.to_numpy()
        filled = np.diff(offsets) > 0
        first = np.zeros(len(pieces), bool)
        first[offsets[:-1][filled]] = True
        named = pc.if_else(pa.array(first), pc.binary_join_element_wise(NO_SPACE, pieces, NOTHING), pieces)
        coded = named.dictionary_encode()
        known = coded.dictionary.to_pylist()
        code = coded.indices.to_numpy()
        # A piece is a chunk with the space before it; a text where that is no cut is taken apart by itself.
        odd = np.array([not p or p[0].isspace() for p in known], bool)
        strange = np.add.reduceat(np.concatenate([odd[code], [False]]), offsets[:-1]) > 0
        strange &= filled
        ids = self._chunks([p[1:] if p[:1] == MARK else f" {p}" for p in known])
        sizes = np.array([len(x) for x in ids], np.int64) // self.width
        flat = np.frombuffer(b"".join(ids), self.kind)
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[code]
        ends = np.cumsum(lengths)
        # One gather for all texts: each chunk's ids are a stretch of `flat`.
        place = np.repeat(starts[code] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))
        gathered = flat[place]
        bounds = np.concatenate([[0], ends])[offsets]
        out = [gathered[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        for i, text in enumerate(texts):
            if MARK in text or any(s in text for s in self.special):
                out[i] = self._library([text])[0].tobytes()
            elif strange[i]:
                cut = CUT.split(text)
                names = list(dict.fromkeys(cut))
                table = dict(zip(names, self._chunks(names)))
                out[i] = b"".join(table[c] for c in cut)
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder; Spark's name for S3 is another than Arrow's."""
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3" + uri[3:]
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith(("file:", "/")) else (fs.LocalFileSystem(), uri)


def _rooted(spark: SparkSession, folder: str) -> str:
    """A folder without a scheme is one of Spark's default file system."""
    default = spark.conf.get("spark.hadoop.fs.defaultFS", None)
    return default.rstrip("/") + folder if default and folder.startswith("/") else folder


def _parts(ids: pa.Array, ties: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The shard of each row: by range of its id; rows of an id that is a bound, by their tie; null
    ids come first, by their tie over as many shards of their own."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    known = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
    low, high = np.searchsorted(bounds, known, side="left"), np.searchsorted(bounds, known, side="right")
    shards = len(bounds) + 1
    low, width = np.where(null, 0, low + shards), np.where(null, shards, high - low + 1)
    return low + (ties * width >> 32)


def _encode(batches: Iterator[pa.RecordBatch], tokenizer: str, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    tool = encoder(tokenizer)
    for batch in batches:
        texts, at = batch.column("text"), 0
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        while at < len(batch):
            # Texts are cut together up to a bound; a longer one is alone.
            stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BATCH_BYTES, side="right")))
            ids = tool.encode(texts.slice(at, stop - at).to_pylist())
            doc_id, ties = batch.column("doc_id").slice(at, stop - at), np.array([zlib.crc32(x) for x in ids], np.int64)
            yield pa.RecordBatch.from_pydict({
                "part": _parts(doc_id, ties, bounds).astype(np.int32), "doc_id": doc_id, "tie": ties, "ids": pa.array(ids, pa.binary()),
            })
            at = stop


def _write(frames: Iterator[pd.DataFrame], folder: str, width: int, end_id: int) -> Iterator[pd.DataFrame]:
    """Write a task's rows, which are in order, to a file for each of its shards."""
    end = end_id.to_bytes(width, "little")
    system, root = _place(folder)
    files, shard, path, records, tokens, at = (), -1, "", 0, 0, 0

    def finished() -> pd.DataFrame:
        for f in files:
            f.close()
        return pd.DataFrame({"shard": [shard], "path": [f"{folder}/{path}"], "records": [records], "tokens": [tokens]})

    try:
        for frame in frames:
            for part, doc_id, ids in zip(frame["part"], frame["doc_id"], frame["ids"]):
                if part != shard:
                    if files:
                        yield finished()
                    shard, records, tokens, at = int(part), 0, 0, 0
                    path = f"{shard:08d}-{uuid.uuid4().hex}"
                    system.create_dir(root, recursive=True)
                    files = tuple(system.open_output_stream(f"{root}/{path}.{kind}") for kind in ("bin", "idx"))
                known = not pd.isna(doc_id)
                payload = ID.pack(known, width, int(doc_id) if known else 0) + ids + end
                size = HEAD.pack(len(payload))
                files[0].write(b"".join((size, CRC.pack(masked(size)), payload, CRC.pack(masked(payload)))))
                files[1].write(ENTRY.pack(at, len(payload)))
                at += len(payload) + 16
                records += 1
                tokens += (len(payload) - ID.size) // width
        if files:
            yield finished()
    finally:
        for f in files:
            f.close()


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the shards and return their stored manifest `shard, path, records, tokens`."""
    spark = docs.sparkSession
    folder, width = _rooted(spark, folder), encoder(tokenizer).width
    # Shards are ranges of ids, drawn from the ids alone: one bound per shuffle partition.
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / shards for i in range(1, shards)] or [0.5]
    found = docs.select(F.percentile_approx("doc_id", shares, 100 * shards)).first()[0]
    bounds = np.array(found or [], np.int64)
    coded = docs.select("doc_id", "text").mapInArrow(
        lambda b: _encode(b, tokenizer, bounds), "part int, doc_id bigint, tie bigint, ids binary"
    )
    rows = coded.repartition("part").sortWithinPartitions("part", "doc_id", "tie")
    # Ids pass as text: beside a null, pandas would hold them as floats.
    rows = rows.select("part", F.col("doc_id").cast("string").alias("doc_id"), "ids")
    written = rows.mapInPandas(lambda f: _write(f, folder, width, end_id), "shard int, path string, records bigint, tokens bigint")
    return stored(written, "manifest")


def _payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    known, width, doc_id = ID.unpack(payload[: ID.size])
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", offset=ID.size).astype("<u4")


def read_shard(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """`(doc_id, ids)` of a shard in order, each checked against both checksums."""
    system, base = _place(path)
    with system.open_input_stream(f"{base}.bin", buffer_size=1 << 20) as f:
        while head := f.read(12):
            (size,), (crc,) = HEAD.unpack(head[:8]), CRC.unpack(head[8:])
            if crc != masked(head[:8]):
                raise ValueError(f"damaged length in {path}")
            payload = f.read(size)
            if CRC.unpack(f.read(4))[0] != masked(payload):
                raise ValueError(f"damaged record in {path}")
            yield _payload(payload)


def read_record(path: str, number: int) -> tuple[int | None, np.ndarray]:
    """One record by its number in the shard, through the offset index."""
    system, base = _place(path)
    with system.open_input_file(f"{base}.idx") as f:
        at, size = ENTRY.unpack(f.read_at(ENTRY.size, number * ENTRY.size))
    with system.open_input_file(f"{base}.bin") as f:
        payload = f.read_at(size, at + 12)
        if CRC.unpack(f.read_at(4, at + 12 + size))[0] != masked(payload):
            raise ValueError(f"damaged record in {path}")
    return _payload(payload)


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path, start in zip(frame["path"], frame["start"]):
            rows = []
            for doc_id, ids in read_shard(path):
                rows.append((doc_id, start, len(ids), zlib.crc32(ids)))
                start += len(ids)
                if len(rows) == 5_000:
                    yield _frame(rows)
                    rows = []
            if rows:
                yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    ids, starts, sizes, crcs = zip(*rows)
    return pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "start": starts, "n_tokens": sizes, "ids_crc32": crcs})


def read_summary(manifest: DataFrame) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of every record of the shards, read from the files."""
    # One row per shard: their sums are small however large the shards are.
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("path", F.coalesce(before, F.lit(0)).alias("start"), "shard")
    return shards.repartition("path").select("path", "start").mapInPandas(_read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_records(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the records of `docs` below the shared folder, read them back and return the summary.

    A null or empty text is the end id alone. Rows without `doc_id` come first; rows of one id
    follow a hash of their ids. Other columns are ignored; no row gives no file.
    """
    spark: SparkSession = docs.sparkSession
    return read_summary(write_records(docs, shared_folder(spark, "token-records"), tokenizer, end_id))
