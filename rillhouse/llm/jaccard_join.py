"""N-gram Jaccard join by PartEnum signatures over 5-word shingles.

Sets whose sizes allow the similarity lie in the same or in neighbouring size bands. For the sets
of two neighbouring bands the Hamming distance of a similar pair is at most `k`, so when the hash
domain is cut into more than `k` partitions, some partitions of the two sets are equal. Each
partition of a set gives one signature; similar sets share one. A set with so few occupied
partitions that only empty ones might agree gives signatures for its empty partitions too.

At most `k` partitions differ, so a similar pair shares all but `k` signatures of either set. A set
that shares fewer with anybody is done, and of the others only the rarest ones are joined, as many
as it takes to hold one that a similar set shares too: passages that many dissimilar sets share are
among the rest. Sets of one band meet in that band alone, not in the one above too.

Equal sets are one class throughout, so copies never meet in a join. Signatures shared by several
classes give candidates in two steps: neighbours within a signature, whose verified links are
closed to components first, then the pairs of different components that are left. Of a family of near
copies nearly all are one component by then, and only the others are held against the rest. Parity
sketches bound the Hamming distance from below inside that join, and a pair that shares many signatures
is taken at the first of them, not at each; sketches in proportion to a set's size bound the distance
again for the pairs of large sets, so that hardly more than true links are compared by whole sets.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillhouse.llm.common import components, discard, mix, small_batches, space_word_hashes, stored

WIDTH = 5
SIMILARITY = Fraction(4, 5)
#: Bits of the bitmap of wanted documents; it is broadcast and never larger, however many there are.
BITMAP_BITS = 1 << 26
#: Longs of a parity sketch; sets of more shingles than it has bits get a wide one beside it.
SKETCH = 8
SETS = "doc_id bigint, n_shingles bigint, key bigint, sketch array<bigint>, wide array<bigint>"
#: Texts are hashed together up to about so many characters, and so many texts.
CHUNK_CHARS, CHUNK_TEXTS = 200_000, 500
#: Neighbours per class that the first step verifies.
NEAREST = 3
#: Signatures before its own that a row keeps, by which a pair knows that it has met already.
EARLIER = 16


def text_chunks(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Texts in order, in lists bounded in characters and in number; a longer text is alone."""
    chunk, size = [], 0
    for text in texts:
        text = text or ""
        if chunk and (size + len(text) > CHUNK_CHARS or len(chunk) == CHUNK_TEXTS):
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    if chunk:
        yield chunk


class Sets:
    """Shingle sets of some texts: sorted distinct hashes, set after set, and the size of each.

    A text of fewer words than the width is one shingle, a wordless one has none. The steps run
    over all texts at once, as most texts are too short to be worth a numpy call of their own.
    """

    def __init__(self, texts: list[str], width: int = WIDTH):
        raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        words, starts = space_word_hashes(b" ".join(raw))
        ends = np.cumsum([len(r) + 1 for r in raw])
        of = np.searchsorted(ends, starts, side="right")
        n_words = np.bincount(of, minlength=len(raw))
        counts = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
        before, first = np.cumsum(counts) - counts, np.cumsum(n_words) - n_words
        items = np.empty(int(counts.sum()), np.uint64)
        if len(words) >= width:
            last = len(words) - width + 1
            inside = of[:last] == of[width - 1 :]
            items[np.repeat(n_words >= width, counts)] = self._roll(words, width)[inside]
        for i in np.flatnonzero((n_words > 0) & (n_words < width)):
            items[before[i]] = self._roll(words[first[i] : first[i] + n_words[i]], int(n_words[i]))[0]
        for low, high in zip(before[counts > 1], (before + counts)[counts > 1]):
            items[low:high].sort()
        rows = np.repeat(np.arange(len(raw)), counts)
        fresh = _changes(items, rows)
        self.items, self.rows = items[fresh], rows[fresh]
        self.sizes = np.bincount(self.rows, minlength=len(raw))
        self.starts = np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def _roll(words: np.ndarray, span: int) -> np.ndarray:
        rolled = np.zeros(len(words) - span + 1, np.uint64)
        for j in range(span):
            rolled = rolled * np.uint64(0xFF51AFD7ED558CCD) + words[j : len(words) - span + 1 + j]
        return mix(rolled + np.uint64(span))

    def keys(self) -> np.ndarray:
        """Identity of each whole set, from its size, sum and exclusive or; 0 for an empty one."""
        out, some = np.zeros(len(self.sizes), np.int64), self.sizes > 0
        if some.any():
            sums = np.add.reduceat(self.items, self.starts[some])
            odd = np.bitwise_xor.reduceat(mix(self.items), self.starts[some])
            sizes = self.sizes[some].astype(np.uint64)
            out[some] = mix(sizes * np.uint64(31) + mix(sums) + mix(odd + np.uint64(7))).view(np.int64)
        return out

    def sketches(self) -> np.ndarray:
        """Parities of the counts in 64 * SKETCH blocks: they differ at most as often as the sets do."""
        n, blocks = len(self.sizes), mix(self.items + np.uint64(0x51_7C_C1_B7)) % np.uint64(64 * SKETCH)
        counts = np.bincount(self.rows * 64 * SKETCH + blocks.astype(np.int64), minlength=n * 64 * SKETCH)
        return np.packbits((counts & 1).astype(np.uint8).reshape(n, 64 * SKETCH), axis=1).view(np.int64)

    def wide_sketches(self) -> list[np.ndarray | None]:
        """Such parities with at least a bit a shingle, a power of two of longs; none for small sets."""
        out = [None] * len(self.sizes)
        for i in np.flatnonzero(self.sizes > 64 * SKETCH):
            bits = 1 << int(self.sizes[i] - 1).bit_length()
            blocks = (mix(self.of(i) + np.uint64(0x51_7C_C1_B7)) & np.uint64(bits - 1)).astype(np.int64)
            out[i] = np.packbits((np.bincount(blocks, minlength=bits) & 1).astype(np.uint8)).view(np.int64)
        return out

    def of(self, i: int) -> np.ndarray:
        return self.items[self.starts[i] : self.starts[i] + self.sizes[i]]


def _changes(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it, or its row does."""
    out = np.ones(len(values), bool)
    out[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return out


class Bands:
    """Size bands: sets of one band are similar only to sets of it and its neighbours."""

    def __init__(self, similarity: Fraction = SIMILARITY):
        self.similarity, self.lows = similarity, [1]

    def of(self, size: int) -> int:
        while self.lows[-1] <= size:
            self.lows.append(int(self.lows[-1] / self.similarity) + 1)
        return int(np.searchsorted(self.lows, size, side="right")) - 1

    def distance(self, band: int) -> int:
        """Greatest Hamming distance of a similar pair from this band and the one below."""
        self.of(self.lows[min(band, len(self.lows) - 1)])
        while len(self.lows) <= band + 1:
            self.lows.append(int(self.lows[-1] / self.similarity) + 1)
        return int(2 * (self.lows[band + 1] - 1) * (1 - self.similarity) / (1 + self.similarity))


def signatures(sets: Sets, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """PartEnum signatures of each set, for its own band and for the one above, their sets and needs.

    The need is how many signatures of its band a similar set must share, negative for the band above.
    Agreeing empty partitions give none where only occupied ones do, so they are taken off it.
    """
    sigs, owners, needs = [], [], []
    if not len(sets.items):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    own = np.array([bands.of(int(n)) for n in sets.sizes])
    mixed, high = mix(sets.items), sets.items >> np.uint64(32)
    for band, sign in ((own, 1), (own + 1, -1)):
        k = np.array([bands.distance(b) for b in band.tolist()])
        parts = np.where(k > 0, (1.15 * k).astype(np.int64) + 6, 1).astype(np.uint64)
        salts = (band + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        at = (high * parts[sets.rows]) >> np.uint64(32)
        starts = np.flatnonzero(_changes(at, sets.rows))
        owner = sets.rows[starts]
        sigs.append(mix(np.add.reduceat(mixed, starts) + mix(at[starts] + salts[owner])))
        owners.append(owner)
        occupied = np.bincount(owner, minlength=len(sets.sizes))
        need = (sign * np.maximum(occupied - k, 1)).astype(np.int32)
        needs.append(need[owner])
        for i in np.flatnonzero((sets.sizes > 0) & (occupied <= k)):
            empty = np.setdiff1d(np.arange(parts[i], dtype=np.uint64), at[starts[owner == i]])
            sigs.append(mix(mix(empty + salts[i]) ^ np.uint64(0xE703_7ED1_A0B4_28DB)))
            owners.append(np.full(len(empty), i))
            needs.append(np.full(len(empty), need[i]))
    return np.concatenate(sigs).view(np.int64), np.concatenate(owners), np.concatenate(needs)


def _sets(frames: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        at = 0
        for texts in text_chunks(frame["text"]):
            sets, ids = Sets(texts, width), frame["doc_id"].iloc[at : at + len(texts)]
            at += len(texts)
            some = sets.sizes > 0
            yield pd.DataFrame({
                "doc_id": ids.array,
                "n_shingles": sets.sizes,
                # Through a float, as pandas holds integers beside nulls, a key would lose its last bits.
                "key": pd.arrays.IntegerArray(sets.keys(), ~some),
                "sketch": [s if known else None for s, known in zip(sets.sketches(), some)],
                "wide": sets.wide_sketches(),
            })


def _signature_rows(frames: Iterator[pd.DataFrame], width: int, similarity: Fraction) -> Iterator[pd.DataFrame]:
    seen, bands = set(), Bands(similarity)
    for frame in frames:
        for texts in text_chunks(frame["text"]):
            sets = Sets(texts, width)
            keys = sets.keys()
            # Copies of a set within a task give its signatures once.
            fresh = np.zeros(len(texts), bool)
            for i in np.flatnonzero(sets.sizes):
                if (key := int(keys[i])) not in seen:
                    seen.add(key)
                    fresh[i] = True
            sigs, owners, needs = signatures(sets, bands)
            chosen = fresh[owners]
            yield pd.DataFrame({"sig": sigs[chosen], "key": keys[owners[chosen]], "need": needs[chosen]})


def _wanted_sets(frames: Iterator[pd.DataFrame], width: int, wanted: np.ndarray) -> Iterator[pd.DataFrame]:
    for frame in frames:
        bits = frame["bit"].to_numpy(np.int64)
        chosen = (wanted[bits >> 6] >> (bits & 63).astype(np.uint64) & np.uint64(1)).tolist()
        for texts in text_chunks(itertools.compress(frame["text"], chosen)):
            sets = Sets(texts, width)
            some = np.flatnonzero(sets.sizes)
            items = [sets.of(i).view(np.int64) for i in some]
            yield pd.DataFrame({"key": sets.keys()[some], "items": items}, columns=["key", "items"])


def _bit(doc_id):
    return F.pmod(F.xxhash64(doc_id), F.lit(BITMAP_BITS))


def _differ(one: str, two: str) -> Column:
    """In how many bits two wide sketches differ, the longer one folded to the length of the other.

    Sizes that allow the similarity are less than a factor of two apart, so folding once is enough.
    Null where either set has none.
    """

    def folded(x: str, y: str) -> Column:
        half = F.size(y)
        halves = F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > half, halves).otherwise(F.col(x))

    both = F.zip_with(folded(one, two), folded(two, one), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.when(
        F.col(one).isNotNull() & F.col(two).isNotNull(), F.aggregate(both, F.lit(0), lambda total, n: total + n)
    )


def _likely(pairs: DataFrame, classes: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs `(a, b)` whose wide sketches leave room for the similarity."""
    one = classes.select(F.col("key").alias("a"), F.col("n_shingles").alias("n"), F.col("wide").alias("wide_a"))
    two = classes.select(F.col("key").alias("b"), F.col("n_shingles").alias("m"), F.col("wide").alias("wide_b"))
    p, q = similarity.numerator, similarity.denominator
    room = _differ("wide_a", "wide_b") * (q + p) <= (F.col("n") + F.col("m")) * (q - p)
    return pairs.join(one, "a").join(two, "b").where(F.coalesce(room, F.lit(True))).select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, similarity: Fraction) -> DataFrame:
    """The links `(a, b)` of classes among stored pairs, by their whole sets; what was stored goes."""
    spark = docs.sparkSession
    pairs, given = stored(_likely(pairs, classes, similarity), "likely"), pairs
    discard(given)
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    bits = keys.join(classes, "key").select(_bit(F.col("first_id")).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")
    )
    bitmap = np.zeros(BITMAP_BITS >> 6, np.int64)
    for r in words.toLocalIterator():
        bitmap[r["word"]] = r["bits"]
    wanted = spark.sparkContext.broadcast(bitmap.view(np.uint64))
    sets = docs.select(_bit(F.col("doc_id")).alias("bit"), "text").mapInPandas(
        lambda frames: _wanted_sets(frames, width, wanted.value), "key bigint, items array<bigint>"
    )
    # Both sides of the join read them; unstored, every text would be hashed twice.
    sets = stored(sets, "wanted-sets")
    left = sets.select(F.col("key").alias("a"), F.col("items").alias("left_items"))
    right = sets.select(F.col("key").alias("b"), F.col("items").alias("right_items"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("left_items", "right_items")).cast("bigint")
    union = F.size("left_items") + F.size("right_items") - shared
    links = both.where(shared * similarity.denominator >= union * similarity.numerator)
    links = stored(links.select("a", "b").distinct(), "links")
    discard(sets, pairs)
    return links


def _close(one: str, two: str, similarity: Fraction):
    """Whether sizes and sketches of two classes leave room for the similarity."""
    n, m = F.col(f"{one}.n_shingles"), F.col(f"{two}.n_shingles")
    differ = sum(
        (F.bit_count(F.col(f"{one}.sketch")[i].bitwiseXOR(F.col(f"{two}.sketch")[i])) for i in range(SKETCH)), F.lit(0)
    )
    p, q = similarity.numerator, similarity.denominator
    return (
        (F.least(n, m) * q >= F.greatest(n, m) * p) & (differ * (q + p) <= (n + m) * (q - p))
    )


def _joined_components(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components `(node, component)` of `parts` after further links `(a, b)`.

    Only the links between components are closed, so what the first closure found is not walked again.
    """
    one = parts.select(F.col("node").alias("a"), F.col("component").alias("one"))
    two = parts.select(F.col("node").alias("b"), F.col("component").alias("two"))
    between = links.join(one, "a", "left").join(two, "b", "left")
    upper = components(between.select(F.coalesce("one", "a").alias("a"), F.coalesce("two", "b").alias("b")))
    moved = upper.select(F.col("node").alias("component"), F.col("component").alias("low"))
    known = parts.join(moved, "component", "left").select("node", F.coalesce("low", "component").alias("component"))
    return known.unionAll(upper.join(parts, "node", "left_anti"))


def _neighbours(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows `sig, key` of signatures that several classes have, each once, with the key `before` it."""
    by_sig = Window.partitionBy("sig").orderBy("key")
    so_far = by_sig.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.select(
        *columns, F.lag("key").over(by_sig).alias("before"), F.lead("key").over(by_sig).alias("after"),
        F.first("key").over(so_far).alias("lowest"),
    )
    # A class may come from several tasks; of the lowest one the last row sees whether there is another.
    both = both.where(F.when(F.col("lowest") == F.col("key"), F.expr("after <> key")).otherwise(F.expr("before <> key")))
    return both.select(*columns, F.expr("nullif(before, key)").alias("before"))


def _shared(rows: DataFrame) -> DataFrame:
    """`(sig, key, own, before)` of the signatures `sig, key, need` that a similar pair meets on.

    A set and its similar one share `need` signatures. In an order that is the same for all sets,
    the first shared one of these has `need - 1` others behind it, so the last `need - 1` of each
    set may go; in order of rarity these are the common ones. The signatures are those of the band
    that one of the two is of, so one that all its sets have for the band above theirs is not among them.
    """
    met = _neighbours(rows, "sig", "key", "need")
    by_sig = Window.partitionBy("sig")
    met = met.withColumns({"sharing": F.count("*").over(by_sig), "own": F.max("need").over(by_sig) > 0})
    met = met.where("own").drop("own", "before")
    of_set = Window.partitionBy("key", "need")
    ranked = met.withColumns({
        "rank": F.row_number().over(of_set.orderBy("sharing", "sig")), "all": F.count("*").over(of_set),
    })
    ranked = ranked.where(F.col("rank") <= F.col("all") - F.abs("need") + 1)
    return _neighbours(ranked.withColumn("own", F.col("need") > 0), "sig", "key", "own")


def _open(known: DataFrame) -> DataFrame:
    """The rows `sig, key, own, component` of signatures on which different components may meet.

    Each has the component `main` that most sets of its signature are of, and in `earlier` the last
    signatures of its set and band that come before its own.
    """
    known = known.repartition("sig")
    sizes = known.groupBy("sig", "component").agg(F.count("*").alias("n"), F.bool_or("own").alias("own"))
    spread = sizes.groupBy("sig").agg(
        F.count("*").alias("several"), F.bool_or("own").alias("own"),
        F.max(F.struct("n", "component"))["component"].alias("main"),
    )
    left = known.join(spread.where("several > 1 and own").select("sig", "main"), "sig")
    of_set = Window.partitionBy("key", "own").orderBy("sig").rowsBetween(-EARLIER, -1)
    return left.withColumn("earlier", F.collect_list("sig").over(of_set))


def _meetings(left: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs `(a, b)` of open rows of different components whose sizes and sketches leave room.

    A pair is taken at a signature unless it shares one of the earlier ones of both sets, so always at
    the first that it shares and hardly at another. Rows of the main component meet the others only.
    """
    one, two = left.where("component <> main").alias("one"), left.alias("two")
    return one.join(
        two,
        (F.col("one.sig") == F.col("two.sig"))
        & (F.col("one.component") != F.col("two.component"))
        & ((F.col("two.component") == F.col("two.main")) | (F.col("one.key") < F.col("two.key")))
        & (F.col("one.own") | F.col("two.own"))
        & _close("one", "two", similarity)
        & ~F.arrays_overlap("one.earlier", "two.earlier"),
    ).select(F.col("one.key").alias("a"), F.col("two.key").alias("b"))


def linked_classes(docs: DataFrame, sets: DataFrame, width: int = WIDTH, similarity: Fraction = SIMILARITY) -> DataFrame:
    """`(key, component)` of every class of equal sets that is similar to another class."""
    classes = sets.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"),
        F.first("wide").alias("wide"),
    )
    classes = stored(classes, "classes")
    rows = (
        docs.select("text")
        .mapInPandas(lambda f: _signature_rows(f, width, similarity), "sig bigint, key bigint, need int")
    )
    shared = stored(_shared(rows), "shared")

    near = shared.where("before is not null").groupBy(F.col("key").alias("a"), F.col("before").alias("b")).count()
    seen = classes.select("key", "n_shingles", "sketch")
    near = (
        near.join(seen.alias("one"), F.col("a") == F.col("one.key"))
        .join(seen.alias("two"), F.col("b") == F.col("two.key"))
        .where(_close("one", "two", similarity))
        .select("a", "b", "count")
    )
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("count"), "b"))
    near = stored(near.withColumn("rank", best).where(F.col("rank") <= NEAREST).select("a", "b"), "near")
    links = _verified(near, docs, classes, width, similarity)
    parts = components(links)

    known = shared.select("sig", "key", "own").join(parts.withColumnRenamed("node", "key"), "key", "left")
    known = known.withColumn("component", F.coalesce("component", "key"))
    left = stored(_open(known).join(seen, "key"), "open")
    rest = _meetings(left, similarity)
    rest = stored(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "rest")
    discard(shared, left)
    more = _verified(rest, docs, classes, width, similarity)
    whole = _joined_components(parts, more)
    first = whole.join(classes, F.col("node") == F.col("key"))
    low = first.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return first.join(low, "component").select("key", "component_id")


def near_components(docs: DataFrame, width: int = WIDTH, similarity: Fraction = SIMILARITY) -> DataFrame:
    """One row per document: `doc_id, n_shingles, component_id`.

    `docs` needs `doc_id` and `text`; other columns are ignored. The component is the smallest
    `doc_id` reachable over links of at least `similarity`. A null, empty or wordless text has no
    shingle and is its own component. Rows without `doc_id` keep a null component and link nothing;
    repeated rows are copies. No row gives an empty result.
    """
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    whole = docs.where("doc_id is not null")
    sets = stored(
        whole.mapInPandas(
            lambda f: _sets(f, width), SETS
        ),
        "sets",
    )
    linked = linked_classes(whole, sets, width, similarity)
    equal = sets.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first_id"))
    named = equal.join(linked, "key", "left").select("key", F.coalesce("component_id", "first_id").alias("component_id"))
    out = sets.drop("sketch", "wide").join(named, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    lost = docs.where("doc_id is null").mapInPandas(
        lambda f: _sets(f, width), SETS
    )
    return out.unionAll(lost.select("doc_id", "n_shingles", F.lit(None).cast("bigint").alias("component_id")))
