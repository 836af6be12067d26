"""Near vectors by a robust-pruned flat graph over overlapping cluster shards.

Equal vectors are one node. Nodes are dealt to the shards of their nearest centres, several each,
and shards that are still too large are dealt again by centres of their own. Each shard builds a
graph in its task: candidates are the nearest nodes and some far ones, and an edge is pruned when
an earlier edge already leads nearer to its end. The adjacency lists of a node are united over its
shards. Then every node is a query: from its shard's medoid and its own place, a beam walks the
united graph, and a beam that fills with vectors in range grows, up to a block product with the
whole shard. Links found are verified by cosine in double precision.

A pair is counted in one shard only, the lowest that both nodes are in, so tasks return a sum and a
component per node and never a row per pair. Vectors that no centres tell apart are cut into
parts, and each pair of parts is a shard of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import components, stored

COSINE = 0.95
#: Most nodes of a shard; rows that the centres of one shard are fitted on; shards a node is in.
SHARD, SAMPLE, OVERLAP = 2048, 8192, 2
#: Most centres of one split and most rounds of splitting; nodes that one task deals to centres.
FAN, LEVELS, DEALT = 512, 3, 20_000
#: Centres of at least this cosine are one, so that a group of near vectors is not cut between centres.
ALIKE = 0.8
#: Edges a node keeps to vectors in range and to others; how much an edge may be a detour.
IN_RANGE, FAR, DETOUR = 16, 16, 1.2
#: Beam widths; beyond the last, a query is compared with its whole shard.
BEAMS = (24, 96)
#: Queries of the audit, and the recall under which shards overlap twice as much.
AUDIT, RECALL = 128, 0.9
BLOCK = 512


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of an array column as unit vectors; shorter rows are filled with zeros."""
    rows = column.combine_chunks()
    rows = rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows
    sizes = np.diff(rows.offsets.to_numpy())
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), int(sizes.max(initial=1))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    # Scaled by the largest component first: squares of huge or tiny ones would leave the range.
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _fitted(width: int, size: int):
    def fit(rows: pa.Table) -> pa.Table:
        """Spherical k-means over a shard's sample, from its first rows by hash."""
        rows = rows.sort_by("node")
        x, shard, n = _matrix(rows["v"]), rows["shard"][0].as_py(), rows["n"][0].as_py()
        k = min(FAN, max(2, -(-n * width * 2 // size)), len(x))
        centres = x[np.random.default_rng(len(x)).permutation(len(x))[:k]]
        for _ in range(8):
            near = np.concatenate([(x[a : a + BLOCK] @ centres.T).argmax(1) for a in range(0, len(x), BLOCK)])
            sums = np.zeros_like(centres)
            np.add.at(sums, near, x)
            norms = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
        # Centres inside one dense group would cut it; of centres that are alike the first stays.
        apart = []
        for i, c in enumerate(centres):
            if not apart or (centres[apart] @ c).max() < ALIKE:
                apart.append(i)
        k = len(apart) if len(apart) > 1 else 0
        return pa.table({"shard": pa.array([shard] * k, pa.int64()), "centre": pa.array(list(centres[apart[:k]]), pa.list_(pa.float64()))})

    return fit


def _dealt(width: int):
    def deal(members: pa.Table, centres: pa.Table) -> pa.Table:
        """Each member to the shards of its nearest centres of the same shard."""
        if not members.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "to": pa.array([], pa.int64())})
        x, c = _matrix(members["v"]), _matrix(centres["centre"])
        d = max(x.shape[1], c.shape[1])
        x, c = (np.pad(m, ((0, 0), (0, d - m.shape[1]))) for m in (x, c))
        width_here = min(width, len(c))
        near = np.concatenate([np.argsort(-(x[a : a + BLOCK] @ c.T), 1, kind="stable")[:, :width_here] for a in range(0, len(x), BLOCK)])
        shard = members["shard"][0].as_py()
        to = shard * (FAN + 1) + near.astype(np.int64) + 1
        return pa.table({"node": np.repeat(members["node"].to_numpy(), width_here), "to": to.ravel()})

    return deal


def shards(nodes: DataFrame, width: int = OVERLAP, size: int = SHARD) -> DataFrame:
    """`node, v, shard, parts`: every node in the shards of its nearest centres.

    A shard above `size` is dealt to centres fitted on a sample of about SAMPLE of its nodes. One
    that no centres tell apart, or that is still too large after LEVELS rounds, says in `parts`
    into how many parts to cut it.
    """
    members = stored(nodes.select("node", "v", F.lit(0).cast("bigint").alias("shard")), "members")
    for level in range(LEVELS):
        sizes = stored(members.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > size), "large")
        if sizes.isEmpty():
            break
        large = members.join(sizes, "shard")
        # Ranks by hash would sort a shard in one task; a share of the hash range holds about SAMPLE rows.
        sample = large.where(F.pmod(F.xxhash64("node", F.lit(level)), F.col("n")) < SAMPLE)
        centres = sample.groupBy("shard").applyInArrow(_fitted(width, size), "shard bigint, centre array<double>")
        centres = stored(centres, "centres")
        if centres.isEmpty():
            break
        sizes = sizes.join(centres.select("shard").distinct(), "shard", "left_semi")
        large = large.join(sizes.select("shard"), "shard", "left_semi")
        salts = F.ceil(F.col("n") / DEALT).cast("bigint")
        salted = large.withColumn("salt", F.pmod(F.xxhash64("node", F.lit("salt")), salts)).drop("n")
        copies = centres.join(sizes, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).drop("n")
        dealt = salted.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInArrow(_dealt(width), "node bigint, to bigint")
        moved = stored(dealt.distinct(), "dealt").join(nodes.select("node", "v"), "node").select("node", "v", F.col("to").alias("shard"))
        members = stored(members.join(sizes, "shard", "left_anti").select("node", "v", "shard").unionByName(moved), "members")
    sizes = members.groupBy("shard").agg(F.ceil(F.count("*") * 2 / size).cast("int").alias("parts"))
    parts = F.when(F.col("parts") <= 2, 1).otherwise(F.col("parts"))
    return members.join(sizes.withColumn("parts", parts), "shard")


def blocks(members: DataFrame) -> DataFrame:
    """`node, v, homes, shard, one, two, part`: members as tasks see them, `homes` being all shards of the node.

    A shard of several parts becomes one block for each pair of parts; a node is in the blocks of
    its own part, so every two nodes of a shard meet in exactly one block or, of one part, first in
    the block of the part with itself.
    """
    homes = members.groupBy("node").agg(F.array_sort(F.collect_set("shard")).alias("homes"))
    part = F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts")).cast("int")
    met = members.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select("node", "v", "shard", "part", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"))
    return met.join(homes, "node")


def pruned(x: np.ndarray, cosine: float, in_range: int = IN_RANGE, far: int = FAR, detour: float = DETOUR) -> np.ndarray:
    """The robust-pruned graph over unit vectors: ends of at most `in_range + far` edges a node, -1 where none."""
    n, f = len(x), x.astype(np.float32)
    wanted = min(n - 1, 4 * far)
    rng = np.random.default_rng(n)
    out = np.full((n, in_range + far), -1, np.int64)
    for a in range(0, n, BLOCK):
        own = np.arange(a, min(a + BLOCK, n))
        sims = f[own] @ f.T
        sims[np.arange(len(own)), own] = -np.inf
        near = np.argpartition(-sims, wanted - 1, 1)[:, :wanted]
        # Nodes in range would use up the edges of a dense place, so the two kinds are pruned apart.
        low = np.where(sims >= cosine - 1e-4, -np.inf, sims)
        others = np.concatenate([np.argpartition(-low, wanted - 1, 1)[:, :wanted], rng.integers(0, n, (len(own), far))], 1)
        for cand, first, most, keep in ((near, 0, in_range, True), (others, in_range, far, False)):
            s = np.take_along_axis(sims, cand, 1)
            inside = s >= cosine - 1e-4
            open_ = (inside if keep else ~inside) & np.isfinite(s)
            order = np.argsort(-np.where(open_, s, -np.inf), 1, kind="stable")
            cand, s, open_ = (np.take_along_axis(y, order, 1) for y in (cand, s, open_))
            ends = f[cand]
            for slot in range(first, first + most):
                rows = np.flatnonzero(open_.any(1))
                if not len(rows):
                    break
                at = open_[rows].argmax(1)
                chosen = cand[rows, at]
                out[own[rows], slot] = chosen
                between = np.einsum("rd,rcd->rc", f[chosen], ends[rows])
                # Squared distances of unit vectors: an end nearer to the chosen node than to its own goes.
                open_[rows] &= (detour**2 * (1 - between) > 1 - s[rows]) & (cand[rows] != chosen[:, None])
    return out


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(0)).argmax())


def _both_ways(x: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges, and their reversals into each node from its nearest, as many as it may have of its own."""
    froms, ends = np.nonzero(edges >= 0)[0], edges[edges >= 0]
    order = np.lexsort((-np.einsum("rd,rd->r", x[froms], x[ends]), ends))
    into = ends[order]
    rank = np.arange(len(into)) - np.searchsorted(into, into)
    back = order[rank < edges.shape[1]]
    return np.concatenate([froms, ends[back]]), np.concatenate([ends, froms[back]])


def _built(cosine: float):
    def build(rows: pa.Table) -> pa.Table:
        """Edges of a shard: the pruned ones both ways, and a door into each part the medoid does not reach."""
        rows = rows.sort_by("node")
        ids, x = rows["node"].to_numpy(), _matrix(rows["v"])
        if len(ids) < 2:
            return pa.table({"node": pa.array([], pa.int64()), "end": pa.array([], pa.int64())})
        froms, ends = _both_ways(x, pruned(x, cosine))
        order = np.argsort(froms, kind="stable")
        starts = np.searchsorted(froms[order], np.arange(len(ids) + 1))
        seen, more = np.zeros(len(ids), bool), []

        def walk(front: np.ndarray) -> None:
            while len(front):
                seen[front] = True
                front = np.unique(np.concatenate([ends[order[starts[i] : starts[i + 1]]] for i in front]))
                front = front[~seen[front]]

        walk(np.array([medoid(x)]))
        while not seen.all():
            lost, doors = int((~seen).argmax()), np.flatnonzero(seen)
            door = int(doors[(x[doors] @ x[lost]).argmax()])
            more += [(door, lost), (lost, door)]
            walk(np.array([lost]))
        extra = np.array(more, np.int64).reshape(-1, 2)
        return pa.table({"node": ids[np.concatenate([froms, extra[:, 0]])], "end": ids[np.concatenate([ends, extra[:, 1]])]})

    return build


def graph(met: DataFrame, cosine: float = COSINE) -> DataFrame:
    """`node, ends`: the adjacency lists of all shards, united by node."""
    edges = met.groupBy("shard", "one", "two").applyInArrow(_built(cosine), "node bigint, end bigint")
    return edges.distinct().groupBy("node").agg(F.collect_list("end").alias("ends"))


def searched(x: np.ndarray, offsets: np.ndarray, ends: np.ndarray, start: int, queries: np.ndarray, cosine: float):
    """Yields `(query, found)` index arrays of vectors in range, by greedy search over the graph.

    `ends[offsets[i]:offsets[i + 1]]` are the neighbours of `i`. Beams start at the medoid and at
    the query's own node; those that fill with vectors in range start again wider.
    """
    f, n = x.astype(np.float32), len(x)
    degree = np.diff(offsets)
    width = int(degree.max(initial=1))
    table = np.full((n, width), -1, np.int64)
    table[np.arange(width) < degree[:, None]] = ends
    todo = queries
    for beam in BEAMS:
        full = []
        for a in range(0, len(todo), BLOCK):
            q = todo[a : a + BLOCK]
            ids = np.full((len(q), beam), -1, np.int64)
            sims = np.full((len(q), beam), -np.inf, np.float32)
            fresh = np.zeros((len(q), beam), bool)
            seen = np.zeros((len(q), n), bool)
            ids[:, 0], ids[:, 1] = q, start
            sims[:, 0], sims[:, 1] = 1, np.where(q == start, -np.inf, f[q] @ f[start])
            fresh[:, :2] = np.isfinite(sims[:, :2])
            seen[np.arange(len(q)), q] = seen[:, start] = True
            while True:
                ranked = np.where(fresh, sims, -np.inf)
                at = ranked.argmax(1)
                rows = np.flatnonzero(np.isfinite(ranked[np.arange(len(q)), at]))
                if not len(rows):
                    break
                at = at[rows]
                fresh[rows, at] = False
                step = table[ids[rows, at]]
                new = (step >= 0) & ~seen[rows[:, None], step]
                seen[rows[:, None], np.where(step >= 0, step, q[rows][:, None])] = True
                s = np.einsum("rd,rcd->rc", f[q[rows]], f[step])
                s[~new] = -np.inf
                all_ids, all_sims = np.concatenate([ids[rows], step], 1), np.concatenate([sims[rows], s], 1)
                all_fresh = np.concatenate([fresh[rows], new], 1)
                best = np.argpartition(-all_sims, beam - 1, 1)[:, :beam]
                ids[rows], sims[rows], fresh[rows] = (np.take_along_axis(y, best, 1) for y in (all_ids, all_sims, all_fresh))
            inside = np.isfinite(sims) & (sims >= cosine - 1e-3)
            over = inside.sum(1) > beam // 2
            full.append(q[over])
            r, c = np.nonzero(inside & ~over[:, None])
            yield q[r], ids[r, c]
        todo = np.concatenate(full) if full else todo[:0]
    for a in range(0, len(todo), BLOCK):
        q = todo[a : a + BLOCK]
        r, c = np.nonzero(f[q] @ f.T >= cosine - 1e-3)
        yield q[r], c


def _linked(cosine: float):
    def link(rows: pa.Table) -> pa.Table:
        """`node, n_links, low`: a block's share of the links of nodes that have any, and the lowest node they lead to."""
        rows = rows.sort_by("node")
        ids, x = rows["node"].to_numpy(), _matrix(rows["v"])
        n, copies, part = len(ids), rows["copies"].to_numpy(), rows["part"].to_numpy()
        sizes = pa.compute.list_value_length(rows["v"]).to_numpy()
        shard, one, two = (rows[c][0].as_py() for c in ("shard", "one", "two"))
        homes = [frozenset(h) for h in rows["homes"].to_pylist()]
        lists = rows["ends"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(n), pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        place = np.searchsorted(ids, ends)
        here = (place < n) & (ids[np.minimum(place, n - 1)] == ends)
        owner, place = owner[here], place[here]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
        found = np.zeros((n, n), bool)
        if n > 1:
            for q, other in searched(x, offsets, place, medoid(x), np.arange(n), cosine):
                found[q, other] = True
        found |= found.T
        np.fill_diagonal(found, False)
        n_links, linked = np.zeros(n, np.int64), np.zeros((n, n), bool)
        # Whether this shard is the first that two nodes share is a question of their two sets of shards.
        kinds = {k: i for i, k in enumerate(dict.fromkeys(homes))}
        kind = np.array([kinds[h] for h in homes])
        first = np.array([[min(a & b) == shard for b in kinds] for a in kinds])
        for a in range(0, n, BLOCK):
            q, other = np.nonzero(found[a : a + BLOCK] & first[kind[a : a + BLOCK]][:, kind])
            q = q + a
            owned = (np.minimum(part[q], part[other]) == one) & (np.maximum(part[q], part[other]) == two) & (sizes[q] == sizes[other])
            q, other = q[owned], other[owned]
            for b in range(0, len(q), 1 << 16):
                u, v = q[b : b + (1 << 16)], other[b : b + (1 << 16)]
                close = np.einsum("rd,rd->r", x[u], x[v]) >= cosine
                linked[u[close], v[close]] = True
            n_links[a : a + BLOCK] = linked[a : a + BLOCK] @ copies
        low, seen = np.arange(n), np.zeros(n, bool)
        for i in np.flatnonzero(n_links):
            front = np.array([i])[~seen[i : i + 1]]
            while len(front):
                seen[front], low[front] = True, i
                front = np.flatnonzero(linked[front].any(0) & ~seen)
        some = n_links > 0
        return pa.table({"node": ids[some], "n_links": n_links[some], "low": ids[low[some]]})

    return link


def _valid(v):
    """Whether a vector can link: some component is not zero and all are finite numbers."""
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda c: c != 0)


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """`node, v, first, copies`: every different vector that can link, written and reread."""
    rows = vectors.select("vec_id", F.col("embedding").alias("v")).where(_valid(F.col("embedding")))
    nodes = rows.groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    return stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")


def links(nodes: DataFrame, cosine: float = COSINE, width: int = OVERLAP, size: int = SHARD) -> DataFrame:
    """`node, n_links, low` rows, one for each block in which a node has links; sums and components are over them."""
    met = stored(blocks(shards(nodes, width, size)), "blocks")
    lists = stored(graph(met, cosine), "graph")
    known = nodes.select("node", "copies")
    rows = met.join(lists, "node", "left").join(known, "node")
    found = rows.groupBy("shard", "one", "two").applyInArrow(_linked(cosine), "node bigint, n_links bigint, low bigint")
    return stored(found, "links")


def audit(nodes: DataFrame, found: DataFrame, cosine: float = COSINE, queries: int = AUDIT) -> tuple[int, int]:
    """How many links `found` has of `queries` nodes, and how many they have against all nodes, block by block."""
    asked = nodes.orderBy(F.xxhash64("node"), "node").select("node", "v").limit(queries).toArrow()
    ids, x = asked["node"].to_numpy(), _matrix(asked["v"])
    sizes = pa.compute.list_value_length(asked["v"]).to_numpy()

    def count(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            y = _matrix(rows["v"])
            d = max(x.shape[1], y.shape[1])
            sims = np.pad(x, ((0, 0), (0, d - x.shape[1]))) @ np.pad(y, ((0, 0), (0, d - y.shape[1]))).T
            own = ids[:, None] == rows["node"].to_numpy()
            alike = sizes[:, None] == pa.compute.list_value_length(rows["v"]).to_numpy()
            n = ((sims >= cosine) & alike & ~own) @ rows["copies"].to_numpy()
            yield pa.RecordBatch.from_pydict({"node": ids[n > 0], "exact": n[n > 0]})

    exact = nodes.select("node", "v", "copies").mapInArrow(count, "node bigint, exact bigint").groupBy("node").agg(F.sum("exact").alias("exact"))
    got = found.groupBy("node").agg(F.sum("n_links").alias("got"))
    both = exact.join(got, "node", "left").agg(F.sum(F.coalesce("got", F.lit(0))), F.sum("exact")).first()
    return int(both[0] or 0), int(both[1] or 0)


def near_vectors(vectors: DataFrame, cosine: float = COSINE, width: int = OVERLAP, size: int = SHARD) -> DataFrame:
    """One row per row of `vectors`: `vec_id, n_links, component_id, kept`.

    `vectors` needs `vec_id` and `embedding`; other columns are ignored. Null vectors, zero ones
    and those with a null or non-finite component link with nothing; vectors of different length
    do not link. Rows that repeat an id are vectors of their own. A component is named by its
    smallest id; rows without an id take part, name none and are not kept. No row gives none.

    The links are those that the search found: after it, the links of AUDIT nodes are counted
    against all nodes, and under RECALL the search is done again over shards that overlap more.
    """
    nodes = distinct_vectors(vectors)
    while True:
        found = links(nodes, cosine, width, size)
        got, exact = audit(nodes, found, cosine)
        if got >= RECALL * exact or width >= 16:
            break
        width *= 2
    closed = components(found.where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")), "near-vectors")
    named = nodes.join(closed, "node", "left").join(found.groupBy("node").agg(F.sum("n_links").alias("others")), "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    low = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(named.join(low, "component").select("v", "copies", "others", "component_id"), "named")
    can = _valid(F.col("embedding"))
    rows = vectors.select("vec_id", F.when(can, F.col("embedding")).alias("v"))
    out = rows.join(named, "v", "left")
    component = F.when(F.col("copies").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
