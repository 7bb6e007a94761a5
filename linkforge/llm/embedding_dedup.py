"""Embedding near-dedup with hierarchical navigable small-world graphs.

Vectors of one label are dealt into shards by a hash; each shard is built into an HNSW graph once,
which is written to the shared folder, and every vector of the label queries every shard, in blocks.
A unit of work is one graph with ``TURN`` blocks, so a hot label is as many units as it needs, and a
graph travels once a unit, not once a block. Searches run for a block of queries at a time as array
operations. The beam of a shard is the one that finds all hits of 512 searches from near its own
vectors, so it does not depend on how many queries have hits there. A query whose beam is full of
hits is searched again with a wider one; then a sample of the block's queries is compared with brute
force over the shard, and the beam of this and later blocks widens until that audit finds nothing
missing. Hits are verified by the cosine in double precision. Equal vectors are one class, so a
vector that a third of all rows share is one node with a count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialise, shuffle_parts, small_batches, union_forest

LEAST = 0.98
#: Vectors a graph at most, and bytes of one; queries a block, and blocks that share a graph's trip.
SHARD, SHARD_BYTES, BLOCK, TURN = 32_768, 24 << 20, 1024, 8
#: Neighbours a node (twice as many at the bottom), nearest others that they are chosen from, first
#: beam, and nodes of a beam that one step opens.
M, CANDIDATES, BEAM, EXPAND = 12, 48, 48, 6
#: Searches that set a shard's beam, each with at least one true hit.
PROBES = 512


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by their largest component first, so that squares stay finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _linked(x: np.ndarray, wide: int) -> np.ndarray:
    """Neighbours of each node of one level, -1 where there is none: of its nearest, first those that
    are nearer to it than to one already chosen (they lead out of a cluster), then the nearest; a
    quarter is left for links back."""
    n = len(x)
    near = np.full((n, wide), -1, np.int32)
    if n < 2:
        return near
    k = min(max(CANDIDATES, wide), n - 1)
    step = max(16, (4 << 20) // n)
    for i in range(0, n, step):
        sims = x[i : i + step] @ x.T
        b = len(sims)
        sims[np.arange(b), np.arange(i, i + b)] = -3
        ids = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        sims = np.take_along_axis(sims, ids, 1)
        at = np.argsort(-sims, axis=1)
        ids, sims = np.take_along_axis(ids, at, 1), np.take_along_axis(sims, at, 1)
        between = x[ids] @ x[ids].transpose(0, 2, 1)
        chosen, closest, count = np.zeros((b, k), bool), np.full((b, k), -3.0, np.float32), np.zeros(b, int)
        for c in range(k):
            on = (sims[:, c] > closest[:, c]) & (count < wide // 2)
            chosen[on, c] = True
            count += on
            closest[on] = np.maximum(closest[on], between[on, c])
        at = np.argsort(np.where(chosen, 0, 1), axis=1, kind="stable")[:, : wide - wide // 4]
        near[i : i + b, : at.shape[1]] = np.take_along_axis(ids, at, 1)
    src, dst = np.repeat(np.arange(n), wide), near.ravel()
    on = dst >= 0
    src, dst = src[on], dst[on]
    on = ~(near[dst] == src[:, None]).any(axis=1)
    at = np.random.default_rng(3).permutation(int(on.sum()))
    src, dst = src[on][at], dst[on][at]
    at = np.argsort(dst, kind="stable")
    src, dst = src[at], dst[at]
    slot = np.arange(len(dst)) - np.searchsorted(dst, np.arange(n))[dst] + (near >= 0).sum(axis=1)[dst]
    on = slot < wide
    near[dst[on], slot[on]] = src[on]
    return near


class Graph:
    """HNSW over unit vectors, in the order that ``layout`` gives: higher nodes come first, so each
    level is a prefix of the one below. ``near[l]`` has the neighbours of its nodes."""

    def __init__(self, x: np.ndarray, near: list[np.ndarray]):
        self.x, self.near = x, near

    @staticmethod
    def layout(n: int, seed: int = 1) -> tuple[np.ndarray, list[int]]:
        """Order of n vectors and the number of nodes of each level, the bottom first."""
        level = np.minimum((-np.log(np.random.default_rng(seed).random(n) + 1e-12) / np.log(M)).astype(int), 6)
        return np.argsort(-level, kind="stable"), [int((level >= v).sum()) for v in range(int(level.max(initial=0)) + 1)]

    @classmethod
    def build(cls, x: np.ndarray, sizes: list[int]) -> Graph:
        return cls(x, [_linked(x[:n], M if lv else 2 * M) for lv, n in enumerate(sizes)])

    def _search(self, q: np.ndarray, lv: int, beam: int, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of a block at one level; ids and similarities, best first."""
        near, x, b = self.near[lv], self.x, len(q)
        n = len(near)
        beam = min(beam, n)
        ids, sims, fresh = np.full((b, beam), -1, np.int64), np.full((b, beam), -3.0, np.float32), np.zeros((b, beam), bool)
        ids[:, 0], sims[:, 0], fresh[:, 0] = entry, np.einsum("ij,ij->i", q, x[entry]), True
        seen = np.zeros(b * n, bool)
        seen[np.arange(b) * n + entry] = True
        live = np.arange(b)
        while len(live):
            s = np.where(fresh[live], sims[live], -4)
            e = min(EXPAND, beam)
            pick = np.argpartition(-s, e - 1, axis=1)[:, :e]
            good = np.take_along_axis(s, pick, 1) > -3
            go = good.any(axis=1)
            live, pick, good = live[go], pick[go], good[go]
            if not len(live):
                break
            nb = np.where(good[:, :, None], near[np.where(good, ids[live[:, None], pick], 0)], -1).reshape(len(live), -1)
            fresh[live[:, None], pick] = False
            r, c = np.nonzero(nb >= 0)
            cell = live[r] * n + nb[r, c]
            cell = np.unique(cell[~seen[cell]])
            if not len(cell):
                continue
            seen[cell] = True
            r, node = np.divmod(cell, n)
            got = np.einsum("ij,ij->i", q[r], x[node])
            rows, first, at = np.unique(r, return_index=True, return_inverse=True)
            col = beam + np.arange(len(r)) - first[at]
            shape = (len(rows), int(col.max()) + 1)
            s, i, o = np.full(shape, -3.0, np.float32), np.full(shape, -1, np.int64), np.zeros(shape, bool)
            s[:, :beam], i[:, :beam], o[:, :beam] = sims[rows], ids[rows], fresh[rows]
            s[at, col], i[at, col], o[at, col] = got, node, True
            at = np.argpartition(-s, beam - 1, axis=1)[:, :beam]
            sims[rows], ids[rows], fresh[rows] = (np.take_along_axis(v, at, 1) for v in (s, i, o))
        at = np.argsort(-sims, axis=1)
        return np.take_along_axis(ids, at, 1), np.take_along_axis(sims, at, 1)

    def search(self, q: np.ndarray, beam: int, entry: np.ndarray | None = None):
        """``entry``: nodes of the graph to start from, else the descent through its levels."""
        if entry is None:
            entry = np.zeros(len(q), np.int64)
            for lv in range(len(self.near) - 1, 0, -1):
                entry = self._search(q, lv, 4, entry)[0][:, 0]
        return self._search(q, 0, beam, entry)


def hits(graph: Graph, q: np.ndarray, least: float, beam: int = BEAM, audit: int = 32, entry: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(query, node) pairs with a float cosine of about ``least`` or more, and the beam that
    passed the audit. The last resort, from beams of an eighth of the shard on, is exhaustive: that
    costs less than such a search."""
    x = graph.x
    n, slack = len(x), least - 1e-4
    step = max(1, len(q) // audit)
    sample = np.arange(0, len(q), step)
    truth = (q[sample] @ x.T) >= slack
    while True:
        found_q, found_n, left, width = [], [], np.arange(len(q)), beam
        while len(left):
            full, rows_at_once = [], max(16, (8 << 20) // n)
            for i in range(0, len(left), rows_at_once):
                rows = left[i : i + rows_at_once]
                if width * 8 >= n:
                    r, c = np.nonzero(q[rows] @ x.T >= slack)
                    found_q.append(rows[r])
                    found_n.append(c)
                    continue
                ids, sims = graph.search(q[rows], width, None if entry is None else entry[rows])
                more = sims[:, -1] >= slack  # nothing but hits: there may be others
                r, c = np.nonzero((sims >= slack) & (ids >= 0) & ~more[:, None])
                found_q.append(rows[r])
                found_n.append(ids[r, c])
                full.append(rows[more])
            left, width = np.concatenate(full) if full else left[:0], width * 4
        a, b = np.concatenate(found_q), np.concatenate(found_n)
        got = np.zeros(truth.shape, bool)
        on = a % step == 0
        got[a[on] // step, b[on]] = True
        if (got | ~truth).all() or beam * 8 >= n:
            return a, b, beam
        beam *= 2


def probed_beam(graph: Graph, least: float, probes: int = PROBES) -> int:
    """The beam that finds every true hit of searches from near the shard's own vectors, at cosines
    of ``least`` to 1 with them. Each has a hit, however few queries of real blocks do."""
    rng = np.random.default_rng(7)
    own = graph.x[rng.permutation(len(graph.x))[:probes]].astype(np.float64)
    off = rng.normal(size=own.shape)
    off -= np.einsum("ij,ij->i", off, own)[:, None] * own
    off /= np.maximum(np.linalg.norm(off, axis=1, keepdims=True), 1e-9)
    cos = rng.uniform(least, 1, (len(own), 1))
    q = cos * own + np.sqrt(1 - cos**2) * off
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    return hits(graph, q.astype(np.float32), least, audit=len(q))[2]


ROW = "label string, dim int, part long, block long, nodes binary, copies binary, x binary, near binary, sizes array<int>, beam int"


def _built(least: float):
    def build(_, t):
        """A shard's graph (block -1), then its vectors in blocks, both in the order of the graph."""
        t = t.sort_by("node")
        v = t.column("v").combine_chunks()
        order, sizes = Graph.layout(len(v))
        x = unit(np.asarray(v.flatten(), np.float64).reshape(len(v), -1))[order]
        node, copies = (t.column(c).to_numpy()[order].astype("<i8") for c in ("node", "copies"))
        graph = Graph.build(x.astype(np.float32), sizes)
        beam = probed_beam(graph, least)
        first = [t.column(c)[0].as_py() for c in ("label", "dim", "part")]
        near = np.concatenate([a.ravel() for a in graph.near]).astype("<i4").tobytes()
        rows = [(*first, -1, node.tobytes(), copies.tobytes(), x.tobytes(), near, sizes, beam)]
        for b, i in enumerate(range(0, len(x), BLOCK)):
            rows.append((*first, b, node[i : i + BLOCK].tobytes(), None, x[i : i + BLOCK].tobytes(), None, None, None))
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4, pa.list_(pa.int32()), pa.int32()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in ROW.split(", ")])

    return build


def _search(least: float):
    """Rows sorted so that a graph comes before the blocks that query it: links of each query."""

    def run(batches):
        unit_of, graph = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r] for c in ("label", "dim", "part", "turn", "block", "from", "nodes", "x")}
                key = tuple(row[c].as_py() for c in ("label", "dim", "part", "turn"))
                dim = key[1]
                qids = np.frombuffer(row["nodes"].as_buffer(), "<i8")
                q = np.frombuffer(row["x"].as_buffer(), "<f8").reshape(-1, dim)
                if row["block"].as_py() < 0:
                    sizes, near, at = batch.column("sizes")[r].as_py(), [], 0
                    flat = np.frombuffer(batch.column("near")[r].as_buffer(), "<i4")
                    for lv, n in enumerate(sizes):
                        wide = M if lv else 2 * M
                        near.append(flat[at : at + n * wide].reshape(n, wide).copy())
                        at += n * wide
                    unit_of, ids, exact = key, qids.copy(), q.copy()
                    copies = np.frombuffer(batch.column("copies")[r].as_buffer(), "<i8").copy()
                    graph, beam = Graph(exact.astype(np.float32), near), batch.column("beam")[r].as_py()
                    continue
                if key != unit_of:
                    raise RuntimeError("a block came without its graph")
                own = row["from"].as_py() == key[2]
                entry = row["block"].as_py() * BLOCK + np.arange(len(q)) if own else None
                a, b, beam = hits(graph, q.astype(np.float32), least, beam, entry=entry)
                real = np.einsum("ij,ij->i", q[a], exact[b]) >= least
                a, b = a[real], b[real]
                other = qids[a] != ids[b]
                a, b = a[other], b[other]
                n = np.bincount(a, weights=copies[b], minlength=len(qids)).astype(np.int64)
                # a spanning forest of the links stands for them
                names, at = np.unique(np.concatenate([qids, ids]), return_inverse=True)
                up = union_forest(len(names), at[a], at[len(qids) + b])
                node = np.concatenate([qids, ids])
                n = np.concatenate([n, np.zeros(len(ids), np.int64)])
                root = names[up[at]]
                keep = (n > 0) | (root != node)
                yield pa.record_batch({"node": pa.array(node[keep]), "n": pa.array(n[keep]), "root": pa.array(root[keep])})

    return run


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = LEAST, shard: int = SHARD) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors are compared if their labels (of any simple type) are equal and not null and they have
    the same number of components. A link is a cosine (double precision) of ``least`` or more.
    n_links counts linked other rows, component_id is the smallest vec_id reachable by links, kept
    is vec_id = component_id. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing; so do null labels. Rows that repeat an id count as rows of
    their own; rows with a null id are linked, and have the component of their class. Other
    columns are not read. An empty table gives no rows. Equal vectors are told by a 128-bit digest.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    v = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(label_col).isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    )
    label = F.col(label_col)
    if dict(vectors.dtypes)[label_col] in ("float", "double"):
        label = label + F.lit(0.0)  # -0.0 equals 0.0
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("string").alias("label"), v.alias("v"), F.coalesce(usable, F.lit(False)).alias("ok"))
    plain = F.transform("v", lambda c: c + 0.0)
    rows = base.select("vec_id", "ok", "label", "v", F.when(F.col("ok"), F.xxhash64("label", plain)).alias("h1"), F.when(F.col("ok"), F.xxhash64(F.lit("b"), plain, "label")).alias("h2"))
    # equal vectors of a label are one node; its number is fixed when it is written
    nodes = rows.where("ok").groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"))
    nodes = materialise(nodes.withColumn("dim", F.size("v")).withColumn("node", F.monotonically_increasing_id()), "hnsw-nodes")
    counts = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    most = F.greatest(F.lit(1), F.least(F.lit(shard), F.floor(F.lit(SHARD_BYTES) / (F.col("dim") * 8 + 8 * M + 16))))
    counts = counts.select("label", "dim", F.ceil(F.col("n") / most).cast("long").alias("parts"), F.ceil(F.col("n") / F.lit(BLOCK * TURN)).cast("long").alias("turns"))
    few = counts.count() <= 100_000
    sized = lambda df: df.join(F.broadcast(counts) if few else counts, ["label", "dim"])
    dealt = sized(nodes).select("label", "dim", F.pmod(F.xxhash64("node"), "parts").alias("part"), "node", "copies", "v")
    shards = dealt.groupBy("label", "dim", "part").applyInArrow(_built(least), ROW)
    shards = sized(materialise(shards, "hnsw-shards", **{"parquet.block.size.row.check.min": 1, "parquet.block.size": 32 << 20}))
    # every block goes to every shard of its label, a graph to every turn of blocks
    turn = F.when(F.col("block") < 0, F.col("i")).otherwise(F.pmod(F.xxhash64("part", "block"), "turns"))
    to = F.when(F.col("block") < 0, F.col("part")).otherwise(F.col("i"))
    met = shards.withColumn("i", F.explode(F.expr("sequence(0L, if(block < 0, turns, parts) - 1)"))).select(
        "label", "dim", to.alias("part"), turn.alias("turn"), "block", F.col("part").alias("from"), "nodes", "copies", "x", "near", "sizes", "beam")
    met = met.repartition(shuffle_parts(spark), "label", "dim", "part", "turn").sortWithinPartitions("label", "dim", "part", "turn", "block")
    links = materialise(met.mapInArrow(_search(least), "node long, n long, root long"), "hnsw-links")
    found = connected_components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    ids = found.join(nodes.select("node", "least_id"), "node")
    smallest = ids.groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = ids.join(smallest, "component").select("node", F.col("component_id").alias("reached"))
    totals = links.groupBy("node").agg(F.sum("n").alias("others"))
    per = (
        nodes.select("node", "h1", "h2", "copies", "least_id").join(linked, "node", "left").join(totals, "node", "left")
        .select("h1", "h2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n"), F.coalesce("reached", "least_id").alias("c"))
    )
    out = rows.select("vec_id", "h1", "h2").join(per, ["h1", "h2"], "left")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
