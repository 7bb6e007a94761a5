"""Helpers that the training-data operators share: durable intermediates, Arrow maps,
word hashing over raw UTF-8 bytes and connected components."""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stages import _files, discard, materialise, shared_dir  # noqa: F401

MULT = np.uint64(0x9E3779B97F4A7C15)

#: Arrow batches of texts are made no larger than this, so that a Python worker's copies of one
#: stay small next to an executor's memory.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, "64m").lower().rstrip("b")
    size = int(now[:-1]) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}[now[-1]] if now[-1] in "kmg" else int(now)
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) of a table whose other columns may have any names."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


#: Rows of ids that may be broadcast; beyond it both sides are shuffled.
MOST_IDS = 500_000


def drop_rows(docs: DataFrame, gone: DataFrame, *keys: tuple) -> DataFrame:
    """The rows of ``docs`` that match none of ``gone``; keys are pairs (expression over docs,
    column of gone), nulls equal. ``gone`` has been written, so counting it is cheap: while it is
    small, texts stay where they are, and past ``MOST_IDS`` rows the join is a shuffled one."""
    gone = gone.select(*[F.col(right).alias(f"__gone_{i}") for i, (_, right) in enumerate(keys)])
    on = F.lit(True)
    for i, (left, _) in enumerate(keys):
        on = on & left.eqNullSafe(F.col(f"__gone_{i}"))
    small = gone.count() <= MOST_IDS
    return docs.join(F.broadcast(gone) if small else gone.hint("shuffle_merge"), on, "left_anti")


def release() -> None:
    """Give memory that a Python worker no longer uses back to the system: workers live on between
    tasks, next to the heap of their executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def releasing(run):
    """The Arrow map ``run``, after which a task gives back what it no longer uses."""

    def whole(batches):
        yield from run(batches)
        release()

    return whole


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column without copying; nulls are empty."""
    if col.null_count:
        col = col.fill_null("")
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        kind = np.int32
    bufs = col.buffers()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(bufs[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def chunks(off: np.ndarray, most: int = 1 << 18):
    """Row ranges of about ``most`` bytes; a longer row makes a range of its own. Work on a range takes
    many times its bytes, in each of an executor's Python workers."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public-domain splitmix constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Powers that a worker keeps for each base; those of a longer row are made anew.
MOST_POWERS = 1 << 21


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n; base is odd."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
        up[1:], down[1:] = base, pow(base, -1, 1 << 64)
        have = (np.cumprod(up, dtype=np.uint64, out=up), np.cumprod(down, dtype=np.uint64, out=down))
        if size <= MOST_POWERS:
            _powers[base] = have
    return have[0][:n], have[1][:n]


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * MULT)
_BASE = 0x5851F42D4C957F2D


def words(data: np.ndarray, off: np.ndarray, lower: bool = False):
    """Words ``[^\\x20\\x09-\\x0D]+`` of rows that lie end to end in ``data``: starts, ends,
    64-bit hashes, and for each row the index of its first word (one more at the end)."""
    n = len(data)
    # a separator is put after each row, so that words never join across rows
    space = _SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    inside = ~space
    before = np.empty(n, bool)
    if n:
        before[0] = True
        before[1:] = space[:-1]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    after = np.empty(n, bool)
    if n:
        after[-1] = True
        after[:-1] = space[1:]
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    up, down = powers(_BASE, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * up[:n], out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * MULT)
    return starts, ends, h, np.searchsorted(starts, off)


def rolling(h: np.ndarray, k: int, base: int = 0xD1342543DE82EF95) -> np.ndarray:
    """Hash of each k consecutive entries; the caller keeps away those that cross rows."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = powers(base, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up[:n], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[: n - k + 1])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive entries."""
    have, size = x, 1
    while size * 2 <= w:
        have, size = np.minimum(have[:-size], have[size:]), size * 2
    rest = w - size
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


def occurrence(h: np.ndarray) -> np.ndarray:
    """0 for the first occurrence of a value, 1 for the second, and so on, in order."""
    n = len(h)
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    out = np.empty(n, np.int64)
    out[order] = np.arange(n) - first
    return out


def union_forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node index of each node's component, from links a-b within one task."""
    up = np.arange(n)
    while len(a):
        x, y = up[a], up[b]
        ne = x != y
        a, b, x, y = a[ne], b[ne], x[ne], y[ne]
        if not len(a):
            break
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while True:
            nxt = up[up]
            if (nxt == up).all():
                break
            up = nxt
    return up


#: Links that one task may take (16 bytes each); more go through distributed rounds.
FEW_LINKS = 2_000_000
#: Links that a task contracts at a time.
AT_ONCE = 250_000


def _contract(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Links to stars: each node with the smallest node that they connect it to."""
    t = pa.Table.from_batches(batches)
    u, v = (t.column(c).to_numpy() for c in ("u", "v"))
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = union_forest(len(names), at[: len(u)], at[len(u) :])
    own = root != np.arange(len(names))
    return pa.record_batch({"u": pa.array(names[own]), "v": pa.array(names[root[own]])})


def _finish(batches):
    """All links, whose number has been checked, at once."""
    held = [b for b in batches if b.num_rows]
    if held:
        yield _contract(held)


def _forest(batches):
    """Links of a partition to a spanning forest of them, a bounded number at a time: what
    connects the same nodes with fewer rows."""
    held: list[pa.RecordBatch] = []
    n = 0

    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= AT_ONCE:
            one = _contract(held)
            if one.num_rows > n // 2:  # not worth keeping open
                yield one
                held, n = [], 0
            else:
                held, n = [one], one.num_rows
    if n:
        yield _contract(held)


def connected_components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(u, v) long links to (node, component): the smallest node id reachable, for each node
    that has a link to another. Each partition first contracts its links to a forest. If what is
    left is small (a checked bound), one task finishes; else large-star and small-star rounds
    alternate, each a minimum per node (combined before its shuffle) and an equi-join that AQE
    splits when one node has very many links, written to the shared folder. Self links and nulls
    are left out; an empty input gives an empty result."""
    clean = edges.where("u is not null and v is not null and u <> v").select("u", "v")
    cur = materialise(clean.mapInArrow(releasing(_forest), "u long, v long"), "cc")
    if cur.count() <= FEW_LINKS:
        cur = cur.repartition(1).mapInArrow(releasing(_finish), "u long, v long")
    else:
        cur = _rounds(cur, most)
    pairs = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _rounds(cur: DataFrame, most: int) -> DataFrame:
    """Links (u to the smaller v) to stars."""
    last = None
    for _ in range(most):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u")
        nxt = materialise(
            small.select("v", "m").union(small.select("u", "m")).toDF("u", "v").where("u <> v").distinct(), "cc")
        now = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(cur)
        cur = nxt
        if now == last:
            return cur
        last = now
    raise RuntimeError("components did not settle")
