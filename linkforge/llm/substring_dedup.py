"""Substring dedup with a log-structured fingerprint index.

Every window of ``size`` consecutive words has an anchor: the smallest hash of the ``gram``-word
shingles inside it. Equal windows have equal anchors, so window hashes travel grouped by anchor
and meet in the index bucket of that anchor. The index is a folder of immutable runs, one for each
batch of documents, sorted by bucket and anchor. A new batch is merge-joined, bucket by bucket, with
every run and with itself; hits are verified by the anchor (64 bits next to the window's own 56) and
mark both sides, so adding batches one by one marks what comparing all windows with all would. The
batch is written as a run of its own, and runs of like size are compacted into one: of entries that
are equal, whose places are marked already, one stays.

A task holds the entries of its buckets and joins one bucket at a time. Inside a partition equal groups of windows are combined before
the shuffle, so a passage in a third of all rows is one row per partition.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, id_text, materialise, release, rolling, shared_dir, shuffle_parts, sliding_min, text_bytes, words

SIZE, GRAM, FAN_IN = 35, 8, 4
#: Buckets for each shuffle partition: one is joined at a time.
BUCKETS = 16
#: Tasks that join buckets, for each shuffle partition: what a task holds is so much smaller.
FINER = 4
#: Bytes of a window's hash.
WIDE = 7
#: The query's history: one document in so many is indexed before the others.
HISTORY = 32
#: Bytes of text that are hashed at a time (some 50 bytes of arrays for each), and of groups that wait for
#: others like them.
AT_ONCE, WAITING = 1 << 20, 16 << 20
#: Parquet's writers hold a row group in memory.
GROUPS = {"parquet.block.size": 8 << 20}
ENTRY = "anchor long, hashes binary, key long, doc_id long, start int, mark int"
MARK = "key long, doc_id long, start int, n int"


def _fingerprints(size: int, gram: int):
    """Rows with ``hashes``: consecutive windows of one anchor, of row (key, doc_id) from
    ``start`` on; key is null if this partition has the same group more than once (its rows are
    then marked here). Rows without: windows start .. start + mark - 1 of a row are repeats."""

    def emit(batches):
        held: dict[tuple[int, bytes], tuple | None] = {}
        weight = 0

        def rows(items):
            names = [x.split()[0] for x in ENTRY.split(", ")]
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*items, strict=True), kinds, strict=True)], names=names)

        def flush():
            items = [(a, h, *(who or (None, None, 0)), 0 if who else 1) for (a, h), who in held.items()]
            for i in range(0, len(items), 20_000):
                yield rows(items[i : i + 20_000])

        for b in batches:
            marks = []
            keys, ids = b.column(2).to_pylist(), b.column(0).to_pylist()
            data, off = text_bytes(b.column(1))
            for i, j in chunks(off, AT_ONCE):
                _, _, h, at = words(data[off[i] : off[j]], off[i : j + 1] - off[i])
                if len(h) < size:
                    continue
                full = rolling(h, size)
                least = sliding_min(rolling(h, gram), size - gram + 1)
                n = np.diff(at)
                last = np.repeat(at[1:], n)[: len(full)]
                good = np.arange(len(full)) + size <= last
                row = np.repeat(np.arange(j - i), n)[: len(full)]
                cut = np.ones(len(full), bool)
                cut[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | ~good[1:] | ~good[:-1]
                s = np.flatnonzero(cut)
                e = np.append(s[1:], len(full))
                on = good[s]
                s, e = s[on], e[on]
                blob = full.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDE].tobytes()
                anchors, r = least[s].astype(np.int64).tolist(), row[s]
                first = (s - at[r]).tolist()
                for a, x, y, k, f in zip(anchors, s.tolist(), e.tolist(), r.tolist(), first, strict=True):
                    group = (a, blob[WIDE * x : WIDE * y])
                    who = (keys[i + k], ids[i + k], f)
                    if group in held:
                        if (old := held[group]) is not None:
                            marks.append((None, None, *old, y - x))
                            held[group] = None
                        marks.append((None, None, *who, y - x))
                    else:
                        held[group] = who
                        weight += 250 + WIDE * (y - x)
            if marks:
                yield rows(marks)
            if weight > WAITING:
                yield from flush()
                held.clear()
                weight = 0
        yield from flush()
        held.clear()
        release()

    return emit


def _sorted(h: np.ndarray, a: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((a, h))
    return h[order], a[order], place[order]


def _equal(run: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Where groups of equal windows of a sorted run start, and their sizes."""
    first = np.ones(len(run[0]), bool)
    first[1:] = (run[0][1:] != run[0][:-1]) | (run[1][1:] != run[1][:-1])
    at = np.flatnonzero(first)
    return at, np.diff(np.append(at, len(run[0])))


def merge_join(old: tuple, new: tuple) -> list[np.ndarray]:
    """Places of two sorted runs (hash, anchor, place) whose window is in both: groups of equal windows
    meet, so a window with very many places on both sides costs their sum."""
    (so, no), (sn, nn) = _equal(old), _equal(new)
    lo, hi = np.searchsorted(old[0][so], new[0][sn], "left"), np.searchsorted(old[0][so], new[0][sn], "right")
    at, hit_old, hit_new = np.flatnonzero(hi > lo), np.zeros(len(so), bool), np.zeros(len(sn), bool)
    while len(at):  # hashes alone may repeat; the anchor verifies
        same = old[1][so[lo[at]]] == new[1][sn[at]]
        hit_new[at[same]] = hit_old[lo[at[same]]] = True
        lo[at] += 1
        at = at[~same]
        at = at[lo[at] < hi[at]]
    return [new[2][np.repeat(hit_new, nn)], old[2][np.repeat(hit_old, no)]]


def twins(run: tuple) -> np.ndarray:
    """Places of a sorted run whose window it has more than once."""
    same = (run[0][1:] == run[0][:-1]) & (run[1][1:] == run[1][:-1])
    twin = np.zeros(len(run[0]), bool)
    twin[1:] |= same
    twin[:-1] |= same
    return run[2][twin]


def _bucket(t: pa.Table):
    """Ranges of repeated windows of one bucket: those of the new batch (run -1) among themselves, and
    those of the batch and of each run."""
    t = t.combine_chunks()
    col = t.column("hashes").combine_chunks()
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    wide = np.zeros(((off[-1] - off[0]) // WIDE, 8), np.uint8)
    wide[:, :WIDE] = np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]].reshape(-1, WIDE)
    h = wide.view("<u8").ravel()
    n = np.diff(off) // WIDE
    first = np.cumsum(n) - n
    a, run = np.repeat(t.column("anchor").to_numpy().view(np.uint64), n), np.repeat(t.column("run").to_numpy(), n)
    place = np.arange(len(h))
    runs = {int(r): _sorted(h[run == r], a[run == r], place[run == r]) for r in np.unique(run)}
    if (new := runs.pop(-1, None)) is None:
        return
    hit = np.zeros(len(h) + 1, bool)
    hit[twins(new)] = True
    for old in runs.values():
        for x in merge_join(old, new):
            hit[x] = True
    begin = np.zeros(len(h) + 1, bool)
    begin[first] = begin[-1] = True
    w = np.concatenate([[False], hit[:-1], [False]])
    s = np.flatnonzero(w[1:-1] & (~w[:-2] | begin[:-1]))
    e = np.flatnonzero(w[1:-1] & (~w[2:] | begin[1:])) + 1
    if len(s):
        entry = np.searchsorted(first, s, side="right") - 1
        got = t.take(pa.array(entry))
        start = (got.column("start").to_numpy() + (s - first[entry])).astype(np.int32)
        out = pa.table({"key": got.column("key"), "doc_id": got.column("doc_id"), "start": pa.array(start), "n": pa.array((e - s).astype(np.int32))})
        yield from out.filter(pa.array(~np.asarray(got.column("mark")).astype(bool))).combine_chunks().to_batches()


def _match(batches):
    """Marks of their own pass; entries wait, and then those of a bucket meet, one bucket after another."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        is_mark = np.asarray(b.column("hashes").is_null())
        m = b.filter(pa.array(is_mark & (b.column("run").to_numpy() < 0)))
        if m.num_rows:
            yield pa.record_batch([m.column(c) for c in ("key", "doc_id", "start", "mark")], names=["key", "doc_id", "start", "n"])
        if len(is_mark) > m.num_rows:
            held.append(b.filter(pa.array(~is_mark)))
    if not held:
        return
    t = pa.Table.from_batches(held).combine_chunks()
    held.clear()
    t = t.take(pa.array(np.argsort(t.column("bucket").to_numpy(), kind="stable")))
    edges = [0, *(np.flatnonzero(np.diff(t.column("bucket").to_numpy())) + 1).tolist(), t.num_rows]
    for i, j in zip(edges, edges[1:], strict=False):
        if i < j:
            yield from _bucket(t.slice(i, j - i))
    del t
    release()


class FingerprintIndex:
    """A folder ``path`` of runs, any Hadoop file system; open the same folder again to go on. Runs are
    named by their level and by the settings, which must agree; one that was not completely written
    is no run."""

    def __init__(self, spark: SparkSession, path: str, size: int = SIZE, gram: int = GRAM, fan_in: int = FAN_IN, buckets: int | None = None):
        self.spark, self.path, self.size, self.gram, self.fan_in = spark, path, size, gram, fan_in
        self.buckets = buckets or BUCKETS * shuffle_parts(spark)
        for _, name in self.runs():
            have = tuple(map(int, name.split("-")[2:5]))
            if have[:2] != (size, gram):
                raise ValueError(f"{path} holds windows of {have[0]} words by anchors of {have[1]}")
            self.buckets = have[2]

    def _files(self, *names: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p

    def runs(self) -> list[tuple[int, str]]:
        """(level, name) of each complete run."""
        files, p = self._files()
        names = [s.getPath().getName() for s in files.listStatus(p)] if files.exists(p) else []
        done = [n for n in names if n.startswith("run-") and files.exists(self._files(n, "_SUCCESS")[1])]
        return sorted((int(n.split("-")[1]), n) for n in done)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(f"bucket int, {ENTRY}").parquet(f"{self.path}/{name}")

    def _write(self, entries: DataFrame, level: int) -> str:
        name = f"run-{level}-{self.size}-{self.gram}-{self.buckets}-{uuid.uuid4().hex}"
        entries.repartition(shuffle_parts(self.spark), "bucket").sortWithinPartitions("bucket", "anchor").write.options(**GROUPS).parquet(f"{self.path}/{name}")
        return name

    def add(self, docs: DataFrame, keep: bool = True) -> DataFrame:
        """(key, doc_id, start, n): windows start .. start + n - 1 of documents old and new that start
        anywhere else too, where the batch ``docs`` (doc_id, text, key) has a part in it. With
        ``keep`` the batch becomes a run and runs are compacted."""
        new = docs.select("doc_id", "text", "key").mapInArrow(_fingerprints(self.size, self.gram), ENTRY)
        new = new.select(F.pmod(F.xxhash64(F.coalesce(F.col("anchor"), F.xxhash64("key", "start"))), F.lit(self.buckets)).cast("int").alias("bucket"), "*")
        history = [name for _, name in self.runs()]
        if keep:
            new = self._read(self._write(new, 0))
        both = new.withColumn("run", F.lit(-1))
        for i, name in enumerate(history):
            both = both.unionByName(self._read(name).where("hashes is not null").withColumn("run", F.lit(i)))
        both = both.repartition(FINER * shuffle_parts(self.spark), "bucket")
        marks = both.mapInArrow(_match, MARK)
        if keep:
            marks = materialise(marks, "repeats", **GROUPS)
            self.compact()
        return marks

    def compact(self) -> None:
        """While a level has ``fan_in`` runs they become one of the next level; of equal entries one
        stays. The new run is complete before the old ones go, so nothing is lost on the way; if both
        are left, entries are there twice, which marks nothing new."""
        while True:
            levels: dict[int, list[str]] = {}
            for level, name in self.runs():
                levels.setdefault(level, []).append(name)
            full = [(level, names) for level, names in sorted(levels.items()) if len(names) >= self.fan_in]
            if not full:
                return
            level, names = full[0]
            entries = self._read(names[0])
            for name in names[1:]:
                entries = entries.unionByName(self._read(name))
            one = F.min(F.struct("key", "doc_id", "start", "mark")).alias("e")
            entries = entries.where("hashes is not null").groupBy("bucket", "anchor", "hashes").agg(one)
            self._write(entries.select("bucket", "anchor", "hashes", "e.*"), level + 1)
            for name in names:
                files, p = self._files(name)
                files.delete(p, True)

    def drop(self) -> None:
        files, p = self._files()
        files.delete(p, True)


def _cut(size: int):
    def cut(batches):
        for b in batches:
            data, off = text_bytes(b.column("text"))
            raw = data.tobytes()
            total, gone, sha = [], [], []
            spans = b.column("spans").to_pylist()
            for i, j in chunks(off, AT_ONCE):
                s, e, _, at = words(data[off[i] : off[j]], off[i : j + 1] - off[i])
                s, e = s + off[i], e + off[i]
                for k in range(j - i):
                    x, y = at[k], at[k + 1]
                    keep = np.ones(y - x, bool)
                    if spans[i + k]:
                        step = np.zeros(y - x + 1, np.int64)
                        r = np.array([(p["start"], p["n"]) for p in spans[i + k]])
                        np.add.at(step, r[:, 0], 1)
                        np.add.at(step, np.minimum(r[:, 0] + r[:, 1] + size - 1, y - x), -1)
                        keep = np.cumsum(step[:-1]) == 0
                    on = np.flatnonzero(keep)
                    total.append(y - x)
                    gone.append(y - x - len(on))
                    text = b" ".join([raw[p:q] for p, q in zip(s[x:y][on].tolist(), e[x:y][on].tolist(), strict=True)])
                    sha.append((hashlib.sha256(text).hexdigest(), text.decode()))
            yield pa.record_batch([
                b.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                pa.array([x[0] for x in sha], pa.string()), pa.array([x[1] for x in sha], pa.string()),
            ], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return cut


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, key) as the index takes them; the key tells rows of one id apart by their text."""
    base = id_text(docs, id_col, text_col)
    return base.withColumn("key", F.xxhash64("doc_id", "text"))


def cut_marked(base: DataFrame, marks: DataFrame, size: int = SIZE) -> DataFrame:
    """Keyed documents without the words that marked windows cover."""
    spans = marks.groupBy("key", "doc_id").agg(F.collect_set(F.struct("start", "n")).alias("spans")).withColumnsRenamed({"key": "k", "doc_id": "d"})
    met = base.join(spans, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
    return met.select("doc_id", "text", "spans").mapInArrow(_cut(size), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, gram: int = GRAM, keep_text: bool = True, history: int = HISTORY) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text.

    Each word covered by a window of ``size`` words that also starts anywhere else (the same
    document included) is removed; windows are judged on the input. One document in ``history``, by
    a hash, becomes the index's first run, and the others are its second batch: the result is that
    of one batch. Null texts have no words. Repeated rows (same id and text) count as two places, so
    both lose their windows. Ids may be null. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    base = keyed(docs, id_col, text_col)
    index = FingerprintIndex(spark, f"{shared_dir(spark)}/linkforge/index-{uuid.uuid4().hex}", size, gram)
    files, p = index._files()
    files.deleteOnExit(p)
    first = F.pmod("key", F.lit(history)) == 0
    marks = index.add(base.where(first)).unionByName(index.add(base.where(~first), keep=False))
    out = cut_marked(base, marks, size)
    return out if keep_text else out.drop("kept_text")
