"""Exact dedup by a tree merge of sorted digest runs.

Each partition writes one sorted run (a row per digest, with the ids that share it). Runs then
meet in rounds of a binomial (radix ``fan_in``) tree: in round r the runs whose numbers agree
after division by fan_in**(r+1) are exchanged by digest range and merged in one sorted pass,
which keeps the winning identifier and the number of copies. A digest shared by a third of
all rows is one row per run from the first step on, so no task ever holds its copies. The text
itself never leaves the partition that read it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, materialise, shuffle_parts

UPPER = bytes(range(65, 91))
FOLD = bytes.maketrans(UPPER, UPPER.lower())
RUN = "run int, digest binary, proof binary, keep_id long, keep_run long, n long"
#: A partition with more rows than this writes several runs, so that a task's memory is bounded.
RUN_ROWS = 500_000


def _runs(batches):
    task = TaskContext.get().partitionId()
    groups: dict[tuple[bytes, bytes], list] = {}
    rows = piece = 0

    def flush():
        keys = sorted(groups)
        ids = [sorted(groups[k], key=lambda x: (x is None, -(x or 0))) for k in keys]
        for i in range(0, len(keys), 20_000):
            part, mine = keys[i : i + 20_000], ids[i : i + 20_000]
            yield pa.record_batch({
                "run": pa.array([task] * len(part), pa.int32()), "digest": pa.array([k[0] for k in part], pa.binary()),
                "proof": pa.array([k[1] for k in part], pa.binary()),
                "home": pa.array([(task << 20) + piece] * len(part), pa.int64()), "ids": pa.array(mine, pa.list_(pa.int64())),
            })

    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
            t = (t.as_py() or b"").translate(FOLD)
            key = (hashlib.sha256(t).digest(), xxhash.xxh64_digest(t) + len(t).to_bytes(8, "big"))
            groups.setdefault(key, []).append(i)
            rows += 1
        if rows >= RUN_ROWS:
            yield from flush()
            groups.clear()
            rows, piece = 0, piece + 1
    if groups:
        yield from flush()


def _merge(batches):
    """Merge adjacent rows of a partition sorted by (run, digest, proof); the last row of a batch
    waits for the next batch."""
    held = None

    def reduce(t: pa.Table):
        n = t.num_rows
        keys = [np.array(t.column(c).to_pylist(), object) for c in ("digest", "proof")]
        run = t.column("run").to_numpy()
        new = np.ones(n, bool)
        new[1:] = (run[1:] != run[:-1]) | (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
        at = np.flatnonzero(new)
        null = np.asarray(t.column("keep_id").is_null())
        ids = t.column("keep_id").fill_null(0).to_numpy()
        group = np.cumsum(new) - 1
        # the largest id stays, nulls last; of repeated ids the one in the earliest run
        best = np.lexsort((t.column("keep_run").to_numpy(), -ids, null, group))[at]
        return pa.table({
            "run": t.column("run").take(at), "digest": t.column("digest").take(at), "proof": t.column("proof").take(at),
            "keep_id": t.column("keep_id").take(best), "keep_run": t.column("keep_run").take(best),
            "n": pa.array(np.add.reduceat(t.column("n").to_numpy(), at)),
        })

    for b in batches:
        t = pa.Table.from_batches([b])
        if held is not None:
            t = pa.concat_tables([held, t])
        if t.num_rows:
            t = reduce(t.combine_chunks())
            held = t.slice(t.num_rows - 1)
            yield from t.slice(0, t.num_rows - 1).to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty, so nulls
    and empty texts form one group. The largest id of a group stays; null ids come last, and of
    rows that repeat both id and text exactly one has kept = true. Other columns, whatever their
    names, are not read. An empty table gives an empty result. Digests are SHA-256; two rows merge
    only if an independent 64-bit digest and the byte length agree too.
    """
    spark = docs.sparkSession
    local = materialise(
        id_text(docs, id_col, text_col)
        .mapInArrow(_runs, "run int, digest binary, proof binary, home long, ids array<long>"), "digest-runs")
    runs = (local.agg(F.max("run")).first()[0] or 0) + 1
    tree = local.select(
        "run", "digest", "proof", F.try_element_at("ids", F.lit(1)).alias("keep_id"),
        F.col("home").alias("keep_run"), F.size("ids").cast("long").alias("n"))
    parts = shuffle_parts(spark)
    while True:
        tree = (
            tree.withColumn("run", F.expr(f"run div {fan_in}").cast("int"))
            .repartition(parts, "run", F.substring("digest", 1, 4))
            .sortWithinPartitions("run", "digest", "proof")
            .mapInArrow(_merge, RUN)
        )
        runs = -(-runs // fan_in)
        if runs == 1:
            break
    found = tree.drop("run").withColumnsRenamed({"digest": "d", "proof": "p"})
    rows = local.join(found, (F.col("digest") == F.col("d")) & (F.col("proof") == F.col("p")))
    return rows.select("*", F.posexplode("ids").alias("pos", "doc_id")).select(
        "doc_id", "keep_id", F.col("n").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("home") == F.col("keep_run")) & (F.col("pos") == 0)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
