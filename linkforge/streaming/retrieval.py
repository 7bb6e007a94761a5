"""Source 1 as a stream: each micro-batch is linked with static targets and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import blocking
from ..plans.linkage import keyed_views


def stream_candidates(source1: DataFrame, keyed_targets: DataFrame, out: str, checkpoint: str, k: int = 150, cap: int = 200, ranking: str = "sketch", **trigger) -> StreamingQuery:
    """Candidates of a streaming source 1 to Parquet under ``out``, a folder per micro-batch, so
    that a batch that is run again replaces what it wrote. ``keyed_targets``: a read index. Top-K
    is per query, and a query is in one batch, so results are those of the batch job."""

    def run(batch: DataFrame, number: int) -> None:
        found = blocking.candidates(keyed_views(batch, "q_id"), keyed_targets, k, cap, ranking)
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return source1.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
