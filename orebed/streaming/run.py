"""Run a stream over all new input, then stop."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from orebed.streaming.metriclog import MetricLog, following, metrics_folder


@dataclass
class RunReport:
    """What one run read, and the observed counts summed over its batches."""

    rows_read: int = 0
    batches: int = 0
    observed: dict[str, dict[str, int]] = field(default_factory=dict)

    @property
    def rows_added(self) -> int:
        """Rows that reached the sink: those kept, where expectations were applied."""
        kept = [counts["rows_kept"] for counts in self.observed.values() if "rows_kept" in counts]
        return sum(kept) if kept else self.rows_read


def report_of(query: StreamingQuery) -> RunReport:
    report = RunReport()
    for progress in query.recentProgress:
        if not progress.numInputRows:
            continue
        report.rows_read += progress.numInputRows
        report.batches += 1
        for name, row in progress.observedMetrics.items():
            counts = report.observed.setdefault(name, {})
            for key, value in row.asDict().items():
                counts[key] = counts.get(key, 0) + value
    return report


def run_available(df: DataFrame, dst: str, checkpoint: str) -> RunReport:
    """Append everything new to the parquet table ``dst``. The counts of each batch stay beside the checkpoint."""
    spark = df.sparkSession
    log = MetricLog(spark, metrics_folder(checkpoint))
    earlier = log.totals
    with following(spark, log) as follower:
        query = (
            df.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(dst)
        )
        follower.follow(str(query.runId))
        query.awaitTermination()
        follower.finish()
    added = log.since(earlier)
    return RunReport(rows_read=added["rows"], batches=added["batches"], observed=added["counts"])


def run_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> RunReport:
    """Hand everything new to ``handle``, batch by batch."""
    query = (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return report_of(query)
