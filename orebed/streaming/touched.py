"""Keep an aggregate per day current by recomputing only the days that changed.

The aggregate has one row per day and is written whole, version by version;
the big source is read only between the first and the last changed day.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed import paths
from orebed.session import fit_shuffle
from orebed.streaming.run import RunReport, run_batches
from orebed.streaming.snapshot import SnapshotMismatch, versions


def read_days(spark: SparkSession, root: str) -> DataFrame | None:
    """The current aggregate, or None before the first run."""
    known = versions(spark, root)
    return spark.read.parquet(f"{root}/data/v{known[-1]}") if known else None


def _refresh(
    batch: DataFrame,
    batch_id: int,
    source: str,
    ts: str,
    day: str,
    compute: Callable[[DataFrame], DataFrame],
    root: str,
) -> None:
    spark = batch.sparkSession
    known = versions(spark, root)
    if known and known[-1] > batch_id:
        raise SnapshotMismatch(f"{root} is at version {known[-1]}, but the checkpoint resumes at {batch_id}")
    # There are fewer than four million dates, so a list of days can be broadcast.
    days = batch.select(F.to_date(ts).alias("_day")).distinct().persist()
    try:
        first, last, blank = days.agg(F.min("_day"), F.max("_day"), F.count_if(F.col("_day").isNull())).first()
        if first is None and not blank:
            return
        changed = F.col(ts).isNull() if blank else F.lit(False)
        if first is not None:
            # A plain range on the column, so that files and row groups are skipped.
            changed = changed | ((F.col(ts) >= F.lit(first)) & (F.col(ts) < F.date_add(F.lit(last), 1)))
        marks = F.broadcast(days)
        rows = fit_shuffle(spark.read.parquet(source).filter(changed))
        rows = rows.join(marks, F.to_date(ts).eqNullSafe(F.col("_day")), "left_semi")
        result = compute(rows)
        before = [version for version in known if version < batch_id]
        if before:
            held = spark.read.parquet(f"{root}/data/v{before[-1]}")
            result = held.join(marks, held[day].eqNullSafe(F.col("_day")), "left_anti").unionByName(result)
        result.write.mode("overwrite").parquet(f"{root}/data/v{batch_id}")
        paths.write_text(spark, f"{root}/manifest/v{batch_id}.json", json.dumps({"0": batch_id}))
        for version in before[:-1]:
            paths.remove(spark, f"{root}/manifest/v{version}.json")
            paths.remove(spark, f"{root}/data/v{version}")
    finally:
        days.unpersist()


def refresh_days(
    changes: DataFrame,
    source: str,
    ts: str,
    day: str,
    compute: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
) -> RunReport:
    """Bring the aggregate below ``root`` up to date.

    ``changes`` streams the parquet table ``source``; ``compute`` aggregates its
    rows by the date of ``ts`` into column ``day``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        _refresh(batch, batch_id, source, ts, day, compute, root)

    return run_batches(changes, handle, checkpoint)
