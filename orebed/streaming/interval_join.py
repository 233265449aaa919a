"""Join of two streams on a key and a bounded time gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_stream_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    max_gap_seconds: int,
    watermark: str,
) -> DataFrame:
    """Pairs with equal ``key`` and ``left_ts <= right_ts <= left_ts + gap``.

    Both sides carry a time slot as wide as the gap. A right row can only match
    left rows of its own slot or the one before, so it is offered to both, and
    the join state of a hot key is spread over its slots. State older than the
    watermark is dropped. Column names other than ``key`` must differ.
    """
    slot = "_slot"
    width = F.lit(max_gap_seconds)

    def number(ts: str):
        return F.floor(F.unix_seconds(ts) / width)

    early = left.withWatermark(left_ts, watermark).withColumn(slot, number(left_ts))
    late = right.withWatermark(right_ts, watermark).withColumn(
        slot, F.explode(F.array(number(right_ts), number(right_ts) - 1))
    )
    gap = F.expr(f"INTERVAL {int(max_gap_seconds)} SECONDS")
    late = late.withColumnRenamed(key, "_key").withColumnRenamed(slot, "_late_slot")
    near = (
        (F.col(key) == F.col("_key"))
        & (F.col(slot) == F.col("_late_slot"))
        & (F.col(right_ts) >= F.col(left_ts))
        & (F.col(right_ts) <= F.col(left_ts) + gap)
    )
    return early.join(late, near, "inner").drop(slot, "_late_slot", "_key")
