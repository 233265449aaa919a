"""Rows and exact distinct customers per day, kept by differences.

Two logs (see ``logtable``): the number of rows of every day and customer, and
the totals of every day. A batch counts its own rows, looks up the days and
customers it has, and writes their new numbers; a customer counts for a day when
the pair is new. The source is never read again, and a late row touches the
buckets of its own pair and day alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.streaming.logtable import (
    DEFAULT_BUCKET_ROWS,
    DEFAULT_BUCKETS,
    DEFAULT_FOLDER_ROWS,
    Layout,
    base_for,
    commit,
    prune_versions,
    read_keys,
    read_table,
)
from orebed.streaming.run import RunReport, run_batches

DAY, CUSTOMER, ROWS, CUSTOMERS, WRITTEN = "_day", "_customer", "_rows", "_customers", "_written"


def _places(root: str) -> tuple[str, str]:
    return f"{root}/pairs", f"{root}/days"


def _raised(
    delta: DataFrame, batch_id: int, root: str, layout: Layout, counts: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Add counts to those stored. The rows to write, and the delta with ``_new`` where a key was not stored."""
    spark = delta.sparkSession
    keys = list(layout.keys)
    base = base_for(spark, root, layout, batch_id)
    stored = read_keys(spark, root, base, delta.select(*keys))
    if stored is None:
        return delta.withColumn(WRITTEN, F.lit(batch_id).cast("bigint")), delta.withColumn("_new", F.lit(True))
    held = stored.select(*[F.col(key).alias(f"_held{key}") for key in keys], *[F.col(name).alias(f"_held{name}") for name in counts])
    same = [delta[key].eqNullSafe(held[f"_held{key}"]) for key in keys]
    joined = delta.join(held, same, "left")
    sums = [(F.col(name) + F.coalesce(f"_held{name}", F.lit(0))).alias(name) for name in counts]
    written = joined.select(*keys, *sums, F.lit(batch_id).cast("bigint").alias(WRITTEN))
    marked = joined.select(*delta.columns, F.col(f"_held{counts[0]}").isNull().alias("_new"))
    return written, marked


def _apply_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    ts: str,
    customer: str,
    buckets: int = DEFAULT_BUCKETS,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    folder_rows: int = DEFAULT_FOLDER_ROWS,
) -> None:
    """Add one batch of rows; doing it again changes nothing, as both logs start from the version before it."""
    sizes = (buckets, bucket_rows, folder_rows)
    of_pairs = Layout([DAY, CUSTOMER], [DAY, CUSTOMER], [WRITTEN], *sizes)
    of_days = Layout([DAY], [DAY], [WRITTEN], *sizes)
    pairs, days = _places(root)
    spark = batch.sparkSession
    # Counted per day and customer before anything moves, so a busy day is spread over all tasks.
    delta = batch.groupBy(F.to_date(ts).alias(DAY), F.col(customer).alias(CUSTOMER)).agg(F.count("*").alias(ROWS))
    written, marked = _raised(delta, batch_id, pairs, of_pairs, [ROWS])
    fresh = F.col("_new") & F.col(CUSTOMER).isNotNull()
    per_day = marked.groupBy(DAY).agg(F.sum(ROWS).alias(ROWS), F.count_if(fresh).alias(CUSTOMERS))
    totals = _raised(per_day, batch_id, days, of_days, [ROWS, CUSTOMERS])[0]
    # Each looks at versions before this batch only, so the order does not matter.
    commit(written, batch_id, pairs, of_pairs, base_for(spark, pairs, of_pairs, batch_id))
    commit(totals, batch_id, days, of_days, base_for(spark, days, of_days, batch_id))


def keep_daily_counts(
    rows: DataFrame,
    root: str,
    checkpoint: str,
    ts: str,
    customer: str,
    buckets: int = DEFAULT_BUCKETS,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    folder_rows: int = DEFAULT_FOLDER_ROWS,
) -> RunReport:
    """Bring the counts below ``root`` up to date with all new rows of a stream."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        _apply_batch(batch, batch_id, root, ts, customer, buckets, bucket_rows, folder_rows)

    report = run_batches(rows, handle, checkpoint)
    for place in _places(root):
        prune_versions(rows.sparkSession, place)
    return report


def read_daily_counts(
    spark: SparkSession,
    root: str,
    day: str = "order_date",
    rows: str = "total_daily_orders",
    distinct: str = "unique_customers",
) -> DataFrame | None:
    """A row per day as ``aggregates.daily_counts`` gives it, or None before the first batch."""
    table = read_table(spark, _places(root)[1])
    if table is None:
        return None
    return table.select(F.col(DAY).alias(day), F.col(ROWS).alias(rows), F.col(CUSTOMERS).alias(distinct))
