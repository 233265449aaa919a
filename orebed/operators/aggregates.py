"""Gold aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.functions.scalars import ladder
from orebed.operators.projections import tagged
from orebed.operators.skew import as_column, will_broadcast


def daily_counts(
    df: DataFrame,
    ts: str,
    customer: str,
    day: str = "order_date",
    rows: str = "total_daily_orders",
    distinct: str = "unique_customers",
) -> DataFrame:
    """Rows and exact distinct customers per day.

    Counted per day and customer first, so a busy day is spread over all tasks.
    """
    per_customer = df.groupBy(F.to_date(ts).alias(day), customer).agg(F.count(F.lit(1)).alias("_n"))
    return per_customer.groupBy(day).agg(F.sum("_n").alias(rows), F.count(customer).alias(distinct))


def monthly_fact(df: DataFrame, customer: str, ts: str, amount: str, channel: str) -> DataFrame:
    """Per customer and month: rows, sum, mean and the most frequent channel.

    Channel ties go to the smallest name; a null channel is counted in the
    totals but cannot be the top one. Counting per channel first keeps the state
    fixed-size and needs a single scan.
    """
    rank = F.when(F.col("_channel").isNotNull(), F.struct(-F.col("_n"), F.col("_channel")))
    month = F.trunc(ts, "MM").alias("_month")
    per_channel = df.groupBy(F.col(customer).alias("customer_id"), month, F.col(channel).alias("_channel")).agg(
        F.count(F.lit(1)).alias("_n"), F.count(amount).alias("_priced"), F.sum(amount).alias("_sum")
    )
    monthly = per_channel.groupBy("customer_id", "_month").agg(
        F.sum("_n").alias("total_transactions"),
        F.sum("_sum").alias("_sum"),
        F.sum("_priced").alias("_priced"),
        F.min_by("_channel", rank).alias("_best"),
    )
    return monthly.select(
        "customer_id",
        F.date_format("_month", "yyyy-MM").alias("year_month"),
        "total_transactions",
        F.round("_sum", 2).alias("total_amount"),
        F.round(F.try_divide("_sum", "_priced"), 6).alias("avg_ticket"),
        F.col("_best").alias("top_channel"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = {name: df.agg(F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()}
    parts = [tagged(count, "table_name", name) for name, count in counts.items()]
    return reduce(DataFrame.unionByName, parts)


def profile_summary(df: DataFrame, columns: Sequence[str], clock: str = "last_refreshed") -> DataFrame:
    return df.select(*columns, F.current_timestamp().alias(clock))


def sums_by_dimension(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    by: Sequence[str],
    measures: Mapping[str, Column],
    within: Sequence[str] = (),
    members: str | None = None,
) -> DataFrame:
    """Sums of fact measures per dimension attribute (and fact column ``within``).

    ``dim`` holds ``key`` once; ``members`` names a column counting the distinct
    keys. A dimension Spark will broadcast is joined where the facts are read.
    A larger one is joined to the facts already summed per key, so the join
    moves one row per key (and ``within``) whatever the skew. Either way a row
    per key is made before members are counted, which is then a plain count.
    """
    first = [F.sum(value).alias(name) for name, value in measures.items()]
    totals = [F.sum(name).alias(name) for name in measures]
    if members:
        totals.append(F.count(F.lit(1)).alias(members))
    if will_broadcast(dim):
        joined = facts.join(dim, key)
        if not members:
            return joined.groupBy(*by, *within).agg(*first)
        parts = joined.groupBy(*by, *within, key).agg(*first)
    else:
        parts = facts.groupBy(key, *within).agg(*first).join(dim, key)
    return parts.groupBy(*by, *within).agg(*totals)


def npl_ratio(df: DataFrame, dims: Sequence[str], balance: str, days: str, threshold: int = 90) -> DataFrame:
    """Balance overdue by more than ``threshold`` days over the whole balance."""
    overdue = F.sum(F.when(F.col(days) > threshold, F.col(balance)).otherwise(0.0))
    return df.groupBy(*dims).agg(
        F.round(F.sum(balance), 2).alias("portfolio"),
        F.round(F.try_divide(overdue, F.sum(balance)), 6).alias("npl_ratio"),
    )


def bucket_mix(df: DataFrame, days: str, balance: str, edges) -> DataFrame:
    return df.groupBy(ladder(days, edges).alias("dpd_bucket")).agg(
        F.count(F.lit(1)).alias("n_loans"), F.round(F.sum(balance), 2).alias("balance")
    )


def yoy(monthly: DataFrame, year: str, month: str, value: str, out: str = "yoy_growth") -> DataFrame:
    """Growth over the same month one year before; null where there is none."""
    before = monthly.select(
        (F.col(year) + 1).cast(monthly.schema[year].dataType).alias(year), month, F.col(value).alias("_before")
    )
    growth = F.round(F.try_divide(F.col(value), F.col("_before")) - 1, 4)
    return monthly.join(before, [year, month], "left").select(year, month, growth.alias(out))


def kpi_daily(
    facts: DataFrame, dim: DataFrame, key: str, region: str, date: str, measures: Mapping[str, Column]
) -> DataFrame:
    """Daily sums by region with the number of active customers."""
    dated = facts.withColumn("kpi_date", F.to_date(date))
    return sums_by_dimension(dated, dim, key, [region], measures, ["kpi_date"], "active_customers")


def metric(
    df: DataFrame, dims: Sequence[Column | str], measures: Mapping[str, Column], rollup: bool = False
) -> DataFrame:
    """Named measures over named dimensions, with subtotals when ``rollup``."""
    grouped = df.rollup(*dims) if rollup else df.groupBy(*dims)
    return grouped.agg(*[as_column(value).alias(name) for name, value in measures.items()])


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
