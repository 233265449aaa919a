"""Joins and ordered look-ahead that hold up when one key has very many rows.

A join or a window sends all rows of a key to one task. Joins are laid out so
that Spark may split such a task at run time: both sides come straight from an
exchange made for the join. Windows cannot be split, so there the keys with very
many rows are found first, by a frequent-items sketch that every task fills and
Spark merges. The sketch decides the way a row takes, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.session import plan_bytes, shared_root

# A key with more rows than this is hot.
HOT_ROWS = "spark.orebed.hotRows"
DEFAULT_HOT_ROWS = 2_000_000
# The sketch follows so many keys and names the most frequent of them. Any key with more than
# a few of 100,000ths of all rows is among those followed; a rarer one fits a task.
FOLLOWED, NAMED = 100_000, 10_000
# The joined rows' key hash, which makes the join ask for an exchange of its own.
HASH = "_key_hash"


def _broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def will_broadcast(df: DataFrame) -> bool:
    """Whether Spark's estimate is within its own limit for a broadcast."""
    return plan_bytes(df) <= _broadcast_limit(df)


def heavy_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> dict[int, int]:
    """Hashes of keys with more than ``hot_rows`` rows, and about how many.

    One pass over the key columns, of which a sketch of fixed size is left. A key
    that shares a hash with a hot one is treated like it, which does no harm.
    """
    sketch = F.expr(f"approx_top_k({HASH}, {NAMED}, {FOLLOWED})").alias("found")
    found = df.select(F.xxhash64(*keys).alias(HASH)).agg(sketch).first()["found"] or []
    return {row["item"]: row["count"] for row in found if row["count"] > hot_rows}


def skew_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys; ``right`` holds each key at most once.

    A right side that Spark finds small is broadcast. Otherwise both sides are
    exchanged for this join, also one that an aggregate has dealt by these keys
    already: Spark can split the rows of a hot key over several tasks only when
    nothing but a sort stands between exchange and join.
    """
    keys = list(keys)
    for key in keys:  # a null key matches nothing, and there may be many
        right = right.filter(F.col(key).isNotNull())
    hashed = F.xxhash64(*keys)
    return left.withColumn(HASH, hashed).join(right.withColumn(HASH, hashed), [*keys, HASH], how).drop(HASH)


def lead_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add the next row's ``order[0]`` within each key, in the given order.

    Keys up to the hot limit use a plain window. The rows of hot keys are range
    partitioned on key and order, so that each slice holds a bounded run of
    consecutive rows; the look-ahead is taken within a slice, and the last row
    of a slice gets the first value of the key's next slice.
    """
    keys, order = list(keys), list(order)
    plain = Window.partitionBy(*keys).orderBy(*order)
    if hot_rows is None:
        hot_rows = int(df.sparkSession.conf.get(HOT_ROWS, str(DEFAULT_HOT_ROWS)))
    hot = heavy_keys(df, keys, hot_rows)
    if not hot:
        return df.withColumn(out, F.lead(order[0]).over(plain))

    shared_root(df.sparkSession)
    marks = F.broadcast(df.sparkSession.createDataFrame([(key,) for key in hot], f"{HASH} bigint"))  # NAMED at most

    def pick(how: str) -> DataFrame:
        return df.withColumn(HASH, F.xxhash64(*keys)).join(marks, HASH, how).drop(HASH)

    slices = math.ceil(sum(hot.values()) / hot_rows) + 1
    sliced = (
        pick("left_semi")
        .repartitionByRange(slices, *keys, *order)
        .withColumn("_slice", F.spark_partition_id())
        # Slice numbers are read twice below and must not change in between.
        .checkpoint()
    )
    # Each key fills a run of slices, so there are at most ``slices`` plus the
    # number of hot keys of these rows; Spark broadcasts them if they are small.
    heads = (
        sliced.groupBy("_slice", *keys)
        .agg(F.min(F.struct(*order)).alias("_head"))
        .withColumn("_next", F.lead(f"_head.{order[0]}").over(Window.partitionBy(*keys).orderBy("_slice")))
        .select(*[F.col(key).alias(f"_k_{key}") for key in keys], F.col("_slice").alias("_s"), "_next")
    )
    last = Window.partitionBy("_slice", *keys).orderBy(*order)
    stepped = sliced.withColumn(out, F.lead(order[0]).over(last)).withColumn(
        "_last", F.lead(F.lit(True)).over(last).isNull()
    )
    same = [stepped[key].eqNullSafe(heads[f"_k_{key}"]) for key in keys] + [stepped["_slice"] == heads["_s"]]
    spread = stepped.join(heads, same, "left").select(
        *df.columns, F.when(F.col("_last"), F.col("_next")).otherwise(F.col(out)).alias(out)
    )
    rest = pick("left_anti").withColumn(out, F.lead(order[0]).over(plain))
    return spread.unionByName(rest)


def known_values(domain: DataFrame | Sequence, column: str | None = None, limit: int = 10_000) -> list | None:
    """The distinct non-null values of a code domain, or None when over the limit."""
    if not isinstance(domain, DataFrame):
        return list(domain)
    name = column or domain.columns[0]
    rows = domain.select(name).na.drop().distinct().limit(limit + 1).collect()
    return [row[0] for row in rows] if len(rows) <= limit else None


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
