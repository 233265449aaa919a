"""Money-laundering alerts and per-group statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orebed.operators.skew import skew_join


def amount_outliers(df: DataFrame, key: str, amount: str, k: float) -> DataFrame:
    """Rows whose amount exceeds the key's mean by ``k`` standard deviations.

    Mean and deviation come from one aggregate that is joined back; a window
    would pull all rows of a key into one task.
    """
    bound = (F.avg(amount) + F.lit(float(k)) * F.stddev_samp(amount)).alias("_bound")
    limits = df.groupBy(key).agg(bound)
    return skew_join(df, limits, [key]).filter(F.col(amount) > F.col("_bound")).drop("_bound")


def frequent_movements(df: DataFrame, key: str, ts: str, amount: str, min_count: int, day: str = "d") -> DataFrame:
    """Keys with at least ``min_count`` movements on one day."""
    return (
        df.groupBy(key, F.to_date(ts).alias(day))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(amount), 2).alias("total"))
        .filter(F.col("n") >= min_count)
    )


def tier_alerts(df: DataFrame, tiers: DataFrame, key: str, tier: str, levels: Sequence[str]) -> DataFrame:
    """Rows whose category carries one of the given risk levels."""
    return skew_join(df, tiers.filter(F.col(tier).isin(list(levels))).select(key, tier), [key])


def group_apply(
    df: DataFrame,
    keys: Sequence[str],
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    partial_schema: T.StructType | str,
    merge: Mapping[str, Column],
) -> DataFrame:
    """Run a pandas function per group without ever holding a whole group.

    ``partial`` turns one Arrow batch into partial rows per key; Spark merges
    those with the ``merge`` aggregates. Any group size works, as only partial
    rows are shuffled. Its frames have Arrow types, so that nulls leave whole numbers whole.
    """
    fields = partial_schema if isinstance(partial_schema, T.StructType) else T.StructType.fromDDL(partial_schema)
    kinds = to_arrow_schema(fields)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            table = pa.Table.from_pandas(partial(part.to_pandas(types_mapper=pd.ArrowDtype)), preserve_index=False)
            yield from table.select(kinds.names).cast(kinds).to_batches()

    parts = df.mapInArrow(batches, fields)
    return parts.groupBy(*keys).agg(*[value.alias(name) for name, value in merge.items()])


def group_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows, known values, their sum, mean and maximum per group by way of pandas."""
    names = list(keys)

    def partial(frame: pd.DataFrame) -> pd.DataFrame:
        grouped = frame.groupby(names, dropna=False)[value]
        counts = grouped.agg(n="size", known="count", top="max")
        return counts.assign(total=grouped.sum(min_count=1)).reset_index()

    fields = [df.schema[name] for name in names]
    schema = T.StructType(
        [
            *fields,
            T.StructField("n", T.LongType()),
            T.StructField("known", T.LongType()),
            T.StructField("total", T.DoubleType()),
            T.StructField("top", T.DoubleType()),
        ]
    )
    merge = {
        "n": F.sum("n"),
        "n_known": F.sum("known"),
        "total_value": F.sum("total"),
        "mean_value": F.try_divide(F.sum("total"), F.sum("known")),
        "max_value": F.max("top"),
    }
    return group_apply(df.select(*names, value), names, partial, schema, merge)
