"""Projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.operators.skew import as_column


def silver_projection(df: DataFrame, spec: Mapping[str, Column | str]) -> DataFrame:
    """Exactly the named columns, each from a column or expression."""
    return df.select(*[as_column(source).alias(name) for name, source in spec.items()])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All columns but these."""
    return df.drop(*columns)


def tagged(df: DataFrame, name: str, value) -> DataFrame:
    """The same rows with a constant column in front."""
    return df.select(F.lit(value).alias(name), "*")
