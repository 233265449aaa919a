"""Lookups and star joins. Dimensions are made unique before they are joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.operators.cdc import dedupe_latest
from orebed.operators.skew import skew_join


def unique_on(dim: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key; without an ``order`` the choice falls on the row hash."""
    return dedupe_latest(dim, keys, [*order, F.xxhash64(*dim.columns)])


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Inner join of a fact to dimensions that hold their key once."""
    for dim, keys in dims:
        fact = skew_join(fact, dim, keys)
    return fact


def left_on_unique(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Optional attributes: every row stays, at most one match each."""
    return skew_join(df, dim, keys, "left")


def lookup_default(df: DataFrame, dim: DataFrame, keys: Sequence[str], column: str, default) -> DataFrame:
    found = skew_join(df, dim.select(*keys, column), keys, "left")
    return found.withColumn(column, F.coalesce(column, F.lit(default)))


def keep_matching(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``other``, however often."""
    return skew_join(df, other.select(*keys).distinct(), keys, "left_semi")
