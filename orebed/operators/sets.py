"""Set operations, sorts and limits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``; nulls count as equal.

    Both sides are made distinct first, so repeated rows never reach the join.
    """
    return left.distinct().subtract(right.distinct())


def sorted_view(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """A total order. End with a unique column, so that ties can be split too."""
    return df.orderBy(*order)


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def first_rows(df: DataFrame, k: int) -> DataFrame:
    """Any ``k`` rows."""
    return df.limit(k)
