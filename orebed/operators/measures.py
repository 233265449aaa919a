"""Named measures that add up in a stated way, over several groupings at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Total:
    """A sum over rows; sums of groups add up to the sum of all."""

    name: str
    value: Column


@dataclass(frozen=True)
class Ratio:
    """One total over another. Of a larger group it is taken from the parts, never from ratios; null over zero."""

    name: str
    over: str
    under: str
    digits: int = 6


@dataclass(frozen=True)
class Members:
    """How many different values of a column, nulls left out. Groups share members, so counts don't add up."""

    name: str
    column: str


def measured(df: DataFrame, measures: Sequence[Total | Ratio | Members], dims: Sequence[str], groupings: Sequence[Sequence[str]]) -> DataFrame:
    """One row per group of each grouping: ``dims`` (null where not grouped by), ``level`` and the measures.

    ``level`` has a bit for each dimension, the first highest, set where rows are not grouped by it, which tells totals from
    groups of null. All groupings come from one aggregate at the finest grain (all dimensions, and the member column), so rows
    are read once, and only grains are repeated per grouping. Members are counted exactly, one column of them at most.
    An empty input has no rows, not even a total.
    """
    totals = [m for m in measures if isinstance(m, Total)]
    members = [m for m in measures if isinstance(m, Members)]
    names = {m.name for m in totals}
    for ratio in (m for m in measures if isinstance(m, Ratio)):
        if not {ratio.over, ratio.under} <= names:
            raise ValueError(f"{ratio.name} needs the totals {ratio.over} and {ratio.under}")
    if len({m.column for m in members}) > 1:
        raise ValueError("members of one column only")
    # Copies, so that the member column may be a dimension as well.
    member = F.col(members[0].column) if members else F.lit(0)
    grain = df.groupBy(*dims, member.alias("_member")).agg(*[F.sum(m.value).alias(m.name) for m in totals])
    sums = [F.sum(m.name).alias(m.name) for m in totals]
    wide = [[*map(F.col, grouping), F.col("_member")] for grouping in groupings]
    once = grain.groupingSets(wide, *map(F.col, dims), F.col("_member")).agg(F.grouping_id().alias("_id"), *sums)
    # The member is the last bit and always grouped by.
    once = once.withColumn("level", F.shiftright("_id", 1))
    whole = once.groupBy(*dims, "level").agg(*sums, F.count("_member").alias("_members"))
    shown: list[Column] = []
    for m in measures:
        if isinstance(m, Total):
            shown.append(F.col(m.name))
        elif isinstance(m, Ratio):
            shown.append(F.round(F.try_divide(F.col(m.over), F.col(m.under)), m.digits).alias(m.name))
        else:
            shown.append(F.col("_members").alias(m.name))
    return whole.select(*dims, "level", *shown)
