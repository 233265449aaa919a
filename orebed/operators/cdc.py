"""Change-data-capture: upserts, history, merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.operators.skew import as_column, lead_by_key, skew_join

DELETED = "_deleted"
TIE = "_tie"
# Columns that tell how an event came in. They differ from one ingest to the next, so they settle nothing.
BOOKKEEPING = ("processing_time", "source_file")


def prepare_events(df: DataFrame, delete_when: Column | str, tie_columns: Sequence[str] | None = None) -> DataFrame:
    """Add the delete mark and a row hash that settles equal sequence values.

    The hash is over ``tie_columns``, all but the bookkeeping columns if not given.
    """
    deleted = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    payload = list(tie_columns or [name for name in df.columns if name not in BOOKKEEPING])
    return df.withColumns({DELETED: F.coalesce(deleted, F.lit(False)), TIE: F.xxhash64(*payload)})


def latest_events(prepared: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """The winning event per key, deletes included as tombstones.

    Order: the sequence columns, then a delete after any other event, then the
    row hash. The maximum is taken map-side first, so a hot key sends one row
    per task.
    """
    order = F.struct(*sequence_by, DELETED, TIE)
    packed = F.struct(*prepared.columns)
    return prepared.groupBy(*keys).agg(F.max_by(packed, order).alias("_win")).select("_win.*")


def current_rows(latest: DataFrame, except_columns: Sequence[str] = ()) -> DataFrame:
    """The visible table: tombstones and bookkeeping columns removed."""
    return latest.filter(~F.col(DELETED)).drop(DELETED, TIE, *except_columns)


def scd1(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    delete_when: Column | str,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """Current state per key: the last event wins, deletes remove the key."""
    return current_rows(latest_events(prepare_events(df, delete_when), keys, sequence_by), except_columns)


def scd2(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    delete_when: Column | str,
    except_columns: Sequence[str] = (),
    start: str = "__START_AT",
    end: str = "__END_AT",
    current: str = "__CURRENT",
    hot_rows: int | None = None,
) -> DataFrame:
    """Full history: a row per change, valid from its own sequence to the next.

    A delete closes the row before it and gives none itself.
    """
    first = sequence_by[0]
    prepared = prepare_events(df, delete_when).withColumn(start, F.col(first))
    ordered = lead_by_key(prepared, keys, [start, *sequence_by[1:], DELETED, TIE], end, hot_rows)
    history = ordered.filter(~F.col(DELETED)).withColumn(current, F.col(end).isNull())
    return history.drop(DELETED, TIE, *except_columns)


def merge_into(target: DataFrame, source: DataFrame, on: Sequence[str], op_column: str) -> DataFrame:
    """Target after a merge: UPDATE and DELETE act on matches, INSERT on the rest.

    The run fails when several UPDATE or DELETE rows hit one target row.
    """
    on = list(on)
    values = [column for column in target.columns if column not in on]
    changes = (
        source.filter(F.col(op_column).isin("UPDATE", "DELETE"))
        .groupBy(*on)
        .agg(
            F.count(F.lit(1)).alias("_hits"),
            F.any_value(F.struct(F.col(op_column).alias("op"), *values)).alias("_change"),
        )
    )
    several = F.raise_error(F.lit("merge: several source rows change one target row"))
    matched = (
        skew_join(target, changes, on, "left")
        .filter(F.when(F.col("_hits") > 1, several).otherwise(~F.col("_change.op").eqNullSafe("DELETE")))
        .select(
            *on,
            *[
                F.when(F.col("_change.op") == "UPDATE", F.col(f"_change.{name}")).otherwise(F.col(name)).alias(name)
                for name in values
            ],
        )
    )
    inserts = source.filter(F.col(op_column) == "INSERT").select(*on, *values)
    fresh = skew_join(inserts, target.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(fresh).select(*target.columns)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the one that is last in ``order``."""
    packed = F.struct(*df.columns)
    ranked = F.struct(*[as_column(part).alias(f"o{i}") for i, part in enumerate(order)])
    return df.groupBy(*keys).agg(F.max_by(packed, ranked).alias("_last")).select("_last.*")
