"""Row filters, column masks and the audit trail."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_filter(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Only the rows a role may see."""
    return df.filter(F.col(column).isin(list(allowed)))


def partly_hidden(column: str, visible: int = 3) -> Column:
    """The first characters, then one star for each further one."""
    rest = F.greatest(F.length(column) - visible, F.lit(0))
    return F.concat(F.substring(column, 1, visible), F.repeat(F.lit("*"), rest))


def hidden_unless(column: str, condition: Column) -> Column:
    return F.when(condition, F.col(column))


def mask_columns(df: DataFrame, masks: Mapping[str, Column], cleared: bool = False) -> DataFrame:
    """Replace columns by their masks, unless the role is cleared to see them."""
    return df if cleared else df.withColumns(dict(masks))


def governed(
    df: DataFrame,
    table: str,
    policies: DataFrame,
    members: DataFrame,
    rows_by: str,
    masks: Mapping[str, Column],
    user: Column | None = None,
) -> DataFrame:
    """What one user may see of a table, by policies that are data.

    ``policies`` has (table_name, role, kind, column_name, value): a role sees the rows
    whose column has a value (kind ``rows``), and the plain text of a column (kind
    ``plain``). ``members`` has (user_name, role). A user's rights are those of all their
    roles; without any there are no rows, and columns in ``masks`` stay masked. The user
    is the session's, read whenever the frame runs, so one view serves everybody; a
    change of policies or members counts from the next run on. Rights are looked up
    before the table is read and pruned with them.
    """
    mine = members.filter(F.col("user_name") == (F.current_user() if user is None else user)).select("role")
    rights = policies.filter(F.col("table_name") == table).join(mine, "role", "left_semi")
    visible = rights.filter((F.col("kind") == "rows") & (F.col("column_name") == rows_by)).select(F.col("value").alias("_seen"))
    seen = df.join(visible, df[rows_by].cast("string") == F.col("_seen"), "left_semi")
    for name, mask in masks.items():
        plain = rights.filter((F.col("kind") == "plain") & (F.col("column_name") == name))
        # One number for the whole table, not a join.
        cleared = plain.agg(F.count("*").alias("n")).scalar() > 0
        seen = seen.withColumn(name, F.when(cleared, F.col(name)).otherwise(mask))
    return seen


def schema_hash(df: DataFrame) -> str:
    """A fingerprint of names and types."""
    return hashlib.sha256(df.schema.simpleString().encode()).hexdigest()


def audit_append(path: str, run_id: str, report: DataFrame, schemas: Mapping[str, str]) -> None:
    """Add the lines of a quality report to the audit trail.

    ``schemas`` maps table names to schema fingerprints.
    """
    pairs = [F.lit(part) for pair in schemas.items() for part in pair]
    lines = report.select(
        F.lit(run_id).alias("run_id"),
        "table_name",
        "rule",
        "n_violations",
        F.create_map(*pairs)[F.col("table_name")].alias("schema_hash"),
        F.current_timestamp().alias("logged_at"),
    )
    lines.write.mode("append").parquet(path)
