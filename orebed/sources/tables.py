"""Sinks: tables with comment and properties, file exports, folder layout."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed import paths

LAYERS = ("bronze", "silver", "gold")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_table(
    df: DataFrame,
    name: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    path: str | None = None,
) -> None:
    """Overwrite a catalog table; running it again gives the same table."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    describe_table(df.sparkSession, name, comment, properties)


def describe_table(
    spark: SparkSession, name: str, comment: str | None = None, properties: Mapping[str, str] | None = None
) -> None:
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    if properties:
        pairs = ", ".join(f"{_quoted(key)} = {_quoted(value)}" for key, value in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def write_path(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a parquet folder."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def note_path(
    spark: SparkSession, notes: str, table: str, comment: str, properties: Mapping[str, str] | None = None
) -> None:
    """Keep comment and properties of a folder table in a notes folder."""
    text = json.dumps({"comment": comment, "properties": dict(properties or {})}, sort_keys=True)
    path = f"{notes}/{table}.json"
    if paths.read_text(spark, path) != text:
        paths.write_text(spark, path, text)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> bool:
    """Create an empty table unless it exists. True when it was created."""
    if spark.catalog.tableExists(name):
        return False
    writer = spark.createDataFrame([], schema).write.format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return True


def ensure_namespaces(spark: SparkSession, names: Sequence[str] = LAYERS) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def ensure_layout(spark: SparkSession, root: str, feeds: Sequence[str] = ()) -> dict[str, str]:
    """Make the landing and layer folders; existing ones are left alone."""
    places = {name: f"{root}/{name}" for name in LAYERS}
    places.update({feed: f"{root}/ingest/raw/{feed}" for feed in feeds})
    for place in places.values():
        paths.make_dirs(spark, place)
    return places


def export_csv(df: DataFrame, path: str) -> str:
    """Uncompressed CSV below ``path``, with a header line in every part file."""
    df.write.mode("overwrite").option("header", True).option("compression", "none").csv(path)
    return path


def export_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines. Timestamps become ISO text; null fields are left out."""
    stamps = {
        field.name: F.date_format(field.name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        for field in df.schema
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    df.withColumns(stamps).write.mode(mode).option("compression", "none").json(path)
    return path
