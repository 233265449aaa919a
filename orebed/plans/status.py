"""Status job: status files to a raw table and the latest status per order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed import paths
from orebed.functions.scalars import epoch_to_ts
from orebed.operators.expectations import Expectation, apply_expectations
from orebed.plans.layers import JobReport, Layers, open_layers
from orebed.sources.files import ingest_json, read_stream_table
from orebed.sources.tables import note_path
from orebed.streaming.snapshot import DEFAULT_BUCKETS, apply_scd1_stream, prune_versions, read_current

# The fields of a status file.
STATUS_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("status_timestamp", T.DoubleType()),
    ]
)
# A line that is no JSON has no order; the raw table keeps it.
STATUS_RULES = [Expectation("valid_order", "order_id IS NOT NULL", "drop")]
RAW, LATEST = "status_raw", "order_status"


def run(
    spark: SparkSession, source: str, root: str, buckets: int = DEFAULT_BUCKETS, max_files: int | None = None
) -> JobReport:
    """One triggered run over all new status files, in batches of ``max_files`` if given."""
    layers = open_layers(spark, root, "status")
    raw = layers.table("bronze", RAW)
    feed = f"{source}/status"
    steps = {RAW: ingest_json(spark, feed, STATUS_SCHEMA, raw, layers.checkpoint(RAW), rescue=True, max_files=max_files)}
    if paths.exists(spark, raw):
        state = layers.table("gold", LATEST)
        steps[LATEST] = apply_scd1_stream(
            apply_expectations(read_stream_table(spark, raw, STATUS_SCHEMA, max_files), STATUS_RULES, LATEST),
            state,
            layers.checkpoint(LATEST),
            ["order_id"],
            ["status_timestamp"],
            F.lit(False),
            buckets,
        )
        prune_versions(spark, state)
    note_path(spark, layers.notes, RAW, "Status files as they came", {"quality": "bronze"})
    note_path(spark, layers.notes, LATEST, "Latest status per order", {"quality": "gold", "domain": "marketplace"})
    return JobReport(steps=steps, layers=layers)


def latest_in(spark: SparkSession, layers: Layers) -> DataFrame | None:
    latest = read_current(spark, layers.table("gold", LATEST))
    return None if latest is None else latest.withColumn("status_time", epoch_to_ts("status_timestamp", "exact"))


def read_status(spark: SparkSession, root: str) -> DataFrame | None:
    return latest_in(spark, open_layers(spark, root, "status"))
