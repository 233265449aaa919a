"""Customer job: change events to a checked stream, a current table, a summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orebed import paths
from orebed.functions.scalars import EMAIL_PATTERN, epoch_to_ts
from orebed.operators.aggregates import profile_summary
from orebed.operators.cdc import scd1, scd2
from orebed.operators.expectations import Expectation, apply_expectations
from orebed.plans.layers import JobReport, Layers, open_layers
from orebed.sources.files import RESCUED, ingest_json, read_stream_table, stream_json
from orebed.sources.tables import note_path, write_path
from orebed.streaming import history as kept_history
from orebed.streaming.run import RunReport, run_available
from orebed.streaming.snapshot import DEFAULT_BUCKETS, apply_scd1_stream, prune_versions, read_current

# The fields of a change event, the rules, and the columns that
# do not go into the current table.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("timestamp", T.DoubleType()),
    ]
)
RAW_SCHEMA = T.StructType(
    [
        *EVENT_SCHEMA.fields,
        T.StructField(RESCUED, T.StringType()),
        T.StructField("processing_time", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
    ]
)
EMAIL_SQL = EMAIL_PATTERN.replace("\\", "\\\\")
CUSTOMER_RULES = [
    Expectation("valid_id", "customer_id IS NOT NULL", "fail"),
    Expectation("valid_operation", "operation IS NOT NULL", "drop"),
    Expectation("valid_name", "name IS NOT NULL OR operation = 'DELETE'"),
    Expectation(
        "valid_address",
        "(address IS NOT NULL AND city IS NOT NULL AND state IS NOT NULL AND zip_code IS NOT NULL)"
        " OR operation = 'DELETE'",
    ),
    Expectation("valid_email", f"rlike(email, '{EMAIL_SQL}') OR operation = 'DELETE'", "drop"),
]
KEYS = ["customer_id"]
# The second column settles events whose whole second is the same.
SEQUENCE_BY = ["timestamp_datetime", "timestamp"]
DELETE_WHEN = "operation = 'DELETE'"
EXCEPT_COLUMNS = ["timestamp", RESCUED, "operation", "processing_time", "source_file"]
SUMMARY_COLUMNS = ["customer_id", "name", "state", "city"]
RAW, CLEAN, CURRENT, SUMMARY = "customer_events_raw", "customer_events_clean", "customers", "customers_summary"
HISTORY = "customers_history"
CLEAN_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField("timestamp_datetime", T.TimestampType())])


def checked_events(raw: DataFrame) -> DataFrame:
    typed = raw.withColumn("timestamp_datetime", epoch_to_ts("timestamp"))
    return apply_expectations(typed, CUSTOMER_RULES, CLEAN)


def bronze(spark: SparkSession, source: str, layers: Layers, max_files: int | None = None) -> RunReport:
    return ingest_json(
        spark,
        f"{source}/customers",
        EVENT_SCHEMA,
        layers.table("bronze", RAW),
        layers.checkpoint(RAW),
        rescue=True,
        max_files=max_files,
    )


def silver(spark: SparkSession, layers: Layers, max_files: int | None = None) -> RunReport:
    path = layers.table("bronze", RAW)
    if not paths.exists(spark, path):
        return RunReport()
    raw = read_stream_table(spark, path, RAW_SCHEMA, max_files)
    return run_available(checked_events(raw), layers.table("silver", CLEAN), layers.checkpoint(CLEAN))


def current(
    spark: SparkSession, layers: Layers, buckets: int = DEFAULT_BUCKETS, max_files: int | None = None
) -> RunReport:
    path = layers.table("silver", CLEAN)
    if not paths.exists(spark, path):
        return RunReport()
    events = read_stream_table(spark, path, CLEAN_SCHEMA, max_files)
    state = layers.table("gold", CURRENT)
    report = apply_scd1_stream(
        events, state, layers.checkpoint(CURRENT), KEYS, SEQUENCE_BY, DELETE_WHEN, buckets
    )
    prune_versions(spark, state)
    return report


def read_customers(spark: SparkSession, layers: Layers) -> DataFrame | None:
    return read_current(spark, layers.table("gold", CURRENT), EXCEPT_COLUMNS)


def past(spark: SparkSession, layers: Layers, buckets: int = DEFAULT_BUCKETS, max_files: int | None = None) -> RunReport:
    """Every state of every customer, with the time it held."""
    path = layers.table("silver", CLEAN)
    if not paths.exists(spark, path):
        return RunReport()
    events = read_stream_table(spark, path, CLEAN_SCHEMA, max_files)
    state = layers.table("gold", HISTORY)
    report = kept_history.apply_scd2_stream(
        events, state, layers.checkpoint(HISTORY), KEYS, SEQUENCE_BY, DELETE_WHEN, buckets
    )
    prune_versions(spark, state)
    return report


def read_history(spark: SparkSession, layers: Layers) -> DataFrame | None:
    return kept_history.read_history(spark, layers.table("gold", HISTORY), EXCEPT_COLUMNS)


def summary(spark: SparkSession, layers: Layers) -> None:
    customers = read_customers(spark, layers)
    if customers is not None:
        write_path(profile_summary(customers, SUMMARY_COLUMNS), layers.table("gold", SUMMARY))


def run(
    spark: SparkSession,
    source: str,
    root: str,
    validate: bool = False,
    full_refresh: bool = False,
    allow_reset: bool = False,
    buckets: int = DEFAULT_BUCKETS,
    max_files: int | None = None,
    history: bool = False,
) -> JobReport:
    """One triggered run over all new files; ``validate`` only checks the plans.

    ``history`` also keeps every state of every customer; the first run with it catches up.
    """
    if validate:
        raw = stream_json(spark, f"{source}/customers", EVENT_SCHEMA, rescue=True)
        clean = checked_events(raw)
        customers = scd1(clean, KEYS, SEQUENCE_BY, DELETE_WHEN, EXCEPT_COLUMNS)
        frames = {RAW: raw, CLEAN: clean, CURRENT: customers, SUMMARY: profile_summary(customers, SUMMARY_COLUMNS)}
        if history:
            # The shape of the history; a stream has no look-ahead of its own.
            events = spark.createDataFrame([], clean.schema)
            frames[HISTORY] = scd2(events, KEYS, SEQUENCE_BY, DELETE_WHEN, EXCEPT_COLUMNS)
        return JobReport(schemas={name: frame.schema.simpleString() for name, frame in frames.items()})
    layers = open_layers(spark, root, "customers", full_refresh, allow_reset)
    steps = {
        RAW: bronze(spark, source, layers, max_files),
        CLEAN: silver(spark, layers, max_files),
        CURRENT: current(spark, layers, buckets, max_files),
    }
    if history:
        steps[HISTORY] = past(spark, layers, buckets, max_files)
        note_path(spark, layers.notes, HISTORY, "Customer history", {"quality": "gold", "domain": "marketplace"})
    summary(spark, layers)
    note_path(spark, layers.notes, RAW, "Change events as they came", {"quality": "bronze", "reset.allowed": "false"})
    note_path(spark, layers.notes, CLEAN, "Checked change events", {"quality": "silver"})
    note_path(spark, layers.notes, CURRENT, "Current customers", {"quality": "gold", "domain": "marketplace"})
    note_path(spark, layers.notes, SUMMARY, "Customer summary", {"quality": "gold", "domain": "marketplace"})
    return JobReport(steps=steps, layers=layers)
