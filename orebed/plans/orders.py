"""Orders job: JSON files to raw, checked and daily tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed import paths
from orebed.functions.scalars import to_ts
from orebed.operators.aggregates import daily_counts
from orebed.operators.expectations import Expectation, apply_expectations
from orebed.plans.layers import JobReport, Layers, open_layers
from orebed.sources.files import ingest_json, read_stream_table, stream_json
from orebed.sources.tables import export_jsonl, note_path
from orebed.streaming.daily import keep_daily_counts, read_daily_counts
from orebed.streaming.run import RunReport, run_available
from orebed.streaming.touched import read_days, refresh_days

# The fields of an order file and the rules of the checked table.
ORDER_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_timestamp", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField(
            "notifications",
            T.StructType([T.StructField("email", T.BooleanType()), T.StructField("sms", T.BooleanType())]),
        ),
    ]
)
CLEAN_SCHEMA = T.StructType(
    [
        ORDER_SCHEMA["order_id"],
        T.StructField("order_timestamp", T.TimestampType()),
        ORDER_SCHEMA["customer_id"],
        ORDER_SCHEMA["notifications"],
    ]
)
ORDER_RULES = [
    Expectation("valid_order_id", "order_id IS NOT NULL", "fail"),
    Expectation("valid_customer_id", "customer_id IS NOT NULL"),
    Expectation("valid_timestamp", "order_timestamp > '2020-01-01'"),
]
RAW, CLEAN, DAILY = "orders_raw", "orders_clean", "orders_daily"
COUNTS = "orders_daily_counts"


def checked_orders(raw: DataFrame, mode: str = "strict") -> DataFrame:
    """The silver projection with its expectations, on a stream or a batch."""
    time = to_ts("order_timestamp", mode).alias("order_timestamp")
    typed = raw.select("order_id", time, "customer_id", "notifications")
    return apply_expectations(typed, ORDER_RULES, CLEAN)


def bronze(spark: SparkSession, source: str, layers: Layers, max_files: int | None = None) -> RunReport:
    return ingest_json(
        spark,
        f"{source}/orders",
        ORDER_SCHEMA,
        layers.table("bronze", RAW),
        layers.checkpoint(RAW),
        rescue=True,
        max_files=max_files,
    )


def silver(
    spark: SparkSession, layers: Layers, mode: str = "strict", max_files: int | None = None
) -> RunReport:
    path = layers.table("bronze", RAW)
    if not paths.exists(spark, path):
        return RunReport()
    raw = read_stream_table(spark, path, ORDER_SCHEMA, max_files)
    return run_available(checked_orders(raw, mode), layers.table("silver", CLEAN), layers.checkpoint(CLEAN))


def daily_of(clean: DataFrame) -> DataFrame:
    return daily_counts(clean, "order_timestamp", "customer_id", day="order_date")


def gold(spark: SparkSession, layers: Layers) -> RunReport:
    """Recompute the days that have new orders."""
    path = layers.table("silver", CLEAN)
    if not paths.exists(spark, path):
        return RunReport()
    return refresh_days(
        read_stream_table(spark, path, CLEAN_SCHEMA),
        path,
        "order_timestamp",
        "order_date",
        daily_of,
        layers.table("gold", DAILY),
        layers.checkpoint(DAILY),
    )


def gold_by_differences(spark: SparkSession, layers: Layers, max_files: int | None = None) -> RunReport:
    """Add the new orders to the counts of their days; earlier orders are not read again."""
    path = layers.table("silver", CLEAN)
    if not paths.exists(spark, path):
        return RunReport()
    clean = read_stream_table(spark, path, CLEAN_SCHEMA, max_files)
    root, checkpoint = layers.table("gold", COUNTS), layers.checkpoint(COUNTS)
    return keep_daily_counts(clean, root, checkpoint, "order_timestamp", "customer_id")


def read_daily(spark: SparkSession, layers: Layers) -> DataFrame | None:
    """The daily table, whichever way it is kept; if both ways are, that of whole days."""
    whole = read_days(spark, layers.table("gold", DAILY))
    return read_daily_counts(spark, layers.table("gold", COUNTS)) if whole is None else whole


def run(
    spark: SparkSession,
    source: str,
    root: str,
    validate: bool = False,
    full_refresh: bool = False,
    allow_reset: bool = False,
    mode: str = "strict",
    max_files: int | None = None,
    by_differences: bool = False,
) -> JobReport:
    """One triggered run over all new files; ``validate`` only checks the plans.

    ``by_differences`` keeps the daily table from counts per day and customer, so that a
    run reads its new orders alone; otherwise the days with new orders are read again.
    """
    if validate:
        raw = stream_json(spark, f"{source}/orders", ORDER_SCHEMA, rescue=True)
        clean = checked_orders(raw, mode)
        frames = {RAW: raw, CLEAN: clean, DAILY: daily_of(clean)}
        return JobReport(schemas={name: frame.schema.simpleString() for name, frame in frames.items()})
    layers = open_layers(spark, root, "orders", full_refresh, allow_reset)
    steps = {RAW: bronze(spark, source, layers, max_files), CLEAN: silver(spark, layers, mode, max_files)}
    steps[DAILY] = gold_by_differences(spark, layers, max_files) if by_differences else gold(spark, layers)
    note_path(spark, layers.notes, RAW, "Order files as they came", {"quality": "bronze", "reset.allowed": "false"})
    note_path(spark, layers.notes, CLEAN, "Typed and checked orders", {"quality": "silver"})
    note_path(spark, layers.notes, DAILY, "Orders and customers per day", {"quality": "gold", "domain": "marketplace"})
    return JobReport(steps=steps, layers=layers)


def land_orders(orders: DataFrame, source: str, mode: str = "overwrite") -> None:
    """Write orders as a landing feed, with the notification wishes as a struct."""
    wishes = F.struct(F.col("wants_email").alias("email"), F.col("wants_sms").alias("sms"))
    export_jsonl(
        orders.select("order_id", "order_timestamp", "customer_id", wishes.alias("notifications")),
        f"{source}/orders",
        mode,
    )
