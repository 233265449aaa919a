"""Transactions job: a CSV hand-over to raw, clean and monthly tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from orebed.operators.aggregates import monthly_fact
from orebed.operators.expectations import Expectation, apply_expectations
from orebed.plans.layers import JobReport, Layers, open_layers
from orebed.session import fit_shuffle
from orebed.sources import commits
from orebed.sources.files import RESCUED, read_csv, with_ingest_metadata
from orebed.sources.tables import note_path
from orebed.streaming.run import RunReport

# The columns of the hand-over, its rules, the monthly table.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("branch_id", T.StringType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)
MONTHLY_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("year_month", T.StringType()),
        T.StructField("total_transactions", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("avg_ticket", T.DoubleType()),
        T.StructField("top_channel", T.StringType()),
    ]
)
TRANSACTION_RULES = [
    Expectation("valid_id", "transaction_id IS NOT NULL", "fail"),
    Expectation("valid_customer", "customer_id IS NOT NULL", "drop"),
    Expectation("valid_date", "transaction_date IS NOT NULL", "drop"),
    Expectation("valid_amount", "amount > 0"),
]
RAW, CLEAN, MONTHLY = "transactions_raw", "transactions_clean", "transactions_monthly"


def monthly(clean: DataFrame) -> DataFrame:
    return monthly_fact(clean, "customer_id", "transaction_date", "amount", "channel")


def handed_over(spark: SparkSession, source: str) -> DataFrame:
    return with_ingest_metadata(read_csv(spark, source, TRANSACTION_SCHEMA, rescue=True))


def read_table(spark: SparkSession, layers: Layers, name: str) -> DataFrame | None:
    """One of the job's tables as of its last finished run, or None before the first."""
    return commits.read_table(spark, layers.base, name)


def run(spark: SparkSession, source: str, root: str, validate: bool = False) -> JobReport:
    """Rebuild all three tables from the CSV below ``source``, as one change.

    If a rule fails or the run ends early, all three stay as they were; readers
    never see tables of different runs. Running it again gives the same tables.
    """
    if validate:
        raw = handed_over(spark, source)
        clean = apply_expectations(raw.drop(RESCUED), TRANSACTION_RULES, CLEAN)
        frames = {RAW: raw, CLEAN: clean, MONTHLY: monthly(clean)}
        return JobReport(schemas={name: frame.schema.simpleString() for name, frame in frames.items()})
    layers = open_layers(spark, root, "transactions")
    observation = Observation(CLEAN)
    with commits.change(spark, layers.base) as tables:
        raw = tables.write(RAW, handed_over(spark, source))
        clean = tables.write(CLEAN, apply_expectations(raw.drop(RESCUED), TRANSACTION_RULES, observation))
        tables.write(MONTHLY, monthly(fit_shuffle(clean)))
    commits.prune(spark, layers.base)
    counts = dict(observation.get)
    steps = {CLEAN: RunReport(rows_read=counts["rows"], batches=1, observed={CLEAN: counts})}
    note_path(spark, layers.notes, RAW, "Transactions as handed over", {"quality": "bronze"})
    note_path(spark, layers.notes, CLEAN, "Checked transactions", {"quality": "silver"})
    note_path(spark, layers.notes, MONTHLY, "Transactions per customer and month", {"quality": "gold"})
    return JobReport(steps=steps, layers=layers)
