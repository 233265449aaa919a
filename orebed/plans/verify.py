"""Checks on the tables of finished jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.operators.aggregates import table_counts
from orebed.operators.sets import except_distinct
from orebed.plans import customers, orders
from orebed.plans.layers import Layers


def order_counts(spark: SparkSession, layers: Layers) -> DataFrame:
    return table_counts(
        {
            "orders": spark.read.parquet(layers.table("bronze", orders.RAW)),
            "orders_clean": spark.read.parquet(layers.table("silver", orders.CLEAN)),
            "order_summary": orders.read_daily(spark, layers),
        }
    )


def customer_counts(spark: SparkSession, layers: Layers) -> DataFrame:
    return table_counts(
        {
            "customers_raw": spark.read.parquet(layers.table("bronze", customers.RAW)),
            "customers_clean": spark.read.parquet(layers.table("silver", customers.CLEAN)),
            "customers (current)": customers.read_customers(spark, layers),
        }
    )


def customers_in(spark: SparkSession, layers: Layers, city: str) -> DataFrame:
    """Current customers of a city, in order of their id."""
    chosen = customers.read_customers(spark, layers).filter(F.col("city") == city)
    return chosen.select("customer_id", "name", "email", "city", "state").orderBy("customer_id")


def deleted_customers(spark: SparkSession, layers: Layers) -> DataFrame:
    """Ids with a delete event that are not in the current table."""
    raw = spark.read.parquet(layers.table("bronze", customers.RAW))
    gone = raw.filter(F.col("operation") == "DELETE").select("customer_id")
    return except_distinct(gone, customers.read_customers(spark, layers).select("customer_id"))
