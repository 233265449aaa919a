"""Names for the tables of finished jobs, so that they can be asked in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orebed import paths
from orebed.plans import customers, orders, status, transactions
from orebed.plans.layers import Layers

# Tables that are plain parquet folders: layer and name.
FOLDERS = [
    ("bronze", orders.RAW),
    ("silver", orders.CLEAN),
    ("bronze", customers.RAW),
    ("silver", customers.CLEAN),
    ("gold", customers.SUMMARY),
    ("bronze", status.RAW),
]


def register(spark: SparkSession, layers: Layers) -> list[str]:
    """Make a temporary view of every table of the job that exists, as of now.

    Streamed folders are read through their commit log, so that a view never
    shows files of an unfinished batch. Call again after a run.
    """
    found: dict[str, DataFrame | None] = {
        name: spark.read.parquet(layers.table(layer, name))
        for layer, name in FOLDERS
        if paths.exists(spark, layers.table(layer, name))
    }
    found[orders.DAILY] = orders.read_daily(spark, layers)
    found[customers.CURRENT] = customers.read_customers(spark, layers)
    found[status.LATEST] = status.latest_in(spark, layers)
    for name in (transactions.RAW, transactions.CLEAN, transactions.MONTHLY):
        found[name] = transactions.read_table(spark, layers, name)
    names = [name for name, df in found.items() if df is not None]
    for name in names:
        found[name].createOrReplaceTempView(name)
    return names
