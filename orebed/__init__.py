"""Medallion, data-quality and change-data-capture jobs on Apache Spark."""
