"""Declared expectations on rows: warn, drop, or fail the run.

A null predicate counts as a violation. All rules see the same input row, and
a failing rule stops the run before any row is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def with_flags(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Keep every row and add one boolean column per rule."""
    return df.withColumns({rule.name: rule.holds() for rule in rules})


def apply_expectations(
    df: DataFrame, rules: Sequence[Expectation], observation: Observation | str = "expectations"
) -> DataFrame:
    """Apply the rules; counts go to ``observation`` when an action completes.

    The observed fields are ``rows`` (seen), ``rows_kept`` and ``failed_<rule>``.
    Give an ``Observation`` for a batch frame and a name for a streaming one.
    """
    # Each predicate is evaluated once; everything after reads the flag.
    flags = {f"_ok_{i}": rule for i, rule in enumerate(rules)}
    checked = df.withColumns({flag: rule.holds() for flag, rule in flags.items()})
    kept = F.lit(True)
    for flag, rule in flags.items():
        if rule.action == "drop":
            kept = kept & F.col(flag)
        if rule.action == "fail":
            # Part of the filter: an unused column would be pruned with its error.
            message = F.lit(f"expectation {rule.name} failed: {rule.predicate}")
            checked = checked.filter(F.when(F.col(flag), True).otherwise(F.raise_error(message)))
    counts = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(kept).alias("rows_kept"),
        *[F.count_if(~F.col(flag)).alias(f"failed_{rule.name}") for flag, rule in flags.items()],
    ]
    return checked.observe(observation, *counts).filter(kept).drop(*flags)


def expectation_metrics(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule with the passed and failed counts, in one pass."""
    totals = df.agg(
        *[F.count_if(rule.holds()).alias(f"p{i}") for i, rule in enumerate(rules)],
        *[F.count_if(~rule.holds()).alias(f"f{i}") for i, rule in enumerate(rules)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("constraint_name"),
                F.col(f"p{i}").alias("passed"),
                F.col(f"f{i}").alias("failed"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return totals.select(F.inline(lines))


def quarantine(df: DataFrame, rules: Sequence[Expectation], out: str = "failed_rules") -> DataFrame:
    """The rows that break at least one rule, with the names of the broken rules."""
    names = F.filter(
        F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules]), lambda name: name.isNotNull()
    )
    return df.withColumn(out, names).filter(F.size(out) > 0)
