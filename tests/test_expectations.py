import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation

from orebed.operators.expectations import (
    Expectation,
    apply_expectations,
    expectation_metrics,
    quarantine,
    with_flags,
)
from orebed.plans.customers import CUSTOMER_RULES
from tests.conftest import rows

SCHEMA = "id string, amount double"
DATA = [("a", 5.0), ("b", -1.0), ("c", None), (None, 7.0)]


def frame(spark, data=DATA):
    return spark.createDataFrame(data, SCHEMA)


def test_warn_keeps_rows_and_counts(spark):
    seen = Observation()
    out = apply_expectations(frame(spark), [Expectation("positive", "amount > 0")], seen)
    assert out.count() == 4
    assert seen.get == {"rows": 4, "rows_kept": 4, "failed_positive": 2}


def test_drop_counts_what_it_drops(spark):
    seen = Observation()
    rules = [Expectation("positive", "amount > 0", "drop"), Expectation("has_id", "id IS NOT NULL")]
    out = apply_expectations(frame(spark), rules, seen)
    assert rows(out) == rows(frame(spark, [("a", 5.0), (None, 7.0)]))
    assert seen.get == {"rows": 4, "rows_kept": 2, "failed_positive": 2, "failed_has_id": 1}


def test_fail_stops_before_drop(spark):
    rules = [Expectation("positive", "amount > 0", "drop"), Expectation("not_b", "id <> 'b'", "fail")]
    with pytest.raises(PySparkException, match="not_b"):
        apply_expectations(frame(spark), rules, Observation()).collect()


def test_fail_survives_column_pruning(spark):
    out = apply_expectations(frame(spark), [Expectation("has_id", "id IS NOT NULL", "fail")], Observation())
    with pytest.raises(PySparkException, match="has_id"):
        out.select("amount").collect()
    with pytest.raises(PySparkException, match="has_id"):
        out.count()


def test_fail_passes_clean_rows(spark):
    clean = frame(spark, DATA[:3])
    out = apply_expectations(clean, [Expectation("has_id", "id IS NOT NULL", "fail")], Observation())
    assert rows(out) == rows(clean)


def test_unknown_action():
    with pytest.raises(ValueError):
        Expectation("x", "true", "ignore")


def test_flags_and_metrics(spark):
    rules = [Expectation("positive", "amount > 0"), Expectation("has_id", "id IS NOT NULL")]
    flags = with_flags(frame(spark), rules).select("positive", "has_id")
    assert rows(flags) == [(False, True), (False, True), (True, False), (True, True)]
    assert rows(expectation_metrics(frame(spark), rules)) == [("has_id", 3, 1), ("positive", 2, 2)]


def test_quarantine(spark):
    rules = [Expectation("positive", "amount > 0"), Expectation("has_id", "id IS NOT NULL")]
    found = {(row["id"], tuple(row["failed_rules"])) for row in quarantine(frame(spark), rules).collect()}
    assert found == {("b", ("positive",)), ("c", ("positive",)), (None, ("has_id",))}


def test_customer_rules_null_email(spark):
    schema = "customer_id string, name string, email string, address string, city string, state string, zip_code string, operation string"
    full = ("n", "a@b.com", "s", "c", "st", "1")
    data = [
        ("1", *full, "INSERT"),
        ("2", "n", None, "s", "c", "st", "1", "INSERT"),
        ("3", None, None, None, None, None, None, "DELETE"),
        ("4", *full, None),
        ("5", "n", "bad", "s", "c", "st", "1", "UPDATE"),
        ("6", None, "a@b.com", None, "c", "st", "1", "UPDATE"),
    ]
    seen = Observation()
    out = apply_expectations(spark.createDataFrame(data, schema), CUSTOMER_RULES, seen)
    assert sorted(row["customer_id"] for row in out.collect()) == ["1", "3", "6"]
    counts = seen.get
    assert (counts["failed_valid_email"], counts["failed_valid_operation"]) == (2, 1)
    assert (counts["failed_valid_name"], counts["failed_valid_address"]) == (1, 1)
