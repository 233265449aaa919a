import datetime as dt

import pytest
from pyspark.sql import functions as F

from orebed.functions.scalars import DPD_EDGES
from orebed.operators import rules as R
from orebed.operators import skew
from tests.conftest import rows


def ids(df):
    return sorted(row["id"] for row in df.collect())


def test_null_rule_sees_nan(spark):
    df = spark.createDataFrame([(1, 0.2, "x"), (2, float("nan"), "x"), (3, None, "x"), (4, 0.1, None)], "id int, rate double, region string")
    assert ids(R.null_rule(df, ["rate"])) == [2, 3]
    assert ids(R.null_rule(df, ["rate", "region"])) == [2, 3, 4]


def test_future_date(spark):
    df = spark.createDataFrame([(1, dt.date(2027, 3, 15)), (2, dt.date(2026, 4, 30)), (3, None)], "id int, d date")
    assert ids(R.future_date(df, "d", dt.date(2026, 4, 30))) == [1]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "id int, k string")
    assert rows(R.duplicate_key(df, ["k"])) == [("a", 2), (None, 2)]
    assert R.surplus_rows(df, ["k"]).first()["n"] == 2
    assert R.surplus_rows(df.filter("id < 2"), ["k"]).first()["n"] == 0
    # Rows are only brought back for real keys.
    assert ids(R.duplicate_rows(df, ["k"])) == [1, 2]


@pytest.mark.parametrize("as_frame", [False, True])
@pytest.mark.parametrize("large", [False, True])
def test_codes(spark, monkeypatch, as_frame, large):
    if large:
        monkeypatch.setattr(R, "known_values", lambda domain, **_: None if as_frame else list(domain))
    df = spark.createDataFrame([(1, "Retail"), (2, "retail"), (3, "PYME"), (4, "Otro"), (5, None)], "id int, segment string")
    domain = ["Retail", "PYME"]
    if as_frame:
        domain = spark.createDataFrame([(name,) for name in domain], "segment string")
    assert ids(R.case_inconsistent(df, "segment", domain)) == [2]
    assert ids(R.unknown_code(df, "segment", domain)) == [2, 4]


def test_known_values_limit(spark):
    domain = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "code string")
    assert sorted(skew.known_values(domain)) == ["a", "b", "c"]
    assert skew.known_values(domain, limit=2) is None


def test_numbers(spark):
    df = spark.createDataFrame(
        [(1, 150, 0.0, "Aprobada"), (2, 950, -0.0, "Aprobada"), (3, 300, -1.5, "Rechazada"), (4, 850, 0.0, "Pendiente")],
        "id int, score int, amount double, status string",
    )
    assert ids(R.out_of_range(df, "score", 300, 850)) == [1, 2]
    assert ids(R.zero_when(df, "amount", F.col("status") == "Aprobada")) == [1, 2]
    assert ids(R.negative(df, "amount")) == [3]
    assert ids(R.sentinel(df, "score", [950])) == [2]


def test_loans(spark):
    d = dt.date
    df = spark.createDataFrame(
        [
            (1, d(2024, 1, 1), d(2023, 7, 5), 100.0, 100.0, 0, "Al_Dia"),
            (2, d(2024, 1, 1), d(2025, 1, 1), 100.0, 125.0, 31, "31-60"),
            (3, d(2024, 1, 1), d(2025, 1, 1), 100.0, 120.0, 31, "1-30"),
            (4, d(2024, 1, 1), d(2025, 1, 1), 0.0, 5.0, -3, "61-90"),
        ],
        "id int, start date, end date, original double, balance double, days int, bucket string",
    )
    assert ids(R.date_order(df, "start", "end")) == [1]
    assert ids(R.ratio_bound(df, "balance", "original", 1.2)) == [2, 4]
    assert ids(R.bucket_mismatch(df, "days", "bucket", DPD_EDGES)) == [3, 4]


def test_orphans(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "x"), (4, "a", "y")], "id int, customer string, branch string")
    ref = spark.createDataFrame([("a", "x"), ("a", "x"), ("c", "y")], "cid string, bid string")
    assert ids(R.orphan_fk(df, ref, {"customer": "cid"})) == [2, 3]
    assert ids(R.orphan_fk(df, ref, {"customer": "cid", "branch": "bid"})) == [2, 3, 4]
    assert R.orphan_count(df, ref, {"customer": "cid"}).first()["n"] == 2
    assert R.orphan_count(df, ref, {"customer": "cid", "branch": "bid"}).first()["n"] == 3
    assert R.orphan_count(df.limit(0), ref, {"customer": "cid"}).first()["n"] == 0


def test_zero_with_activity(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, 0.0, 0.0), (3, 9.0, 5.0)], "id int, total double, moved double")
    assert ids(R.zero_with_activity(df, "total", F.col("moved") > 0)) == [1]
    active = spark.createDataFrame([(2,), (2,), (3,)], "id int")
    assert ids(R.zero_with_activity(df, "total", active, ["id"])) == [2]


def test_report(spark):
    df = spark.createDataFrame([(1, -1.0), (1, 5.0), (2, None)], "id int, amount double")
    report = R.dq_report(
        [
            R.TableChecks("t", df, {"negative": R.negative_when("amount"), "missing": R.missing_when(df, "amount")},
                          {"duplicate": R.surplus_rows(df, ["id"])}),
            R.TableChecks("u", df, {"negative": R.negative_when("amount")}),
        ],
        total="all",
    )
    assert rows(report) == [
        ("all", "all", 4), ("t", "duplicate", 1), ("t", "missing", 1), ("t", "negative", 1), ("u", "negative", 1)
    ]
