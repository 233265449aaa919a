import math

import pytest
from pyspark.sql import functions as F

from orebed.operators import governance as G
from orebed.operators import rules, scoring
from tests.conftest import rows


def test_row_filter_and_masks(spark):
    df = spark.createDataFrame([("Ana María", "N", 10.0), ("Jo", "S", 20.0), (None, None, 30.0)], "name string, region string, balance double")
    assert rows(G.row_filter(df, "region", ["N"])) == [("Ana María", "N", 10.0)]
    masks = {"name": G.partly_hidden("name"), "balance": G.hidden_unless("balance", F.col("region") == "N")}
    assert rows(G.mask_columns(df, masks)) == [("Ana******", "N", 10.0), ("Jo", "S", None), (None, None, None)]
    assert rows(G.mask_columns(df, masks, cleared=True)) == rows(df)


def test_policies_are_data(spark, folder):
    """One frame for everybody; rights follow the tables of roles and policies."""
    df = spark.createDataFrame([(1, "N", 10.0), (2, "S", 20.0), (3, None, 30.0)], "id int, region string, balance double")
    policy = "table_name string, role string, kind string, column_name string, value string"
    policies = spark.createDataFrame([
        ("loans", "north", "rows", "region", "N"), ("loans", "south", "rows", "region", "S"), ("loans", "south", "rows", "region", "S"),
        ("loans", "risk", "plain", "balance", None), ("other", "north", "plain", "balance", None),
    ], policy)
    pairs = [("ana", "north"), ("ben", "south"), ("ben", "risk"), ("eva", "north"), ("eva", "south"), ("eva", "risk"), ("eva", "risk")]
    masks = {"balance": F.lit(None)}

    def seen(user, granted=pairs):
        members = spark.createDataFrame(granted, "user_name string, role string")
        return rows(G.governed(df, "loans", policies, members, "region", masks, user and F.lit(user)))

    assert seen("ana") == [(1, "N", None)] and seen("ben") == [(2, "S", 20.0)]
    assert seen("eva") == [(1, "N", 10.0), (2, "S", 20.0)] and seen("nobody") == []
    me = spark.sql("SELECT current_user()").first()[0]
    assert seen(None) == [] and seen(None, [*pairs, (me, "north")]) == [(1, "N", None)]
    spark.createDataFrame([(me, "south")], "user_name string, role string").write.parquet(f"{folder}/members")
    members = spark.read.schema("user_name string, role string").parquet(f"{folder}/members")
    G.governed(df, "loans", policies, members, "region", masks).createOrReplaceTempView("my_loans")
    assert rows(spark.sql("SELECT * FROM my_loans")) == [(2, "S", None)]


def test_audit_trail(spark, folder):
    df = spark.createDataFrame([(-1.0,), (2.0,)], "amount double")
    report = rules.dq_report([rules.TableChecks("t", df, {"negative": rules.negative_when("amount")})])
    for run in ("r1", "r2"):
        G.audit_append(f"{folder}/audit", run, report, {"t": G.schema_hash(df)})
    found = spark.read.parquet(f"{folder}/audit")
    assert rows(found.select("run_id", "table_name", "rule", "n_violations")) == [("r1", "t", "negative", 1), ("r2", "t", "negative", 1)]
    assert found.filter("logged_at IS NULL OR length(schema_hash) <> 64").count() == 0
    assert G.schema_hash(df) != G.schema_hash(df.withColumn("x", F.lit(1)))


def test_score_learns_the_risk(spark):
    data = [(i, float(i % 20), float((i * 7) % 13), 1.0 if (i % 20) + (i % 3) > 11 else 0.0) for i in range(600)]
    df = spark.createDataFrame(data, "id int, dpd double, other double, late double")
    card = scoring.train_score(df, ["dpd", "other"], "late")
    scored = scoring.credit_score(card, df)
    late = scored.filter("late = 1").agg(F.min("score")).first()[0]
    good = scored.filter("late = 0 AND dpd < 8").agg(F.max("score")).first()[0]
    assert late > good
    row = scored.first()
    margin = card.intercept + card.weights["dpd"] * row["dpd"] + card.weights["other"] * row["other"]
    assert row["score"] == pytest.approx(1 / (1 + math.exp(-margin)))
    missing = spark.createDataFrame([(None, 1.0)], "dpd double, other double")
    assert scoring.credit_score(card, missing).first()["score"] is None


def test_risk_features(spark):
    loans = spark.createDataFrame([("a", 10.0, 100), ("a", 20.0, 0), ("b", 5.0, 0)], "customer string, amount double, days int")
    out = scoring.risk_features(loans, "customer", "amount", F.col("days") > 90)
    assert rows(out) == [("a", 2, 20.0, 1), ("b", 1, 5.0, 0)]
