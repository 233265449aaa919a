"""The bank report finds exactly the planted defects."""

import datetime as dt

from pyspark.sql import functions as F

from orebed.plans import quality as Q


def some(start, count):
    """A condition for ``count`` consecutive ids."""
    return F.col("id").between(start, start + count - 1)


def bank(spark):
    segment = F.when(F.col("id") < 1200, "Retail").otherwise("PYME")
    customers = spark.range(2400).select(
        # Five ids are overwritten by the id before them.
        F.when(some(50, 1) | some(150, 1) | some(250, 1) | some(350, 1) | some(450, 1), F.col("id") - 1)
        .otherwise(F.col("id")).cast("string").alias("customer_id"),
        F.when(~some(0, 10), "GY").alias("country_code"),
        F.when(some(20, 6), dt.date(2027, 3, 15)).otherwise(dt.date(2024, 1, 1)).alias("acquisition_date"),
        F.when(some(100, 15), F.lower(segment)).otherwise(segment).alias("segment"),
        F.when(some(200, 9), 150).when(some(209, 9), 950).otherwise(700).cast("bigint").alias("credit_score"),
    )
    branches = spark.range(136).select(
        F.when(F.col("id").isin(7, 9, 11), F.col("id") - 1).otherwise(F.col("id")).cast("string").alias("branch_id"),
        F.when(~some(0, 8), "PI").alias("country_code"),
        F.when(some(30, 10), "agencia").otherwise("Agencia").alias("branch_type"),
    )
    transactions = spark.range(5000).select(
        F.when(some(0, 60), F.lit("none")).otherwise("1").alias("customer_id"),
        F.when(F.col("id") == 0, "7").otherwise("1").alias("branch_id"),
        F.when(~some(100, 30), dt.date(2025, 1, 1)).alias("transaction_date"),
        F.when(some(200, 150), 0.0).when(some(400, 25), -5.0).when(some(500, 1), -0.0).otherwise(9.0).alias("amount"),
        F.when(some(500, 1), "Rechazada").otherwise("Aprobada").alias("status"),
    )
    loans = spark.range(1000).select(
        F.when(some(0, 8), -3).otherwise(0).cast("bigint").alias("days_past_due"),
        F.when(some(100, 12), "1-30").otherwise("Al_Dia").alias("dpd_bucket"),
        F.lit(dt.date(2024, 1, 1)).alias("disbursement_date"),
        F.when(some(200, 4), dt.date(2023, 7, 5)).otherwise(dt.date(2026, 1, 1)).alias("maturity_date"),
        F.lit(100.0).alias("original_amount"),
        F.when(some(300, 10), 125.0).otherwise(120.0).alias("outstanding_balance"),
        F.when(some(400, 3), float("nan")).when(~some(403, 2), 0.2).alias("interest_rate"),
    )
    kpis = spark.range(800).select(
        F.when(some(0, 8), 1.7).otherwise(0.04).alias("npl_ratio"),
        F.when(some(100, 5), 0.0).otherwise(5.0).alias("total_portfolio"),
        F.lit(1.0).alias("new_disbursements"),
        F.when(some(200, 3), 999.99).when(~some(300, 100), 0.04).alias("yoy_portfolio_growth"),
        F.when(some(400, 6), "DESCONOCIDO").otherwise("LO").alias("country_code"),
    )
    return dict(zip((Q.CUSTOMERS, Q.BRANCHES, Q.TRANSACTIONS, Q.LOANS, Q.KPIS), (customers, branches, transactions, loans, kpis)))


EXPECTED = {
    "customers": {"missing_region": 10, "future_acquisition": 6, "duplicate_id": 5, "segment_case": 15, "score_range": 18},
    "branches": {"missing_region": 8, "duplicate_id": 3, "type_case": 10},
    "transactions": {"zero_approved": 150, "missing_date": 30, "orphan_customer": 60, "negative_amount": 25, "orphan_branch": 1},
    "loans": {"negative_days": 8, "ends_before_start": 4, "balance_above_original": 10, "missing_rate": 5, "bucket_mismatch": 12},
    "kpis": {"ratio_above_one": 8, "zero_with_disbursements": 5, "growth_sentinel": 3, "unknown_region": 6},
}


def test_bank_report(spark):
    found = {}
    for table, rule, number in Q.bank_report(bank(spark), dt.date(2026, 4, 30)).collect():
        found.setdefault(table, {})[rule] = number
    total = found.pop("all")
    assert found == EXPECTED
    assert total == {"all": sum(sum(part.values()) for part in EXPECTED.values())} == {"all": 402}


def test_no_total(spark):
    report = Q.bank_report(bank(spark), dt.date(2026, 4, 30), total=None)
    assert report.count() == sum(len(part) for part in EXPECTED.values())


def test_unknown_code_of_an_empty_domain(spark):
    from orebed.operators.rules import unknown_code

    df = spark.createDataFrame([("a",), (None,)], "code string")
    assert [r.code for r in unknown_code(df, "code", []).collect()] == ["a"]
    assert [r.code for r in unknown_code(df, "code", spark.createDataFrame([], "c string")).collect()] == ["a"]


def test_group_stats_keeps_whole_numbers(spark):
    from orebed.operators.alerts import group_stats

    keys = [9007199254740993, 9007199254740992, None]
    df = spark.createDataFrame([(key, None) for key in keys], "k bigint, v double")
    found = sorted((r.k or 0, r.n, r.total_value, r.mean_value) for r in group_stats(df, ["k"], "v").collect())
    assert found == [(0, 1, None, None), (9007199254740992, 1, None, None), (9007199254740993, 1, None, None)]
