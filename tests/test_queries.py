"""All registered queries against their reference SQL, and checks of their plans."""

import os
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from orebed.plans.oracle import statements
from orebed.plans.queries import REGISTRY

TABLES = "region nation customer supplier part orders lineitem events".split()
# Results that come from a fitted model.
WITHOUT_SQL = {"m5_credit_score"}
# Queries that write first and read back what they wrote.
WRITERS = {name for name in REGISTRY if name[0] in "l"} | {
    "s1_ingest_incremental", "s6_csv_export", "s7_jsonl_export", "s9_ensure_table", "c2_scd1_incremental",
    "g3_audit_log", "s12_status_feed", "j6_stream_stream", "j6_stream_late", "c4_keyed_log", "c5_scd2_incremental",
    "a1_daily_incremental", "m5_credit_score", "s1_schema_log", "s1_schema_versions",
}
LIBRARY = Path(__file__).parent.parent / "orebed"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def test_every_query_has_sql():
    assert set(REGISTRY) - set(statements()) == WITHOUT_SQL
    assert set(statements()) <= set(REGISTRY)
    assert REGISTRY.items() <= registered.queries().items()
    assert statements().items() <= registered.oracle_sql().items()


# No broadcast by size, and a few rows make a key hot.
AS_IF_LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.orebed.hotRows": "20",
}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WITHOUT_SQL))
def test_query_matches_sql(spark, sf_dir, duck, name):
    compare(REGISTRY[name](spark, sf_dir), duck, name)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WITHOUT_SQL - WRITERS))
def test_large_scale_way_matches_sql(spark, sf_dir, duck, name):
    for key, value in AS_IF_LARGE.items():
        spark.conf.set(key, value)
    try:
        df = REGISTRY[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        compare(df, duck, name)
    finally:
        for key in AS_IF_LARGE:
            spark.conf.unset(key)


def compare(df, duck, name):
    columns = sorted(df.columns)
    found = sorted(tuple(plain(row[column]) for column in columns) for row in df.collect())
    answer = duck.execute(statements()[name])
    names = [part[0] for part in answer.description]
    assert sorted(names) == columns
    places = [names.index(column) for column in columns]
    expected = sorted(tuple(plain(row[place]) for place in places) for row in answer.fetchall())
    assert found == expected


def test_score_covers_all_customers(spark, sf_dir):
    scored = REGISTRY["m5_credit_score"](spark, sf_dir)
    assert scored.count() == REGISTRY["m4_risk_features"](spark, sf_dir).count()
    assert scored.filter("score NOT BETWEEN 0 AND 1").count() == 0


def test_sort_is_in_order(spark, sf_dir):
    found = [tuple(row) for row in REGISTRY["o1_sort"](spark, sf_dir).collect()]
    assert found == sorted(found, key=lambda row: (row[1], row[0]))


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITERS))
def test_plans(spark, sf_dir, name):
    plan = REGISTRY[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in plan


@pytest.mark.parametrize(
    "name, pushed, columns",
    [
        ("p4_filter_eq", "EqualTo(o_orderstatus,P)", "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double"),
        ("d2_expect_drop", None, "o_orderkey:bigint,o_totalprice:double"),
        ("q02_future_date", "GreaterThan(o_orderdate", "o_orderkey:bigint,o_orderdate:timestamp_ntz"),
        ("q08_negative", "LessThan(s_acctbal,0.0)", "s_suppkey:bigint,s_acctbal:double"),
        ("q12_sentinel", "In(p_retailprice", "p_partkey:bigint,p_retailprice:double"),
        ("a1_daily_orders", None, "o_custkey:bigint,o_orderdate:timestamp_ntz"),
    ],
)
def test_scans_are_narrow(spark, sf_dir, name, pushed, columns):
    plan = REGISTRY[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: struct<{columns}>" in plan
    assert pushed is None or pushed in plan


def test_library_keeps_data_on_executors():
    """No frame is turned to pandas; collects are of bounded lists only, by name."""
    allowed = {
        ("operators/skew.py", ".collect("): 1,  # code domains, limited
        ("streaming/logtable.py", ".collect("): 2,  # bucket numbers and rows per bucket
    }
    found = {}
    for path in LIBRARY.rglob("*.py"):
        if path.is_relative_to(LIBRARY / "llm"):
            continue  # has its own tests
        text = path.read_text()
        for call in (".collect(", ".toPandas(", ".coalesce(", "localCheckpoint", ".toLocalIterator(", "crossJoin", ".rdd"):
            count = len(re.findall(re.escape(call), text)) - len(re.findall(r"F" + re.escape(call), text))
            if count:
                found[(str(path.relative_to(LIBRARY)), call)] = count
    assert found == allowed
