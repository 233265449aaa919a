import datetime as dt
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orebed import paths
from orebed.plans import customers, orders, status, transactions, verify, views
from orebed.plans.layers import ResetNotAllowed
from orebed.sources.files import read_stream_table
from orebed.streaming.interval_join import interval_stream_join
from orebed.streaming.run import run_available
from orebed.streaming.snapshot import read_state
from tests.conftest import rows
from tests.test_sources import order, put


def test_orders_job(spark, folder):
    landing = f"{folder}/landing"
    put(f"{landing}/orders", "00.json", [
        order(i, order_timestamp=f"2025-{i % 12 + 1:02d}-03T{i % 24:02d}:00:00", customer_id=f"CUST{i % 7:04d}")
        for i in range(174)
    ])
    first = orders.run(spark, landing, folder)
    assert first.steps[orders.RAW].rows_added == 174
    assert first.steps[orders.CLEAN].rows_added == 174
    counts = first.steps[orders.CLEAN].observed[orders.CLEAN]
    assert [counts[f"failed_{rule.name}"] for rule in orders.ORDER_RULES] == [0, 0, 0]
    daily = orders.read_daily(spark, first.layers)
    assert daily.count() == 12 and daily.agg(F.sum("total_daily_orders")).first()[0] == 174

    again = orders.run(spark, landing, folder)
    assert (again.steps[orders.RAW].rows_added, again.steps[orders.CLEAN].rows_added) == (0, 0)

    put(f"{landing}/orders", "01.json", [order(2000 + i, order_timestamp="2019-01-01T00:00:00", customer_id=None) for i in range(25)])
    third = orders.run(spark, landing, folder)
    assert (third.steps[orders.RAW].rows_added, third.steps[orders.CLEAN].rows_added) == (25, 25)
    counts = third.steps[orders.CLEAN].observed[orders.CLEAN]
    assert (counts["failed_valid_customer_id"], counts["failed_valid_timestamp"]) == (25, 25)
    daily = orders.read_daily(spark, third.layers)
    assert daily.filter("order_date = '2019-01-01'").first()[1:] == (25, 0)
    note = json.loads(paths.read_text(spark, f"{third.layers.notes}/{orders.RAW}.json"))
    assert note["properties"]["reset.allowed"] == "false"


def test_failed_rule_commits_nothing(spark, folder):
    put(f"{folder}/orders", "00.json", [order(1), {"customer_id": "x", "order_timestamp": "2025-01-01T00:00:00"}])
    layers_run = None
    with pytest.raises(StreamingQueryException, match="valid_order_id"):
        layers_run = orders.run(spark, folder, folder)
    assert layers_run is None
    silver = f"{folder}/medallion/orders/g0/silver/{orders.CLEAN}"
    assert not os.path.isdir(silver) or not [n for n in os.listdir(silver) if n.startswith("part-")]


def test_unknown_fields_stay_in_the_raw_tables(spark, folder):
    put(f"{folder}/orders", "00.json", [order(1, coupon="X1"), order(2, notifications={"email": "often", "sms": True})])
    put(f"{folder}/status", "00.json", [{"order_id": "a", "order_status": "placed", "status_timestamp": "today", "by": "me"}])
    layers = orders.run(spark, folder, folder).layers
    raw = spark.read.parquet(layers.table("bronze", orders.RAW))
    assert rows(raw.select("order_id", "_rescued_data")) == [
        ("ORD00001", '{"coupon":"X1"}'),
        ("ORD00002", '{"notifications":"{\\"email\\":\\"often\\",\\"sms\\":true}"}'),
    ]
    clean = spark.read.parquet(layers.table("silver", orders.CLEAN))
    assert clean.columns == ["order_id", "order_timestamp", "customer_id", "notifications"] and clean.count() == 2
    layers = status.run(spark, folder, folder).layers
    raw = spark.read.parquet(layers.table("bronze", status.RAW))
    assert raw.first()["_rescued_data"] == '{"status_timestamp":"today","by":"me"}'


def test_strict_and_lenient_time(spark, folder):
    put(f"{folder}/orders", "00.json", [order(1), order(2, order_timestamp="soon")])
    with pytest.raises(StreamingQueryException):
        orders.run(spark, folder, f"{folder}/strict")
    report = orders.run(spark, folder, f"{folder}/lenient", mode="lenient")
    assert report.steps[orders.CLEAN].observed[orders.CLEAN]["failed_valid_timestamp"] == 1


def test_validate_reads_no_data(spark, folder):
    put(f"{folder}/orders", "00.json", ["broken"])
    put(f"{folder}/customers", "00.json", ["broken"])
    found = orders.run(spark, folder, folder, validate=True).schemas
    assert found[orders.DAILY] == "struct<order_date:date,total_daily_orders:bigint,unique_customers:bigint>"
    found = customers.run(spark, folder, folder, validate=True).schemas
    assert found[customers.CURRENT] == (
        "struct<customer_id:string,name:string,email:string,address:string,city:string,state:string,"
        "zip_code:string,timestamp_datetime:timestamp>"
    )
    assert not os.path.exists(f"{folder}/medallion/orders/g0") and not os.path.exists(f"{folder}/medallion/customers/g0")


def test_full_refresh_guard(spark, folder):
    put(f"{folder}/landing/orders", "00.json", [order(i) for i in range(3)])
    orders.run(spark, f"{folder}/landing", folder)
    with pytest.raises(ResetNotAllowed):
        orders.run(spark, f"{folder}/landing", folder, full_refresh=True)
    fresh = orders.run(spark, f"{folder}/landing", folder, full_refresh=True, allow_reset=True)
    assert fresh.steps[orders.RAW].rows_added == 3
    assert fresh.layers.base.endswith("/g1") and os.path.isdir(f"{folder}/medallion/orders/g0")
    assert orders.run(spark, f"{folder}/landing", folder).steps[orders.RAW].rows_added == 0


def customer_feed():
    """24 inserts, 5 updates, 2 deletes."""
    base = 1735689600.0
    events = []
    for j in range(24):
        events.append({
            "customer_id": f"C{j:02d}", "name": f"Name {j}", "email": f"user{j:04d}@shop.example.com",
            "address": f"Street {j}", "city": "Loja", "state": "LO", "zip_code": f"{10000 + j}",
            "operation": "INSERT", "timestamp": base + (j + 1) * 1000,
        })
    for u, j in enumerate([0, 4, 8, 12, 16]):
        events.append({**events[j], "email": f"new{u}@shop.example.com", "city": "Quito", "state": "PI",
                       "operation": "UPDATE", "timestamp": base + 40_000 + u * 200})
    for d, j in enumerate([2, 10]):
        events.append({"customer_id": f"C{j:02d}", "operation": "DELETE", "timestamp": base + 70_000 + d * 150})
    return sorted(events, key=lambda event: event["timestamp"])


def test_customers_job(spark, folder):
    put(f"{folder}/landing/customers", "00.json", customer_feed())
    report = customers.run(spark, f"{folder}/landing", folder)
    assert [report.steps[name].rows_added for name in (customers.RAW, customers.CLEAN)] == [31, 31]
    current = customers.read_customers(spark, report.layers)
    assert current.columns == ["customer_id", "name", "email", "address", "city", "state", "zip_code", "timestamp_datetime"]
    assert current.count() == 22
    assert current.filter("city = 'Quito' AND state = 'PI'").count() == 5
    assert current.filter("customer_id IN ('C02', 'C10')").count() == 0
    summary = spark.read.parquet(report.layers.table("gold", customers.SUMMARY))
    assert summary.columns == ["customer_id", "name", "state", "city", "last_refreshed"] and summary.count() == 22

    late = {**customer_feed()[2], "operation": "UPDATE", "timestamp": 1735689600.0 + 50_000}
    odd = {**customer_feed()[0], "customer_id": "C99", "phone": "1", "email": "no address"}
    put(f"{folder}/landing/customers", "01.json", [late, odd, {**odd, "customer_id": "C98", "email": "a@b.com"}])
    report = customers.run(spark, f"{folder}/landing", folder)
    assert [report.steps[name].rows_added for name in (customers.RAW, customers.CLEAN)] == [3, 2]
    names = {row["customer_id"] for row in customers.read_customers(spark, report.layers).collect()}
    assert len(names) == 23 and "C98" in names and "C99" not in names and "C02" not in names
    state = read_state(spark, report.layers.table("gold", customers.CURRENT))
    assert state.filter("_deleted").count() == 2
    assert state.filter("customer_id = 'C98'").first()["_rescued_data"] == '{"phone":"1"}'


def test_many_small_batches_give_the_same_customers(spark, folder):
    events = customer_feed()
    for number in range(8):
        put(f"{folder}/landing/customers", f"{number:02d}.json", events[7 - number :: 8])
    whole = customers.run(spark, f"{folder}/landing", f"{folder}/whole")
    steps = customers.run(spark, f"{folder}/landing", f"{folder}/parts", max_files=3, buckets=3)
    assert steps.steps[customers.RAW].batches == 3 and steps.steps[customers.RAW].rows_added == 31
    assert steps.steps[customers.CLEAN].rows_added == 31
    assert rows(customers.read_customers(spark, steps.layers)) == rows(customers.read_customers(spark, whole.layers))


def test_transactions_job(spark, folder):
    day = dt.date(2025, 1, 5)
    data = [
        ("T1", "a", "B", day, 10.0, "Pago", "App", "P", "USD", "Aprobada"),
        ("T2", "a", "B", day, 0.0, "Pago", "Web", "P", "USD", "Aprobada"),
        ("T3", "a", "B", day, 5.0, "Pago", "Web", "P", "USD", "Aprobada"),
        ("T4", "a", "B", None, 5.0, "Pago", "Web", "P", "USD", "Aprobada"),
        ("T5", None, "B", day, 5.0, "Pago", "Web", "P", "USD", "Aprobada"),
        ("T6", "b", "B", dt.date(2025, 2, 1), -3.0, "Pago", "ATM", "P", "USD", "Aprobada"),
    ]
    spark.createDataFrame(data, transactions.TRANSACTION_SCHEMA).write.option("header", True).csv(f"{folder}/csv")
    for _ in range(2):
        report = transactions.run(spark, f"{folder}/csv", folder)
        step = report.steps[transactions.CLEAN]
        assert (step.rows_read, step.rows_added) == (6, 4)
        assert step.observed[transactions.CLEAN]["failed_valid_amount"] == 2
    monthly = transactions.read_table(spark, report.layers, transactions.MONTHLY)
    assert monthly.schema.simpleString() == transactions.MONTHLY_SCHEMA.simpleString()
    assert rows(monthly) == [("a", "2025-01", 3, 15.0, 5.0, "Web"), ("b", "2025-02", 1, -3.0, -3.0, "ATM")]
    assert transactions.MONTHLY in transactions.run(spark, f"{folder}/csv", folder, validate=True).schemas
    assert set(views.register(spark, report.layers)) == {transactions.RAW, transactions.CLEAN, transactions.MONTHLY}


def test_transactions_change_together(spark, folder, monkeypatch):
    """A failing rule or an end between steps leaves all three tables of the run before."""
    day = dt.date(2025, 1, 5)

    def hand_over(*ids):
        data = [(key, "a", "B", day, 10.0, "Pago", "App", "P", "USD", "Aprobada") for key in ids]
        frame = spark.createDataFrame(data, transactions.TRANSACTION_SCHEMA)
        frame.write.mode("overwrite").option("header", True).csv(f"{folder}/csv")
        return transactions.run(spark, f"{folder}/csv", folder).layers

    def counts(layers):
        tables = [transactions.read_table(spark, layers, name) for name in (transactions.RAW, transactions.CLEAN, transactions.MONTHLY)]
        return [tables[0].count(), tables[1].count(), tables[2].first().total_transactions]

    layers = hand_over("T1", "T2")
    assert counts(layers) == [2, 2, 2]
    early = transactions.read_table(spark, layers, transactions.CLEAN)
    with pytest.raises(Exception, match="valid_id"):
        hand_over("T1", None, "T3")
    assert counts(layers) == [2, 2, 2]
    with monkeypatch.context() as patch:
        patch.setattr(transactions, "monthly", lambda clean: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            hand_over("T1", "T2", "T3")
    assert counts(layers) == [2, 2, 2]
    assert len(paths.list_names(spark, f"{layers.base}/data/{transactions.RAW}")) == 1  # nothing is left behind
    assert counts(hand_over("T1", "T2", "T3")) == [3, 3, 3]
    assert early.count() == 2  # a reader that began before still has its files
    for _ in range(3):
        assert counts(hand_over("T1", "T2", "T3")) == [3, 3, 3]
    assert len(paths.list_names(spark, f"{layers.base}/data/{transactions.RAW}")) == 2


@pytest.mark.parametrize("max_files", [None, 1])
def test_interval_join_against_brute_force(spark, folder, max_files):
    import random

    rng = random.Random(9)
    start = dt.datetime(2025, 1, 1)
    clicks = [("hot" if rng.random() < 0.5 else f"u{rng.randrange(9)}", i, start + dt.timedelta(seconds=rng.randrange(40_000))) for i in range(200)]
    buys = [("hot" if rng.random() < 0.5 else f"u{rng.randrange(9)}", i, start + dt.timedelta(seconds=rng.randrange(40_000))) for i in range(200)]
    buys += [(key, 900 + i, at + dt.timedelta(seconds=gap)) for i, ((key, _, at), gap) in enumerate(zip(clicks, [0, 600, 601, -1]))]
    click_schema, buy_schema = "user string, click int, c_at timestamp", "user string, buy int, b_at timestamp"
    # In four files each, so that pairs may meet in different batches.
    spark.createDataFrame(clicks, click_schema).repartition(4).write.parquet(f"{folder}/c")
    spark.createDataFrame(buys, buy_schema).repartition(4).write.parquet(f"{folder}/b")
    left = read_stream_table(spark, f"{folder}/c", click_schema, max_files)
    right = read_stream_table(spark, f"{folder}/b", buy_schema, max_files)
    pairs = interval_stream_join(left, right, "user", "c_at", "b_at", 600, "1 day")
    run_available(pairs, f"{folder}/out", f"{folder}/cp")
    found = spark.read.parquet(f"{folder}/out")
    expected = sorted(
        (click, buy)
        for user, click, at in clicks
        for other, buy, then in buys
        if user == other and dt.timedelta(0) <= then - at <= dt.timedelta(seconds=600)
    )
    assert rows(found.select("click", "buy")) == sorted(expected, key=repr)
    assert sorted(found.columns) == ["b_at", "buy", "c_at", "click", "user"]


def test_gold_recomputes_only_changed_days(spark, folder, monkeypatch):
    def at(day, hour):
        return f"2025-01-{day:02d}T{hour:02d}:00:00"

    landing = f"{folder}/landing"
    put(f"{landing}/orders", "00.json", [order(i, order_timestamp=at(i % 9 + 1, i % 24)) for i in range(90)])
    layers = orders.run(spark, landing, folder).layers
    assert orders.read_daily(spark, layers).count() == 9
    seen = []
    plain = orders.daily_of

    def watched(rows_of_days):
        seen.append({str(row[0]) for row in rows_of_days.select(F.to_date("order_timestamp")).distinct().collect()})
        return plain(rows_of_days)

    monkeypatch.setattr(orders, "daily_of", watched)
    put(f"{landing}/orders", "01.json", [
        order(500, order_timestamp=at(3, 1)), order(501, order_timestamp=at(7, 23)), order(502, order_timestamp=None)
    ])
    orders.run(spark, landing, folder)
    assert seen == [{"2025-01-03", "2025-01-07", "None"}]
    expected = plain(spark.read.parquet(layers.table("silver", orders.CLEAN)))
    assert rows(orders.read_daily(spark, layers)) == rows(expected)
    orders.run(spark, landing, folder)
    assert len(seen) == 1
    for number in range(2, 5):
        put(f"{landing}/orders", f"{number:02d}.json", [order(600 + number, order_timestamp=at(number, 2))])
        orders.run(spark, landing, folder)
    expected = plain(spark.read.parquet(layers.table("silver", orders.CLEAN)))
    assert rows(orders.read_daily(spark, layers)) == rows(expected)
    assert len(paths.list_names(spark, layers.table("gold", orders.DAILY) + "/data")) == 2


def test_silver_keeps_time_statistics(spark, folder):
    """The daily refresh skips row groups by time, so their bounds must be there."""
    import pyarrow.parquet as pq

    put(f"{folder}/orders", "00.json", [order(i) for i in range(5)])
    silver = orders.run(spark, folder, folder).layers.table("silver", orders.CLEAN)
    part = next(name for name in os.listdir(silver) if name.startswith("part-"))
    group = pq.ParquetFile(f"{silver}/{part}").metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert columns["order_timestamp"].statistics.has_min_max


def test_status_job(spark, folder):
    base = 1735689600.0
    put(f"{folder}/status", "00.json", [
        {"order_id": f"ORD{i % 50:05d}", "order_status": f"s{i}", "status_timestamp": base + i * 3600} for i in range(536)
    ])
    assert status.run(spark, folder, folder).steps[status.RAW].rows_added == 536
    put(f"{folder}/status", "01.json", [
        {"order_id": "ORD00000", "order_status": "late", "status_timestamp": base},
        {"order_id": "ORD00001", "order_status": "newest", "status_timestamp": base + 9e6},
    ])
    status.run(spark, folder, folder)
    latest = {row["order_id"]: row["order_status"] for row in status.read_status(spark, folder).collect()}
    assert len(latest) == 50
    assert (latest["ORD00000"], latest["ORD00001"], latest["ORD00002"]) == ("s500", "newest", "s502")


def test_views_answer_plain_sql(spark, folder):
    put(f"{folder}/orders", "00.json", [order(i, order_timestamp=f"2025-01-{i % 20 + 1:02d}T{i % 24:02d}:00:00") for i in range(174)])
    put(f"{folder}/customers", "00.json", customer_feed())
    assert views.register(spark, orders.run(spark, folder, folder).layers) == [orders.RAW, orders.CLEAN, orders.DAILY]
    layers = customers.run(spark, folder, folder).layers
    assert set(views.register(spark, layers)) == {customers.RAW, customers.CLEAN, customers.CURRENT, customers.SUMMARY}

    assert spark.sql("SELECT * FROM orders_raw LIMIT 10").count() == 10
    latest = spark.sql("SELECT order_id, order_timestamp, customer_id FROM orders_clean ORDER BY order_timestamp DESC LIMIT 10")
    times = [row["order_timestamp"] for row in latest.collect()]
    assert len(times) == 10 and times == sorted(times, reverse=True)
    days = [row["order_date"] for row in spark.sql("SELECT * FROM orders_daily ORDER BY order_date").collect()]
    assert len(days) == 20 and days == sorted(days)
    counts = spark.sql("""
        SELECT 'customers_raw' AS table_name, COUNT(*) AS row_count FROM customer_events_raw
        UNION ALL SELECT 'customers_clean', COUNT(*) FROM customer_events_clean
        UNION ALL SELECT 'customers (current)', COUNT(*) FROM customers""")
    assert rows(counts) == rows(verify.customer_counts(spark, layers)) == [
        ("customers (current)", 22), ("customers_clean", 31), ("customers_raw", 31)
    ]
    gone = spark.sql("""
        SELECT customer_id FROM customer_events_raw WHERE operation = 'DELETE'
        EXCEPT SELECT customer_id FROM customers""")
    assert rows(gone) == rows(verify.deleted_customers(spark, layers)) == [("C02",), ("C10",)]
    moved = spark.sql("SELECT customer_id, name, email, city, state FROM customers WHERE city = 'Quito' ORDER BY customer_id")
    assert [tuple(row) for row in moved.collect()] == [tuple(row) for row in verify.customers_in(spark, layers, "Quito").collect()]
    assert moved.count() == 5


def test_lost_checkpoint_of_the_daily_table(spark, folder):
    """A daily table ahead of its checkpoint is an error, as for the keyed table."""
    from orebed.streaming.snapshot import SnapshotMismatch
    from orebed.streaming.touched import _refresh

    silver = f"{folder}/silver"
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id int, ts timestamp").write.parquet(silver)
    batch = spark.read.parquet(silver)
    count = lambda df: df.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    for number in (0, 1, 1):
        _refresh(batch, number, silver, "ts", "day", count, f"{folder}/daily")
    with pytest.raises(SnapshotMismatch):
        _refresh(batch, 0, silver, "ts", "day", count, f"{folder}/daily")


def test_broken_status_lines_stay_out_of_the_table(spark, folder):
    os.makedirs(f"{folder}/landing/status")
    with open(f"{folder}/landing/status/1.json", "w") as file:
        file.write('{"order_id": "A", "order_status": "open", "status_timestamp": 1.0}\nno json at all\n{"order_status": "x"}\n')
    report = status.run(spark, f"{folder}/landing", folder)
    assert [r.order_id for r in status.read_status(spark, folder).collect()] == ["A"]
    assert report.steps[status.RAW].rows_read == 3
