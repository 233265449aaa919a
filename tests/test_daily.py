"""Daily counts kept by differences."""

import datetime as dt
import random

import pytest

from orebed.operators.aggregates import daily_counts
from orebed.plans import orders, views
from orebed.streaming import daily
from orebed.streaming.logtable import manifest_of
from tests.conftest import rows
from tests.test_logtable import files_below, slices
from tests.test_sources import order, put

SCHEMA = "customer string, at timestamp"


def counts(df):
    return rows(daily_counts(df, "at", "customer"))


@pytest.mark.parametrize("seed", range(2))
def test_any_slicing_gives_the_same_counts(spark, folder, seed):
    rng = random.Random(seed)
    customers = [None, "hot", "hot", "hot", *[f"c{i}" for i in range(30)]]
    start = dt.datetime(2025, 1, 1)
    data = [(rng.choice(customers), rng.choice([None, *[start + dt.timedelta(hours=rng.randrange(240))] * 9])) for _ in range(400)]
    for number, part in enumerate(slices(rng, data, 5)):
        for _ in range(2 if number == 2 else 1):  # a retried batch changes nothing
            batch = spark.createDataFrame(part, SCHEMA)
            daily._apply_batch(batch, number, folder, "at", "customer", buckets=2, bucket_rows=40, folder_rows=10)
    assert rows(daily.read_daily_counts(spark, folder)) == counts(spark.createDataFrame(data, SCHEMA))
    assert manifest_of(spark, f"{folder}/pairs", 4).buckets > 2


def test_a_batch_that_ended_between_the_logs_is_redone(spark, folder, monkeypatch):
    first = spark.createDataFrame([("a", dt.datetime(2025, 1, 1)), ("b", dt.datetime(2025, 1, 1))], SCHEMA)
    second = spark.createDataFrame([("a", dt.datetime(2025, 1, 1)), ("c", dt.datetime(2025, 1, 1)), (None, dt.datetime(2025, 1, 2))], SCHEMA)
    daily._apply_batch(first, 0, folder, "at", "customer")
    plain, done = daily.commit, []

    def ends(news, batch_id, root, layout, base):
        if done:
            raise OSError("gone")
        done.append(root)
        plain(news, batch_id, root, layout, base)

    with monkeypatch.context() as patch:
        patch.setattr(daily, "commit", ends)
        with pytest.raises(OSError):
            daily._apply_batch(second, 1, folder, "at", "customer")
    assert rows(daily.read_daily_counts(spark, folder)) == counts(first)
    daily._apply_batch(second, 1, folder, "at", "customer")
    assert rows(daily.read_daily_counts(spark, folder)) == counts(first.union(second))


def test_a_late_order_reads_and_writes_little(spark, folder):
    start = dt.datetime(2025, 1, 1)
    many = [(f"c{i % 50}", start + dt.timedelta(days=i % 40)) for i in range(2000)]
    daily._apply_batch(spark.createDataFrame(many, SCHEMA), 0, folder, "at", "customer", buckets=8, folder_rows=1)
    late = spark.createDataFrame([("new", start + dt.timedelta(days=3, hours=5))], SCHEMA)
    daily._apply_batch(late, 1, folder, "at", "customer", buckets=8, folder_rows=1)
    for place in ("pairs", "days"):
        assert spark.read.parquet(f"{folder}/{place}/data/v1").count() == 1
        assert len(files_below(f"{folder}/{place}/data/v1")) == 1
    assert rows(daily.read_daily_counts(spark, folder)) == counts(spark.createDataFrame(many, SCHEMA).union(late))


def test_orders_job_by_differences(spark, folder):
    for run in range(3):
        put(f"{folder}/landing/orders", f"{run:02d}.json", [
            order(run * 100 + i, order_timestamp=f"2025-01-{(i * 7 + run) % 20 + 1:02d}T0{i % 9}:00:00", customer_id=f"C{i % 11}")
            for i in range(60)
        ])
        layers = orders.run(spark, f"{folder}/landing", folder, by_differences=True).layers
    clean = spark.read.parquet(layers.table("silver", orders.CLEAN))
    assert rows(orders.read_daily(spark, layers)) == rows(orders.daily_of(clean))
    again = orders.run(spark, f"{folder}/landing", folder, by_differences=True)
    assert again.steps[orders.DAILY].rows_read == 0
    assert orders.DAILY in views.register(spark, layers)
