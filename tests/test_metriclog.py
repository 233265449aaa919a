import pytest
from pyspark.sql import functions as F

from orebed import paths
from orebed.operators.expectations import Expectation, apply_expectations
from orebed.sources.files import read_stream_table
from orebed.streaming import metriclog
from orebed.streaming.metriclog import MetricLog, metrics_folder, read_metrics, run_counted
from orebed.streaming.run import run_available

RULES = [Expectation("small", "n < 8", "drop"), Expectation("even", "n % 2 = 0")]


@pytest.fixture
def feed(spark, folder):
    def land(low, high):
        spark.range(low, high, 1, 1).select(F.col("id").alias("n")).write.mode("append").parquet(f"{folder}/feed")

    return land, lambda: read_stream_table(spark, f"{folder}/feed", spark.range(0).select(F.col("id").alias("n")).schema, 1)


def values(spark, checkpoint):
    return {(row.batch, row.metric): row.value for row in read_metrics(spark, checkpoint).collect()}


def test_file_sink(spark, folder, feed):
    land, stream = feed
    checkpoint = f"{folder}/checkpoint"
    for low, high in ((0, 4), (4, 10)):
        land(low, high)
    report = run_available(apply_expectations(stream(), RULES, "numbers"), f"{folder}/kept", checkpoint)
    assert (report.rows_read, report.batches, report.rows_added) == (10, 2, 8)
    assert report.observed == {"numbers": {"rows": 10, "rows_kept": 8, "failed_small": 2, "failed_even": 5}}
    land(10, 11)
    report = run_available(apply_expectations(stream(), RULES, "numbers"), f"{folder}/kept", checkpoint)
    assert (report.rows_read, report.batches, report.rows_added) == (1, 1, 0)
    report = run_available(apply_expectations(stream(), RULES, "numbers"), f"{folder}/kept", checkpoint)
    assert (report.rows_read, report.batches, report.observed) == (0, 0, {})
    found = values(spark, checkpoint)
    assert {batch for batch, _ in found} == {0, 1, 2}
    assert found[2, "failed_small"] == 1 and found[0, "rows_read"] + found[1, "rows_read"] == 10


def test_totals_do_not_need_the_old_entries(spark, folder):
    """Only the last entry is read, so their number does not matter; Spark keeps the progress of 100,000 batches."""
    log = MetricLog(spark, folder)
    log.put(0, 5, {"a": {"rows": 5, "failed": 1}})
    log._last = {**log._last, "batch": 99_999, "all_batches": 100_000}
    log.put(100_000, 2, {"a": {"rows": 2, "failed": 2}, "b": {"rows": 2}})
    again = MetricLog(spark, folder)
    assert again.last_batch == 100_000
    assert again.totals == {"rows": 7, "batches": 100_001, "counts": {"a": {"rows": 7, "failed": 3}, "b": {"rows": 2}}}


def test_a_batch_again_replaces_its_entry(spark, folder):
    log = MetricLog(spark, folder)
    for batch in range(3):
        log.put(batch, batch + 1, {"a": {"rows": batch + 1}})
    log.put(2, 10, {"a": {"rows": 10}})
    MetricLog(spark, folder).put(2, 20, {"a": {"rows": 20}})
    assert MetricLog(spark, folder).totals == {"rows": 23, "batches": 3, "counts": {"a": {"rows": 23}}}
    with pytest.raises(ValueError, match="batch 1 comes after batch 2"):
        log.put(1, 1, {})


def test_a_retried_batch_counts_once(spark, folder, feed):
    land, stream = feed
    checkpoint = f"{folder}/checkpoint"
    land(0, 4)
    land(4, 10)
    tries = []

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/kept/b{number}")
        batch.count()  # a second look must not count twice
        tries.append(number)

    def dies_late(batch, number):
        write(batch, number)
        if number == 1:
            raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        run_counted(stream(), RULES, dies_late, checkpoint)
    assert run_counted(stream(), RULES, write, checkpoint)["batches"] == 1
    assert tries == [0, 1, 1]
    totals = MetricLog(spark, metrics_folder(checkpoint)).totals
    assert totals == {
        "rows": 10,
        "batches": 2,
        "counts": {"expectations": {"rows": 10, "rows_kept": 8, "failed_small": 2, "failed_even": 5}},
    }
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/kept").count() == 8


def test_entry_written_but_batch_not_committed(spark, folder, feed, monkeypatch):
    land, stream = feed
    checkpoint = f"{folder}/checkpoint"
    land(0, 10)
    put = MetricLog.put

    def dies(self, *parts):
        put(self, *parts)
        raise OSError("lost")

    monkeypatch.setattr(metriclog.MetricLog, "put", dies)
    with pytest.raises(Exception, match="lost"):
        run_counted(stream(), RULES, lambda batch, _: batch.count(), checkpoint)
    monkeypatch.setattr(metriclog.MetricLog, "put", put)
    run_counted(stream(), RULES, lambda batch, _: batch.count(), checkpoint)
    assert MetricLog(spark, metrics_folder(checkpoint)).totals["rows"] == 10


def test_a_log_that_cannot_be_written_is_an_error(spark, folder, feed, monkeypatch):
    land, stream = feed
    land(0, 3)

    def dies(*_):
        raise OSError("no space")

    monkeypatch.setattr(paths, "write_text", dies)
    with pytest.raises(OSError, match="no space"):
        run_available(stream(), f"{folder}/kept", f"{folder}/checkpoint")


def test_empty_log(spark, folder):
    assert read_metrics(spark, f"{folder}/none").count() == 0
