"""The log-structured table, and the two tables kept in it."""

import os
import random

import pytest
from pyspark.sql import functions as F

from orebed import paths
from orebed.operators.cdc import scd1, scd2
from orebed.plans import customers, queries
from orebed.streaming import history, snapshot
from orebed.streaming.logtable import (
    DEFAULT_FOLDER_ROWS,
    MOST_FOLDERS,
    Layout,
    _folder_count,
    _newest_to_merge,
    address,
    base_for,
    commit,
    manifest_of,
    prune_versions,
    read_table,
    versions,
)
from tests.conftest import rows
from tests.test_cdc import DELETE, EVENTS, EXCEPT, ORDER, feed
from tests.test_jobs import customer_feed
from tests.test_sources import put

SMALL = {"buckets": 2, "bucket_rows": 20, "folder_rows": 4}


def events_of(rng, number, keys=12):
    kinds = ["INSERT", "UPDATE", "UPDATE", "DELETE"]
    return [(f"k{rng.randrange(keys)}", f"n{i}", rng.choice(kinds), rng.randrange(9), float(i % 7)) for i in range(number)]


def slices(rng, events, parts):
    cuts = sorted(rng.sample(range(1, len(events)), parts - 1))
    return [events[a:b] for a, b in zip([0, *cuts], [*cuts, len(events)])]


def files_below(folder):
    return [os.path.join(top, name) for top, _, names in os.walk(folder) for name in names if name.endswith(".parquet")]


def test_a_split_moves_half_of_one_bucket(spark):
    keys = spark.range(3000)
    before = None
    for number in range(1, 40):
        found = dict(keys.select("id", address(["id"], number).alias("b")).collect())
        assert set(found.values()) == set(range(number))
        if before:
            moved = {key for key in found if found[key] != before[key]}
            half = number - 1 - (1 << ((number - 1).bit_length() - 1))
            assert {found[key] for key in moved} == {number - 1} and {before[key] for key in moved} == {half}
        before = found


def test_folder_and_merge_rules():
    assert [_folder_count(n, 10, 24) for n in (0, 9, 10, 25, 100, 239, 240, 9999)] == [1, 1, 1, 2, 8, 16, 24, 24]
    assert _newest_to_merge([100], 1) == 0
    assert _newest_to_merge([100, 30, 10], 1) == 0
    assert _newest_to_merge([100, 30, 20], 1) == 2
    assert _newest_to_merge([100, 40, 21], 1) == 3
    assert _newest_to_merge([3, 2], 10) == 0 and _newest_to_merge([1] * 9, 10) == 9


def test_small_folders_of_a_run_are_bounded():
    for buckets in (450, 2700, 100_000):
        assert _folder_count(90_000, 50, buckets) <= MOST_FOLDERS
    # Folders of the usual size are as many as the rows need.
    assert _folder_count(1000 * DEFAULT_FOLDER_ROWS, DEFAULT_FOLDER_ROWS, 900) == 900


def test_buckets_sharing_bounded_folders(spark, folder, monkeypatch):
    monkeypatch.setattr("orebed.streaming.logtable.MOST_FOLDERS", 4)
    layout = Layout(["k"], ["k"], ["v"], buckets=2, bucket_rows=10, folder_rows=2)
    for number in range(5):
        news = spark.range(0, 300, number + 1).select(F.col("id").alias("k"), F.lit(number).alias("v"))
        commit(news, number, folder, layout, base_for(spark, folder, layout, number))
        prune_versions(spark, folder, keep=1)
    assert len(os.listdir(f"{folder}/data")) and manifest_of(spark, folder, 4).buckets > 8
    for name in paths.list_names(spark, f"{folder}/data"):
        assert len([part for part in os.listdir(f"{folder}/data/{name}") if part.startswith("_bucket=")]) <= 4
    found = dict(read_table(spark, folder).select("k", "v").collect())
    assert found == {k: max(n for n in range(5) if k % (n + 1) == 0) for k in range(300)}


@pytest.mark.parametrize("name", ["c4_keyed_log", "c5_scd2_incremental"])
def test_a_kind_in_several_files_is_one_batch(spark, folder, monkeypatch, name):
    kinds = ["purchase", "click", "error", "view", "signup"]
    events = [(i, i % 7, kinds[i % 5], float(i)) for i in range(100)]
    data = spark.createDataFrame(events, "event_id bigint, user_id bigint, event_type string, value double")
    data = data.select("event_id", F.timestamp_seconds(F.col("event_id") % 50).alias("ts"), "user_id", "event_type", "value", F.lit("").alias("props"))
    data.repartition(6).write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(queries, "fresh_dir", lambda spark, label: f"{folder}/{label}")
    monkeypatch.setattr(queries, "table", lambda spark, sf_dir, table: spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(6))
    assert queries.REGISTRY[name](spark, folder).count() == {"c4_keyed_log": 6, "c5_scd2_incremental": 80}[name]
    state = f"{folder}/{'log' if name == 'c4_keyed_log' else 'history'}/state"
    assert versions(spark, state) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("seed", range(2, 4))
def test_current_state_with_splits_and_merges(spark, folder, seed):
    rng = random.Random(seed)
    events = EVENTS + events_of(rng, 160, keys=90)
    rng.shuffle(events)
    expected = rows(scd1(feed(spark, events), ["id"], ORDER, DELETE, EXCEPT))
    for number, part in enumerate(slices(rng, events, 7)):
        for _ in range(2 if number in (2, 5) else 1):  # a retried batch changes nothing
            snapshot._apply_batch(feed(spark, part), number, folder, ["id"], ORDER, DELETE, **SMALL)
        if number == 4:
            prune_versions(spark, folder, keep=1)
    assert manifest_of(spark, folder, 6).buckets > 2
    assert rows(snapshot.read_current(spark, folder, EXCEPT)) == expected
    prune_versions(spark, folder, keep=1)
    assert rows(snapshot.read_current(spark, folder, EXCEPT)) == expected


def test_growth_without_a_rebuild(spark, folder):
    """16 buckets become 64; what a batch writes follows the batch."""
    layout = Layout(["k"], ["k"], ["v"], buckets=16, bucket_rows=10, folder_rows=100)

    def add(number, first, last):
        news = spark.range(first, last).select(F.col("id").alias("k"), F.lit(number).alias("v"))
        commit(news, number, folder, layout, base_for(spark, folder, layout, number))

    add(0, 0, 160)
    assert manifest_of(spark, folder, 0).buckets == 16
    add(1, 160, 640)
    grown = manifest_of(spark, folder, 1)
    assert grown.buckets == 64
    first = set(files_below(f"{folder}/data/v0"))
    add(2, 5, 8)
    assert manifest_of(spark, folder, 2).buckets == 65
    assert set(files_below(f"{folder}/data/v0")) == first
    written = spark.read.parquet(f"{folder}/data/v2").count()
    assert written == 3 and not paths.exists(spark, f"{folder}/data/v2-merged")
    assert len(files_below(f"{folder}/data/v2")) == 1  # few rows make few files, whatever the buckets
    found = dict(read_table(spark, folder).select("k", "v").collect())
    assert found == {k: 2 if 5 <= k < 8 else int(k >= 160) for k in range(640)}


def test_rows_are_rewritten_a_logarithmic_number_of_times(spark, folder):
    layout = Layout(["k"], ["k"], ["v"], buckets=1, bucket_rows=10**9, folder_rows=1)
    written = 0
    for number in range(16):
        news = spark.range(number * 20, number * 20 + 20).select(F.col("id").alias("k"), F.lit(number).alias("v"))
        commit(news, number, folder, layout, base_for(spark, folder, layout, number))
        for name in (f"v{number}", f"v{number}-merged"):
            if paths.exists(spark, f"{folder}/data/{name}"):
                written += spark.read.parquet(f"{folder}/data/{name}").count()
    assert written <= 320 * 5
    assert len(manifest_of(spark, folder, 15).held[0]) <= 5
    assert read_table(spark, folder).count() == 320


def test_settled_buckets_are_read_without_a_shuffle(spark, folder):
    layout = Layout(["k"], ["k"], ["v"], buckets=4, folder_rows=1)
    commit(spark.range(100).selectExpr("id as k", "0 as v"), 0, folder, layout, base_for(spark, folder, layout, 0))
    assert "Exchange" not in read_table(spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_columns_may_be_added(spark, folder):
    layout = Layout(["k"], ["k"], ["v"], buckets=2)
    for number, news in enumerate([spark.range(4).selectExpr("id as k", "0 as v"), spark.range(2).selectExpr("id as k", "1 as v", "'x' as note")]):
        commit(news, number, folder, layout, base_for(spark, folder, layout, number))
    assert rows(read_table(spark, folder).select("k", "v", "note")) == [(0, 1, "x"), (1, 1, "x"), (2, 0, None), (3, 0, None)]
    with pytest.raises(TypeError, match="v is"):
        commit(spark.range(1).selectExpr("id as k", "'a' as v"), 2, folder, layout, base_for(spark, folder, layout, 2))


NAMES = {"start": "s", "end": "e", "current": "c"}


@pytest.mark.parametrize("seed", range(2))
def test_any_slicing_gives_the_same_history(spark, folder, seed):
    rng = random.Random(10 + seed)
    events = EVENTS + events_of(rng, 120) + [(None, "null key", "UPDATE", 3, 1.0), (None, "later", "UPDATE", 5, 1.0)]
    events += rng.choices(events, k=15)  # repeated events
    rng.shuffle(events)
    expected = rows(scd2(feed(spark, events), ["id"], ORDER, DELETE, EXCEPT, **NAMES))
    for number, part in enumerate(slices(rng, events, 6)):
        for _ in range(2 if number == 3 else 1):
            history._apply_batch(feed(spark, part), number, folder, ["id"], ORDER, DELETE, **SMALL)
    found = history.read_history(spark, folder, EXCEPT, **NAMES)
    assert found.columns == ["id", "name", "s", "e", "c"]
    assert rows(found) == expected
    assert manifest_of(spark, folder, 5).buckets > 2


def test_a_late_event_cuts_one_interval(spark, folder):
    def apply(number, data):
        history._apply_batch(feed(spark, data), number, folder, ["id"], ORDER, DELETE)

    apply(0, [("a", f"a{i}", "UPDATE", 10 * i, 0.0) for i in range(50)] + [(f"k{i}", "x", "INSERT", 1, 0.0) for i in range(200)])
    apply(1, [("a", "late", "UPDATE", 255, 0.0)])
    written = spark.read.parquet(f"{folder}/data/v1")
    assert rows(written.select("name", "_start", "_end")) == [("a25", 250, 255), ("late", 255, 260)]
    found = history.read_history(spark, folder, EXCEPT).filter("id = 'a' and __START_AT between 240 and 260")
    assert [row[1:] for row in rows(found)] == [("a24", 240, 250, False), ("a25", 250, 255, False), ("a26", 260, 270, False), ("late", 255, 260, False)]
    apply(2, [("a", None, "DELETE", 257, 0.0)])
    at = history.valid_at(history.read_history(spark, folder, EXCEPT), 258)
    assert at.filter("id = 'a'").isEmpty() and at.count() == 200
    apply(3, [("a", "late", "UPDATE", 255, 0.0)])  # the same event again: a row of no length
    assert history.read_history(spark, folder, EXCEPT).filter("name = 'late'").count() == 2


def test_history_gains_columns(spark, folder):
    first = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "id string, seq int, name string")
    second = spark.createDataFrame([("a", 3, "z", 7)], "id string, seq int, name string, size int")
    third = spark.createDataFrame([("a", 2, "w")], "id string, seq int, name string")
    for number, batch in enumerate([first, second, third, third.limit(0)]):
        history._apply_batch(batch, number, folder, ["id"], ["seq"], F.lit(False), **SMALL)
    found = history.read_history(spark, folder, ["seq"], **NAMES).select("id", "name", "size", "s", "e")
    assert rows(found) == [("a", "w", None, 2, 3), ("a", "x", None, 1, 2), ("a", "z", 7, 3, None), ("b", "y", None, 1, None)]


def test_history_of_the_customers_job(spark, folder):
    events = customer_feed()
    for number in range(4):
        put(f"{folder}/landing/customers", f"{number:02d}.json", events[3 - number :: 4])
        report = customers.run(spark, f"{folder}/landing", folder, history=True)
    found = customers.read_history(spark, report.layers)
    clean = spark.read.parquet(report.layers.table("silver", customers.CLEAN))
    expected = scd2(clean, customers.KEYS, customers.SEQUENCE_BY, customers.DELETE_WHEN, customers.EXCEPT_COLUMNS)
    assert rows(found) == rows(expected.select(found.columns))
    assert found.filter("__CURRENT").count() == 22 and found.count() == 29
    assert customers.run(spark, f"{folder}/landing", folder, history=True).steps[customers.HISTORY].rows_read == 0
    assert customers.HISTORY in customers.run(spark, f"{folder}/landing", folder, validate=True, history=True).schemas


def test_small_files_are_put_whole(spark, folder):
    path = f"{folder}/note.json"
    for text in ("one", "two"):
        paths.write_text(spark, path, text)
        assert paths.read_text(spark, path) == text
    assert paths.list_names(spark, folder) == [".note.json.part.crc", "note.json"] or "note.json" in paths.list_names(spark, folder)
    assert not paths.exists(spark, f"{path}.part")
