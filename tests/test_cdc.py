import random

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from orebed import paths
from orebed.operators.cdc import dedupe_latest, merge_into, scd1, scd2
from orebed.streaming.snapshot import (
    SnapshotMismatch,
    _apply_batch,
    apply_scd1_stream,
    prune_versions,
    read_current,
    read_state,
    versions,
)
from tests.conftest import rows

SCHEMA = "id string, name string, op string, seq int, raw double"
DELETE = "op = 'DELETE'"
ORDER = ["seq", "raw"]
EXCEPT = ["op", "seq", "raw"]


def feed(spark, data):
    return spark.createDataFrame(data, SCHEMA)


EVENTS = [
    ("a", "a1", "INSERT", 1, 1.0),
    ("a", "a2", "UPDATE", 3, 3.0),
    ("a", "a0", "UPDATE", 2, 2.0),  # late
    ("b", "b1", "INSERT", 1, 1.0),
    ("b", None, "DELETE", 5, 5.0),
    ("b", "b2", "UPDATE", 4, 4.0),  # late update after a delete
    ("c", "c2", "UPDATE", 2, 2.0),  # update before its insert
    ("c", "c1", "INSERT", 1, 1.0),
    ("d", "d1", "INSERT", 1, 1.2),
    ("d", "d2", "UPDATE", 1, 1.7),  # same whole second
    ("e", "e1", "UPDATE", 1, 1.0),
    ("e", None, "DELETE", 1, 1.0),  # equal sequence: the delete is last
    ("f", "f1", "INSERT", 1, 1.0),
    ("f", None, "DELETE", 2, 2.0),
    ("f", "f3", "INSERT", 3, 3.0),  # inserted again
    ("g", None, "UPDATE", 2, 2.0),  # an update replaces with nulls too
    ("g", "g1", "INSERT", 1, 1.0),
]
EXPECTED = [("a", "a2"), ("c", "c2"), ("d", "d2"), ("f", "f3"), ("g", None)]


def test_scd1(spark):
    assert rows(scd1(feed(spark, EVENTS), ["id"], ORDER, DELETE, EXCEPT)) == EXPECTED


@pytest.mark.parametrize("seed", range(4))
def test_any_slicing_gives_the_same_table(spark, folder, seed):
    rng = random.Random(seed)
    events = EVENTS + [
        (f"k{rng.randrange(12)}", f"n{i}", rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), rng.randrange(9), float(i))
        for i in range(60)
    ]
    expected = rows(scd1(feed(spark, events), ["id"], ORDER, DELETE, EXCEPT))
    rng.shuffle(events)
    cuts = sorted(rng.sample(range(1, len(events)), 3))
    for batch_id, (start, end) in enumerate(zip([0, *cuts], [*cuts, len(events)])):
        batch = feed(spark, events[start:end])
        _apply_batch(batch, batch_id, folder, ["id"], ORDER, DELETE, buckets=4)
        if batch_id == 1:  # a retried batch changes nothing
            _apply_batch(batch, batch_id, folder, ["id"], ORDER, DELETE, buckets=4)
    assert rows(read_current(spark, folder, EXCEPT)) == expected


def test_stream_keeps_tombstones(spark, folder):
    paths.make_dirs(spark, f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")

    def land(data):
        feed(spark, data).write.mode("append").parquet(f"{folder}/in")

    def apply():
        return apply_scd1_stream(stream, f"{folder}/t", f"{folder}/cp", ["id"], ORDER, DELETE, buckets=3)

    land([("x", "x1", "INSERT", 1, 1.0), ("y", "y1", "INSERT", 1, 1.0)])
    apply()
    land([("x", None, "DELETE", 5, 5.0)])
    apply()
    land([("x", "late", "UPDATE", 3, 3.0)])
    apply()
    assert rows(read_current(spark, f"{folder}/t", EXCEPT)) == [("y", "y1")]
    assert read_state(spark, f"{folder}/t").count() == 2
    before = versions(spark, f"{folder}/t")
    assert apply().rows_read == 0
    assert versions(spark, f"{folder}/t") == before


def test_only_touched_buckets_are_rewritten(spark, folder):
    keys = [(f"k{i}", f"n{i}", "INSERT", 1, 1.0) for i in range(40)]
    _apply_batch(feed(spark, keys), 0, folder, ["id"], ORDER, DELETE, buckets=8, folder_rows=1)
    first = paths.list_names(spark, f"{folder}/data/v0")
    _apply_batch(feed(spark, [("k3", "new", "UPDATE", 2, 2.0)]), 1, folder, ["id"], ORDER, DELETE, buckets=8, folder_rows=1)
    second = [name for name in paths.list_names(spark, f"{folder}/data/v1") if name.startswith("_bucket")]
    assert len([name for name in first if name.startswith("_bucket")]) == 8
    assert len(second) == 1
    current = {row["id"]: row["name"] for row in read_current(spark, folder, EXCEPT).collect()}
    assert len(current) == 40 and current["k3"] == "new"


def test_prune_keeps_what_is_in_use(spark, folder):
    for number in range(6):
        data = [(f"k{number}", f"v{number}", "INSERT", number, 1.0), ("same", f"s{number}", "UPDATE", number, 1.0)]
        _apply_batch(feed(spark, data), number, folder, ["id"], ORDER, DELETE, buckets=4)
    expected = rows(read_current(spark, folder, EXCEPT))
    prune_versions(spark, folder, keep=2)
    assert versions(spark, folder) == [4, 5]
    assert rows(read_current(spark, folder, EXCEPT)) == expected
    assert read_state(spark, folder, 4).count() == 6
    prune_versions(spark, folder, keep=2)
    assert rows(read_current(spark, folder, EXCEPT)) == expected


def test_lost_checkpoint_is_an_error(spark, folder):
    for number in range(3):
        _apply_batch(feed(spark, EVENTS), number, folder, ["id"], ORDER, DELETE, buckets=2)
    with pytest.raises(SnapshotMismatch):
        _apply_batch(feed(spark, EVENTS), 0, folder, ["id"], ORDER, DELETE, buckets=2)


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_scd2(spark, hot_rows):
    history = scd2(feed(spark, EVENTS), ["id"], ORDER, DELETE, EXCEPT, hot_rows=hot_rows)
    assert history.columns == ["id", "name", "__START_AT", "__END_AT", "__CURRENT"]
    found = [row for row in rows(history) if row[0] in "abf"]
    assert found == [
        ("a", "a0", 2, 3, False),
        ("a", "a1", 1, 2, False),
        ("a", "a2", 3, None, True),
        ("b", "b1", 1, 4, False),
        ("b", "b2", 4, 5, False),
        ("f", "f1", 1, 2, False),
        ("f", "f3", 3, None, True),
    ]


def test_scd2_current_rows_are_scd1(spark):
    history = scd2(feed(spark, EVENTS), ["id"], ORDER, DELETE, EXCEPT)
    assert rows(history.filter("__CURRENT").select("id", "name")) == EXPECTED


def test_merge(spark):
    target = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0), (4, None)], "k int, v double")
    source = spark.createDataFrame(
        [(1, 11.0, "UPDATE"), (2, None, "DELETE"), (3, 33.0, "INSERT"), (5, 50.0, "INSERT"), (6, 60.0, "UPDATE"),
         (7, 0.0, "DELETE"), (4, None, "UPDATE")],
        "k int, v double, op string",
    )
    assert rows(merge_into(target, source, ["k"], "op")) == [(1, 11.0), (3, 30.0), (4, None), (5, 50.0)]


def test_merge_keeps_repeated_inserts(spark):
    target = spark.createDataFrame([(1, 1.0)], "k int, v double")
    source = spark.createDataFrame([(2, 5.0, "INSERT"), (2, 6.0, "INSERT"), (9, 1.0, "DELETE"), (9, 1.0, "DELETE")], "k int, v double, op string")
    assert rows(merge_into(target, source, ["k"], "op")) == [(1, 1.0), (2, 5.0), (2, 6.0)]


def test_merge_refuses_two_changes_of_one_row(spark):
    target = spark.createDataFrame([(1, 1.0)], "k int, v double")
    source = spark.createDataFrame([(1, 5.0, "UPDATE"), (1, 6.0, "UPDATE")], "k int, v double, op string")
    with pytest.raises(PySparkException, match="several source rows"):
        merge_into(target, source, ["k"], "op").collect()


def test_dedupe_latest(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("b", 1, 7), (None, 1, 1), (None, 3, 2)], "k string, t int, v int")
    assert rows(dedupe_latest(df, ["k"], ["t"])) == [("a", 2, 6), ("b", 1, 7), (None, 3, 2)]
    assert rows(dedupe_latest(df, ["k"], [-F.col("t")])) == [("a", 1, 5), ("b", 1, 7), (None, 1, 1)]


@pytest.mark.parametrize("crash_at", ["before_manifest", "after_manifest"])
def test_a_crashed_batch_is_redone(spark, folder, monkeypatch, crash_at):
    """Whether the run dies before or after its manifest, the next run repairs it."""
    paths.make_dirs(spark, f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")

    def land(data):
        feed(spark, data).write.mode("append").parquet(f"{folder}/in")

    def apply():
        return apply_scd1_stream(stream, f"{folder}/t", f"{folder}/cp", ["id"], ORDER, DELETE, buckets=3)

    land(EVENTS[:6])
    apply()
    land(EVENTS[6:])
    plain = paths.write_text

    def broken(session, path, text):
        if crash_at == "after_manifest":
            plain(session, path, text)
        raise OSError("lost connection")

    monkeypatch.setattr(paths, "write_text", broken)
    with pytest.raises(StreamingQueryException, match="lost connection"):
        apply()
    monkeypatch.setattr(paths, "write_text", plain)
    apply()
    assert rows(read_current(spark, f"{folder}/t", EXCEPT)) == EXPECTED


@pytest.mark.parametrize("large", [False, True])
def test_merge_against_brute_force(spark, large):
    rng = random.Random(12)
    target = [(rng.choice([None, 1, 2, 3, *range(4, 200)]), float(i)) for i in range(400)]
    source, changed = [], set()
    for i in range(300):
        key, op = rng.choice([None, *range(-40, 200)]), rng.choice(["INSERT", "INSERT", "UPDATE", "DELETE", "OTHER", None])
        if op in ("UPDATE", "DELETE"):
            if key in changed:
                continue
            changed.add(key)
        source.append((key, float(1000 + i), op))
    present = {key for key, _ in target if key is not None}
    change = {key: (op, v) for key, v, op in source if op in ("UPDATE", "DELETE") and key is not None}
    expected = [(key, change[key][1] if key in change else v) for key, v in target if change.get(key, ("",))[0] != "DELETE"]
    expected += [(key, v) for key, v, op in source if op == "INSERT" and key not in present]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items() if large else ():
        spark.conf.set(name, value)
    try:
        merged = merge_into(
            spark.createDataFrame(target, "k int, v double"), spark.createDataFrame(source, "k int, v double, op string"), ["k"], "op"
        )
        assert rows(merged) == sorted(expected, key=repr)
    finally:
        for name in settings if large else ():
            spark.conf.unset(name)


def test_ties_do_not_depend_on_the_ingest(spark):
    """Equal key and sequence: the payload alone decides, whenever and from whatever file it came."""
    from orebed.operators.cdc import scd1

    winners = set()
    for hour in range(12):
        rows = [("k", 1, name, f"2024-01-01 {(hour * (place + 5)) % 24:02d}:00:00", f"f{hour}{place}") for place, name in enumerate("AB")]
        df = spark.createDataFrame(rows, "id string, seq int, name string, processing_time string, source_file string")
        winners.add(scd1(df, ["id"], ["seq"], "false").first().name)
    assert len(winners) == 1
