"""Join of two streams on a key and a bounded time gap that keeps the rows that come too late."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PAIR, LATE = "pair", "late"
# Left rows whose partners are put out in one frame.
CHUNK = 10_000

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def with_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on disk rather than on the heap."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


class _Pairs(StatefulProcessor):
    """Pairs of one slot of one bucket. Times are microseconds."""

    def __init__(self, gap: int, slot: int) -> None:
        self.gap, self.slot = gap, slot

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        row = "part bigint, id bigint, at bigint"
        self.lefts = handle.getListState("lefts", row)
        self.rights = handle.getListState("rights", row)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        fresh = pd.concat(list(rows), ignore_index=True)
        gone = fresh["at"] < now
        late = fresh[gone & fresh["home"]]
        if len(late):
            left = late["is_left"]
            yield _out(LATE, late["id"].where(left), late["id"].where(~left))
        fresh = fresh[~gone]
        if fresh.empty:
            return
        new = [fresh.loc[fresh["is_left"] == side, ["part", "id", "at"]] for side in (True, False)]
        old = [pd.DataFrame(list(state.get()), columns=["part", "id", "at"]) for state in (self.lefts, self.rights)]
        yield from self._pairs(new[0], pd.concat([old[1], new[1]]))
        yield from self._pairs(old[0], new[1])
        for state, side in zip((self.lefts, self.rights), new):
            if len(side):
                state.appendList(list(side.astype("int64").itertuples(index=False, name=None)))
        if old[0].empty and old[1].empty:
            # Whatever could still meet these rows is late from here on.
            self.handle.registerTimer(((key[1] + 1) * self.slot + self.gap) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.lefts.clear()
        self.rights.clear()
        return iter(())

    def close(self) -> None:
        pass

    def _pairs(self, left: pd.DataFrame, right: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Right rows of a part in time order are a run, and the partners of a left row a run of that."""
        if left.empty or right.empty:
            return
        right = right.astype("int64").sort_values(["part", "at", "id"])
        parts, starts = np.unique(right["part"].to_numpy(), return_index=True)
        ends = np.append(starts[1:], len(right))
        at, ids = right["at"].to_numpy(), right["id"].to_numpy()
        runs = {part: (start, end) for part, start, end in zip(parts.tolist(), starts.tolist(), ends.tolist())}
        for part, group in left.astype("int64").groupby("part"):
            if part not in runs:
                continue
            start, end = runs[part]
            for place in range(0, len(group), CHUNK):
                some = group.iloc[place : place + CHUNK]
                low = np.searchsorted(at[start:end], some["at"].to_numpy(), "left")
                high = np.searchsorted(at[start:end], some["at"].to_numpy() + self.gap, "right")
                count = high - low
                if count.sum():
                    first = np.repeat(low + start - np.r_[0, np.cumsum(count)[:-1]], count)
                    yield _out(PAIR, np.repeat(some["id"].to_numpy(), count), ids[first + np.arange(count.sum())])


def _out(kind: str, left, right) -> pd.DataFrame:
    # Plain arrays: the index of either side says nothing here.
    frame = pd.DataFrame({"left_id": np.asarray(left), "right_id": np.asarray(right)})
    frame = frame.astype("Int64")
    frame.insert(0, "kind", kind)
    return frame


def interval_join_keeping_late(
    left: DataFrame,
    right: DataFrame,
    key: str,
    gap_seconds: int,
    watermark: str,
    slot_seconds: int | None = None,
    buckets: int = 64,
    spread: int = 1,
) -> DataFrame:
    """Pairs with equal ``key`` and ``left ts <= right ts <= left ts + gap``, and the late rows.

    Both sides are streams with the columns ``key`` (whole number), ``id`` (whole
    number, not null) and ``ts``. Returns (kind, left_id, right_id): kind ``pair``
    has both ids; kind ``late`` has the one id of a row that came with a time
    before the watermark. The watermark follows the latest time of both sides, less the
    given delay, from batch to batch. A late row is put out once and joins
    nothing; all others find all partners, however the rows fall into batches. Rows without
    key or time can match nothing and are left out.

    State is kept per time slot (four gaps wide unless stated) and bucket of keys. A slot's
    rows go when the watermark is a gap past its end, so the state holds the
    rows of the delay, one slot and one gap, whatever the length of the streams. A right row
    within a gap of its slot's start is offered to the slot before as well. A hot
    key's left rows can be dealt to ``spread`` parts, its right rows go to each.
    Slots, buckets and spread belong to the checkpoint. Needs a state store with
    several states per key; see ``with_rocksdb``.
    """
    slot = (slot_seconds or 4 * gap_seconds) * 1_000_000
    gap = gap_seconds * 1_000_000
    if slot < gap:
        raise ValueError("a slot must be as wide as the gap")
    names = [F.col(key).cast("bigint").alias("key"), F.col("id").cast("bigint").alias("id"), F.col("ts").cast("timestamp").alias("ts")]
    rows = left.select(*names, F.lit(True).alias("is_left")).unionByName(right.select(*names, F.lit(False).alias("is_left")))
    rows = rows.filter("key is not null and ts is not null").withWatermark("ts", watermark)
    # A plain number: Spark itself would drop late rows of a frame that shows it the time column.
    rows = rows.select("key", "id", "is_left", F.unix_micros("ts").alias("at"))
    own = F.floor(F.col("at") / F.lit(slot)).cast("bigint")
    near = (~F.col("is_left")) & (F.col("at") - own * slot <= gap)
    rows = rows.withColumn("slot", F.explode(F.when(near, F.array(own, own - 1)).otherwise(F.array(own))))
    shares = F.sequence(F.lit(0), F.lit(spread - 1))
    dealt = F.when(F.col("is_left"), F.array(F.pmod(F.xxhash64("id"), F.lit(spread)).cast("int"))).otherwise(shares)
    rows = rows.withColumn("share", F.explode(dealt))
    home = (F.col("slot") == own) & (F.col("is_left") | (F.col("share") == 0))
    rows = rows.select(
        F.pmod(F.xxhash64("key", "share"), F.lit(buckets)).cast("bigint").alias("bucket"),
        "slot",
        (F.col("key") if spread == 1 else F.xxhash64("key", "share")).alias("part"),
        "id",
        "at",
        "is_left",
        home.alias("home"),
    )
    return rows.groupBy("bucket", "slot").transformWithStateInPandas(
        statefulProcessor=_Pairs(gap, slot),
        outputStructType="kind string, left_id bigint, right_id bigint",
        outputMode="append",
        timeMode="EventTime",
    )
