"""Counts of each batch of a stream, kept beside its checkpoint.

One small file per batch holds the batch's own counts and the totals up to it,
so that the newest file alone gives the totals, however many batches there were.
An entry is named by its batch: a batch that is run again replaces its entry.

Streams into a file sink are followed by a listener (``following``). Spark
reports a batch after it has committed it; a process that ends just between the
two loses that batch's counts, never its rows. ``run_counted`` writes the entry
before Spark commits the batch, so there the counts cannot be lost either.
"""

from __future__ import annotations

import json
import re
import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from orebed import paths
from orebed.operators.expectations import Expectation, apply_expectations

Counts = Mapping[str, Mapping[str, int]]
ENTRY = "batch bigint, rows bigint, counts map<string,map<string,bigint>>"
EMPTY = {"batch": -1, "rows": 0, "counts": {}, "all_rows": 0, "all_batches": 0, "all_counts": {}}


def _summed(left: Counts, right: Counts, sign: int = 1) -> dict[str, dict[str, int]]:
    total = {name: dict(counts) for name, counts in left.items()}
    for name, counts in right.items():
        into = total.setdefault(name, {})
        for key, value in counts.items():
            into[key] = into.get(key, 0) + sign * value
    return total


class MetricLog:
    """The entries of one stream. One writer at a time, as for a checkpoint."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder
        numbers = sorted(int(part[1]) for part in map(re.compile(r"b(\d+)\.json").fullmatch, paths.list_names(spark, folder)) if part)
        self._last = self._read(numbers[-1]) if numbers else EMPTY
        self._before = self._read(numbers[-2]) if len(numbers) > 1 else EMPTY

    def _read(self, batch: int) -> dict:
        return json.loads(paths.read_text(self._spark, f"{self._folder}/b{batch}.json"))

    @property
    def last_batch(self) -> int:
        return self._last["batch"]

    @property
    def totals(self) -> dict:
        """``rows``, ``batches`` and ``counts`` of all batches."""
        last = self._last
        return {"rows": last["all_rows"], "batches": last["all_batches"], "counts": last["all_counts"]}

    def put(self, batch: int, rows: int, counts: Counts) -> None:
        """Set the counts of a batch: a new one, or the last one again."""
        if batch < self.last_batch:
            raise ValueError(f"{self._folder}: batch {batch} comes after batch {self.last_batch}")
        before = self._before if batch == self.last_batch else self._last
        entry = {
            "batch": batch,
            "rows": rows,
            "counts": counts,
            "all_rows": before["all_rows"] + rows,
            "all_batches": before["all_batches"] + 1,
            "all_counts": _summed(before["all_counts"], counts),
        }
        paths.write_text(self._spark, f"{self._folder}/b{batch}.json", json.dumps(entry))
        self._before, self._last = before, entry

    def since(self, earlier: dict) -> dict:
        """What was added to the totals of an earlier time."""
        now = self.totals
        return {
            "rows": now["rows"] - earlier["rows"],
            "batches": now["batches"] - earlier["batches"],
            "counts": {
                name: counts
                for name, counts in _summed(now["counts"], earlier["counts"], -1).items()
                if now["batches"] > earlier["batches"]
            },
        }


class _Follower(StreamingQueryListener):
    """Puts the progress of one query into a log."""

    def __init__(self, log: MetricLog) -> None:
        self._log, self._error = log, None
        self._run: str | None = None
        self._ended: dict[str, threading.Event] = {}
        self._early: list = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            if self._run is None:
                self._early.append(event.progress)
            elif str(event.progress.runId) == self._run:
                self._take(event.progress)

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.setdefault(str(event.runId), threading.Event()).set()

    def _take(self, progress) -> None:
        # A batch without rows has no counts; one that the sink has already is reported without rows, too.
        if not progress.numInputRows or self._error:
            return
        try:
            counts = {name: row.asDict() for name, row in progress.observedMetrics.items()}
            self._log.put(progress.batchId, progress.numInputRows, counts)
        except Exception as error:  # noqa: BLE001 - Spark drops what a listener raises; raised by ``finish``
            self._error = error

    def follow(self, run: str) -> None:
        """Which run to log. Other queries of the session are passed over."""
        with self._lock:
            self._run = run
            for progress in self._early:
                if str(progress.runId) == run:
                    self._take(progress)
            self._early = []

    def finish(self, wait: float = 120) -> None:
        """Wait until all events of the run have come in."""
        with self._lock:
            ended = self._ended.setdefault(self._run, threading.Event())
        if not ended.wait(wait):
            raise TimeoutError("the last progress of the stream was not reported")
        if self._error:
            raise self._error


@contextmanager
def following(spark: SparkSession, log: MetricLog) -> Iterator[_Follower]:
    follower = _Follower(log)
    spark.streams.addListener(follower)
    try:
        yield follower
    finally:
        spark.streams.removeListener(follower)


def run_counted(
    df: DataFrame,
    rules: Sequence[Expectation],
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str = "expectations",
) -> dict:
    """Hand the rows that pass the rules to ``write``, batch by batch; returns what the run added.

    ``write`` must be able to take a batch again, which may happen after a failure. It
    may read its frame more than once: rows are counted in its first action only.
    """
    spark = df.sparkSession
    log = MetricLog(spark, metrics_folder(checkpoint))
    earlier = log.totals

    def handle(batch: DataFrame, number: int) -> None:
        observation = Observation(name)
        write(apply_expectations(batch, rules, observation), number)
        counts = observation.get
        log.put(number, counts["rows"], {name: counts})

    query = (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return log.since(earlier)


def metrics_folder(checkpoint: str) -> str:
    return f"{checkpoint}/metrics"


def read_metrics(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per batch, flow (the name of its expectations) and metric; ``rows_read`` has no flow."""
    folder = metrics_folder(checkpoint)
    if not any(name.endswith(".json") for name in paths.list_names(spark, folder)):
        return spark.createDataFrame([], "batch bigint, flow string, metric string, value bigint")
    entries = spark.read.schema(ENTRY).json(f"{folder}/b*.json")
    flows = entries.select("batch", F.explode("counts").alias("flow", "_counts"))
    read = entries.select("batch", F.lit(None).cast("string").alias("flow"), F.lit("rows_read").alias("metric"), F.col("rows").alias("value"))
    return flows.select("batch", "flow", F.explode("_counts").alias("metric", "value")).unionByName(read)
