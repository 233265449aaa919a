"""History kept up to date by a stream: every state of a key with the time it held.

The table is a log (see ``logtable``) with a row per event, deletes included, and
the sequence value of the key's next event as its end. A batch looks up the
stored events of the keys it has. An event that comes late falls into a stored
interval and cuts it in two: its own row ends where that interval ended, and the
row before it is written once more, ending at the new event. Only new rows and
rows with another end are written; of a row written several times the last
counts. Whatever the slicing and order of the events, the table is that of
``cdc.scd2`` over all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.operators.cdc import DELETED, TIE, prepare_events
from orebed.operators.skew import lead_by_key
from orebed.streaming.logtable import (
    DEFAULT_BUCKET_ROWS,
    DEFAULT_BUCKETS,
    DEFAULT_FOLDER_ROWS,
    Layout,
    base_for,
    commit,
    read_table,
    runs_of_keys,
)
from orebed.streaming.run import RunReport, run_batches

# Start and end of a row, how many equal events it stands for, and the batch that wrote it.
START, END, COPIES, WRITTEN = "_start", "_end", "_copies", "_written"


def _apply_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    delete_when: Column | str,
    buckets: int = DEFAULT_BUCKETS,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    folder_rows: int = DEFAULT_FOLDER_ROWS,
) -> None:
    """Add one batch of events; doing it again changes nothing."""
    spark = batch.sparkSession
    order = [START, *sequence_by[1:], DELETED, TIE]
    identity = [*keys, *order]
    layout = Layout(list(keys), identity, [WRITTEN], buckets, bucket_rows, folder_rows)
    base = base_for(spark, root, layout, batch_id)
    events = prepare_events(batch, delete_when).withColumn(START, F.col(sequence_by[0])).withColumn(COPIES, F.lit(1).cast("bigint"))
    kinds = {column.name: column.dataType for column in [*base.schema, *events.schema]}
    payload = [name for name in kinds if name not in {*identity, COPIES, END, WRITTEN}]
    kinds |= {END: kinds[START], WRITTEN: T.LongType()}
    stored = F.col(WRITTEN).isNotNull()
    parts = [events]
    held = runs_of_keys(spark, root, base, batch.select(*keys).distinct())
    if held is not None:
        parts.append(held)
    filled = [part.withColumns({name: F.lit(None).cast(kinds[name]) for name in kinds if name not in part.columns}) for part in parts]
    # A row per identity; equal events are counted, so that repeats keep their number. Of stored rows the last written counts.
    last = F.max_by(F.struct(F.col(END).alias("was"), F.col(COPIES).alias("held")), F.when(stored, F.col(WRITTEN))).alias("_last")
    fresh = F.coalesce(F.sum(F.when(~stored, F.col(COPIES))), F.lit(0)).alias("_fresh")
    one = F.any_value(F.struct(*payload)).alias("_payload")
    rows = reduce(DataFrame.unionByName, filled).groupBy(*identity).agg(one, last, fresh)
    copies = F.col("_fresh") + F.coalesce(F.col("_last.held"), F.lit(0))
    rows = rows.select(*identity, "_payload.*", copies.alias(COPIES), F.col("_last.was").alias("_was"), F.col("_last.held").alias("_held"))
    rows = rows.persist()  # looked through for hot keys, then used
    try:
        ended = lead_by_key(rows, keys, order, END)
        changed = ~F.col(COPIES).eqNullSafe(F.col("_held")) | ~F.col(END).eqNullSafe(F.col("_was"))
        written = ended.filter(changed).drop("_was", "_held").withColumn(WRITTEN, F.lit(batch_id).cast("bigint"))
        commit(written, batch_id, root, layout, base)
    finally:
        rows.unpersist()


def apply_scd2_stream(
    events: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    delete_when: Column | str,
    buckets: int = DEFAULT_BUCKETS,
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    folder_rows: int = DEFAULT_FOLDER_ROWS,
) -> RunReport:
    """Bring the history below ``root`` up to date with all new change events."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        _apply_batch(batch, batch_id, root, keys, sequence_by, delete_when, buckets, bucket_rows, folder_rows)

    return run_batches(events, handle, checkpoint)


def read_history(
    spark: SparkSession,
    root: str,
    except_columns: Sequence[str] = (),
    start: str = "__START_AT",
    end: str = "__END_AT",
    current: str = "__CURRENT",
    version: int | None = None,
) -> DataFrame | None:
    """The history as ``cdc.scd2`` gives it, or None before the first batch."""
    rows = read_table(spark, root, version)
    if rows is None:
        return None
    states = rows.filter(~F.col(DELETED))
    # Equal events follow each other: each but the last ends where it starts.
    each = states.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(COPIES).cast("int"))))
    ends = F.when(F.col("_copy") < F.col(COPIES), F.col(START)).otherwise(F.col(END))
    hidden = {START, END, COPIES, WRITTEN, DELETED, TIE, *except_columns}
    return each.select(
        *[name for name in rows.columns if name not in hidden],
        F.col(START).alias(start),
        ends.alias(end),
        ends.isNull().alias(current),
    )


def valid_at(history: DataFrame, moment, start: str = "__START_AT", end: str = "__END_AT") -> DataFrame:
    """The state of every key at a moment: rows that started by then and had not ended."""
    ended = F.col(end) <= F.lit(moment)
    return history.filter((F.col(start) <= F.lit(moment)) & ~F.coalesce(ended, F.lit(False)))
