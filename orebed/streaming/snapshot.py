"""The current row of each key, kept up to date by a stream of change events.

The table is a log of the latest events per key, deletes included (see
``logtable``): a run adds its events and rereads nothing but runs that are due
to be merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from orebed.operators.cdc import DELETED, TIE, current_rows, latest_events, prepare_events
from orebed.streaming.logtable import (
    DEFAULT_BUCKET_ROWS,
    DEFAULT_BUCKETS,
    DEFAULT_FOLDER_ROWS,
    Layout,
    SnapshotMismatch,
    base_for,
    commit,
    prune_versions,
    read_table,
    versions,
)
from orebed.streaming.run import RunReport, run_batches

__all__ = [
    "SnapshotMismatch",
    "apply_scd1_stream",
    "prune_versions",
    "read_current",
    "read_state",
    "versions",
]


def read_state(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The latest events per key with tombstones, or None before the first batch."""
    return read_table(spark, root, version)


def read_current(spark: SparkSession, root: str, except_columns: Sequence[str] = ()) -> DataFrame | None:
    state = read_state(spark, root)
    return None if state is None else current_rows(state, except_columns)


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
    """Add one batch of change events; doing it again changes nothing."""
    order = [*sequence_by, DELETED, TIE]
    layout = Layout(list(keys), list(keys), order, buckets, bucket_rows, folder_rows)
    base = base_for(batch.sparkSession, root, layout, batch_id)
    commit(latest_events(prepare_events(batch, delete_when), keys, sequence_by), batch_id, root, layout, base)


def apply_scd1_stream(
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
    """Apply all new change events to the table below ``root``.

    ``buckets`` is the number to begin with; buckets split as the table grows.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        _apply_batch(batch, batch_id, root, keys, sequence_by, delete_when, buckets, bucket_rows, folder_rows)

    return run_batches(events, handle, checkpoint)
