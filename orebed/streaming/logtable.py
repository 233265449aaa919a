"""A keyed table that grows by deltas: Parquet runs per bucket, merged when read.

Rows belong to buckets by a hash of their key. A batch adds one *run* to the
buckets it touches and rewrites nothing. Of rows with the same identity the last
one in order counts, so runs may be merged in any grouping: readers do so on the
fly, and a bucket merges its newest runs once they are no longer small beside the
one before. A row is thereby rewritten a logarithmic number of times.

Buckets follow linear hashing: with ``n`` buckets, the next split divides bucket
``n - 2^k`` alone. A split only changes the manifest; both halves point to the old
runs until their next merge. Small batches share folders between buckets in the
same way, so a batch writes as many files as its rows deserve.

Each version has a manifest naming the runs of every bucket. Redoing a batch
starts from the version before it and writes the same places again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed import paths

BUCKET = "_bucket"
DEFAULT_BUCKETS = 16
DEFAULT_BUCKET_ROWS = 4_000_000
DEFAULT_FOLDER_ROWS = 500_000
# A run has more folders than this only if each has the rows of a default one: files cost the same whatever they hold.
MOST_FOLDERS = 256
# A run is merged with the newer ones unless it has so many times their rows.
RATIO = 2
# Runs of few rows wait for each other until a bucket has more than this.
WAITING_RUNS = 8


class SnapshotMismatch(RuntimeError):
    """The checkpoint and the table do not belong together."""


@dataclass(frozen=True)
class Layout:
    """What identifies a row, which of several counts, and how large parts may get.

    Rows with equal ``keys`` share a bucket; ``identity`` includes them. The table
    begins with ``buckets`` buckets and splits one whenever there are more than
    ``bucket_rows`` rows a bucket. A folder takes about ``folder_rows`` rows, more
    where a run would else have very many small ones.
    """

    keys: Sequence[str]
    identity: Sequence[str]
    order: Sequence[str]
    buckets: int = DEFAULT_BUCKETS
    bucket_rows: int = DEFAULT_BUCKET_ROWS
    folder_rows: int = DEFAULT_FOLDER_ROWS


@dataclass
class Manifest:
    """What a version consists of.

    ``held`` has the runs of every bucket, oldest first, as (folder, rows);
    ``spans`` the number of buckets with rows in a folder.
    """

    buckets: int
    keys: Sequence[str]
    identity: Sequence[str]
    order: Sequence[str]
    schema: T.StructType = field(default_factory=T.StructType)
    held: dict[int, list[tuple[str, int]]] = field(default_factory=dict)
    spans: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({**vars(self), "schema": self.schema.jsonValue()})

    @classmethod
    def parse(cls, text: str) -> Manifest:
        raw = json.loads(text)
        held = {int(bucket): [tuple(run) for run in runs] for bucket, runs in raw.pop("held").items()}
        return cls(**{**raw, "schema": T.StructType.fromJson(raw["schema"])}, held=held)

    @property
    def rows(self) -> int:
        return sum(rows for runs in self.held.values() for _, rows in runs)

    def folders(self, buckets: Iterable[int] | None = None) -> list[str]:
        chosen = self.held if buckets is None else [bucket for bucket in buckets if bucket in self.held]
        return sorted({folder for bucket in chosen for folder, _ in self.held[bucket]})

    def settled(self) -> dict[str, list[int]]:
        """Folders whose rows are all current, with their buckets: each of these has that run alone."""
        alone: dict[str, list[int]] = {}
        for bucket, runs in self.held.items():
            if len(runs) == 1:
                alone.setdefault(runs[0][0], []).append(bucket)
        return {folder: buckets for folder, buckets in alone.items() if len(buckets) == self.spans[folder]}

    def gain(self, schema: T.StructType) -> None:
        """Take in columns the table does not have yet; a known one must keep its type."""
        for column in schema:
            if column.name not in self.schema.names:
                self.schema = T.StructType([*self.schema.fields, T.StructField(column.name, column.dataType)])
            elif self.schema[column.name].dataType != column.dataType:
                raise TypeError(f"{column.name} is {self.schema[column.name].dataType} in the table, not {column.dataType}")

    def add(self, folders: dict[int, str], counts: dict[int, int]) -> None:
        for bucket, rows in counts.items():
            self.held.setdefault(bucket, []).append((folders[bucket], rows))
            self.spans[folders[bucket]] = self.spans.get(folders[bucket], 0) + 1

    def split(self) -> None:
        """One bucket more: the half of another one that its next hash bit tells apart."""
        half, new = self.buckets - _power(self.buckets), self.buckets
        self.buckets += 1
        runs = self.held.get(half, [])
        if runs:
            self.held[half] = [(folder, (rows + 1) // 2) for folder, rows in runs]
            self.held[new] = [(folder, max(1, rows // 2)) for folder, rows in runs]
            for folder, _ in runs:
                self.spans[folder] += 1

    def forget_unused(self) -> None:
        used = set(self.folders())
        self.spans = {folder: number for folder, number in self.spans.items() if folder in used}


def _power(number: int) -> int:
    """The largest power of two that is not above the number."""
    return 1 << (number.bit_length() - 1)


def address(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key among any number of buckets."""
    hashed, level = F.xxhash64(*keys), _power(buckets)
    low = F.pmod(hashed, F.lit(level))
    return F.when(low < buckets - level, F.pmod(hashed, F.lit(2 * level))).otherwise(low).cast("int")


def _folder_count(rows: int, folder_rows: int, buckets: int) -> int:
    """A folder per bucket if the rows fill them, else a power of two that buckets share evenly."""
    need = min(max(1, rows // folder_rows), max(MOST_FOLDERS, rows // DEFAULT_FOLDER_ROWS))
    return buckets if need >= buckets else min(_power(need), _power(buckets))


def _data(root: str, folder: str = "") -> str:
    return f"{root}/data/{folder}" if folder else f"{root}/data"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Finished versions, oldest first."""
    names = paths.list_names(spark, f"{root}/manifest")
    return sorted(int(name[1:-5]) for name in names if name.startswith("v") and name.endswith(".json"))


def manifest_of(spark: SparkSession, root: str, version: int) -> Manifest:
    return Manifest.parse(paths.read_text(spark, f"{root}/manifest/v{version}.json"))


def last_rows(rows: DataFrame, manifest: Manifest) -> DataFrame:
    """Of rows with the same identity the last in order. Maxima are taken before rows move."""
    packed, order = F.struct(*rows.columns), F.struct(*manifest.order)
    return rows.groupBy(*manifest.identity).agg(F.max_by(packed, order).alias("_last")).select("_last.*")


def _read(spark: SparkSession, root: str, manifest: Manifest, folders: Sequence[str]) -> DataFrame:
    """Rows of folders; columns that later runs have gained are null in earlier ones."""
    return spark.read.schema(manifest.schema).parquet(*[_data(root, folder) for folder in folders])


def _of_buckets(rows: DataFrame, manifest: Manifest, buckets: Iterable[int], how: str) -> DataFrame:
    """Rows in (``left_semi``) or outside (``left_anti``) of buckets."""
    # A number for each bucket at most.
    marks = F.broadcast(rows.sparkSession.createDataFrame([(bucket,) for bucket in buckets], f"{BUCKET} int"))
    return rows.withColumn(BUCKET, address(manifest.keys, manifest.buckets)).join(marks, BUCKET, how).drop(BUCKET)


def read_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """All rows that count, or None before the first batch. Only what has several runs is merged."""
    known = versions(spark, root)
    if version is None and known:
        version = known[-1]
    if version is None or version not in known:
        return None
    manifest = manifest_of(spark, root, version)
    settled = manifest.settled()
    others = sorted(set(manifest.folders()) - set(settled))
    if not others:
        return _read(spark, root, manifest, sorted(settled)) if settled else None
    rows = _read(spark, root, manifest, others)
    if not settled:
        return last_rows(rows, manifest)
    # A folder may hold rows of a bucket that has merged them elsewhere since.
    merged = _of_buckets(rows, manifest, [bucket for buckets in settled.values() for bucket in buckets], "left_anti")
    return _read(spark, root, manifest, sorted(settled)).unionByName(last_rows(merged, manifest))


def runs_of_keys(spark: SparkSession, root: str, base: Manifest, chosen: DataFrame) -> DataFrame | None:
    """The rows of the keys in ``chosen``, from their buckets' runs alone; a row may have been replaced in a later run."""
    keys = base.keys
    numbers = chosen.select(address(keys, base.buckets).alias(BUCKET)).distinct().collect()  # a row per bucket
    folders = base.folders(row[0] for row in numbers)
    if not folders:
        return None
    rows = _read(spark, root, base, folders)
    wanted = chosen.select(*[F.col(key).alias(f"_want_{key}") for key in keys])
    same = [rows[key].eqNullSafe(wanted[f"_want_{key}"]) for key in keys]
    return rows.join(wanted, same, "left_semi")


def read_keys(spark: SparkSession, root: str, base: Manifest, chosen: DataFrame) -> DataFrame | None:
    """The rows that count of the keys in ``chosen``, from their buckets' runs alone."""
    rows = runs_of_keys(spark, root, base, chosen)
    return None if rows is None else last_rows(rows, base)


def base_for(spark: SparkSession, root: str, layout: Layout, batch_id: int) -> Manifest:
    """What a batch starts from: the last version before it."""
    known = versions(spark, root)
    if known and known[-1] > batch_id:
        raise SnapshotMismatch(f"{root} is at version {known[-1]}, but the checkpoint resumes at {batch_id}")
    before = [version for version in known if version < batch_id]
    return manifest_of(spark, root, before[-1]) if before else Manifest(layout.buckets, layout.keys, layout.identity, layout.order)


def _write_run(rows: DataFrame, root: str, name: str, layout: Layout, buckets: int, expected: int) -> dict[int, str]:
    """Write rows as one run; the folder of every bucket."""
    count = _folder_count(expected, layout.folder_rows, buckets)
    even = count <= _power(buckets)
    place = F.pmod(F.xxhash64(*layout.keys), F.lit(count)).cast("int") if even else address(layout.keys, buckets)
    (
        # Sized at run time: small folders share a task, large ones are split.
        rows.withColumn(BUCKET, place)
        .hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .partitionBy(BUCKET)
        .parquet(_data(root, name))
    )
    return {bucket: f"{name}/{BUCKET}={bucket % count if even else bucket}" for bucket in range(buckets)}


def _counts(rows: DataFrame, layout: Layout, buckets: int) -> dict[int, int]:
    found = rows.groupBy(address(layout.keys, buckets).alias(BUCKET)).count().collect()  # a row per bucket
    return {row[BUCKET]: row["count"] for row in found}


def _newest_to_merge(sizes: Sequence[int], folder_rows: int) -> int:
    """How many of a bucket's newest runs to merge, 0 for none."""
    total, taken = sizes[-1], 1
    for size in reversed(sizes[:-1]):
        if size >= RATIO * total:
            break
        total, taken = total + size, taken + 1
    if taken == 1 or (total < folder_rows and len(sizes) <= WAITING_RUNS):
        return 0
    return taken


def _compact(spark: SparkSession, root: str, name: str, layout: Layout, manifest: Manifest, touched: Iterable[int]) -> None:
    """Merge the newest runs of touched buckets where that is due.

    A folder that several buckets share may be read for more of them than asked;
    merging a row twice gives the same row.
    """
    due = {}
    for bucket in touched:
        if taken := _newest_to_merge([rows for _, rows in manifest.held[bucket]], layout.folder_rows):
            due[bucket] = taken
    if not due:
        return
    folders = sorted({folder for bucket, taken in due.items() for folder, _ in manifest.held[bucket][-taken:]})
    expected = sum(rows for bucket, taken in due.items() for _, rows in manifest.held[bucket][-taken:])
    rows = _of_buckets(_read(spark, root, manifest, folders), manifest, due, "left_semi")
    places = _write_run(last_rows(rows, manifest), root, name, layout, manifest.buckets, expected)
    written = _counts(_read(spark, root, manifest, [name]), layout, manifest.buckets)
    for bucket, taken in due.items():
        manifest.held[bucket] = manifest.held[bucket][:-taken]
    manifest.add(places, written)
    manifest.held = {bucket: runs for bucket, runs in manifest.held.items() if runs}


def commit(news: DataFrame, batch_id: int, root: str, layout: Layout, base: Manifest) -> None:
    """Add the batch's rows (an identity at most once) as version ``batch_id``."""
    spark = news.sparkSession
    manifest = Manifest.parse(base.text())
    manifest.gain(news.schema)
    news = news.persist()  # counted, then written
    try:
        counts = _counts(news, layout, manifest.buckets)
        if counts:
            places = _write_run(news, root, f"v{batch_id}", layout, manifest.buckets, sum(counts.values()))
            manifest.add(places, counts)
    finally:
        news.unpersist()
    _compact(spark, root, f"v{batch_id}-merged", layout, manifest, sorted(counts))
    while manifest.rows > manifest.buckets * layout.bucket_rows:
        manifest.split()
    manifest.forget_unused()
    paths.write_text(spark, f"{root}/manifest/v{batch_id}.json", manifest.text())


def prune_versions(spark: SparkSession, root: str, keep: int = 3) -> None:
    """Remove what only versions older than the last ``keep`` use."""
    known = versions(spark, root)
    if not known:
        return
    kept = known[-keep:]
    used = {folder for version in kept for folder in manifest_of(spark, root, version).folders()}
    runs = {folder.split("/")[0] for folder in used}
    for version in known[:-keep]:
        paths.remove(spark, f"{root}/manifest/v{version}.json")
    for name in paths.list_names(spark, _data(root)):
        if int(name[1:].split("-")[0]) > kept[-1]:
            continue
        if name not in runs:
            paths.remove(spark, _data(root, name))
            continue
        for part in paths.list_names(spark, _data(root, name)):
            if part.startswith(f"{BUCKET}=") and f"{name}/{part}" not in used:
                paths.remove(spark, _data(root, f"{name}/{part}"))
