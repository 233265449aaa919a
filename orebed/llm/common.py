"""What several text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orebed.session import fresh_dir

# A word is a run of anything but the six ASCII white-space characters;
# ``bytes.split()`` cuts at the same places.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

# Spark's setting to remove a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime settings for the work inside, put back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stored(df: DataFrame, label: str, path: str | None = None, apart: Sequence[str] = (), **options: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Cuts the lineage: what follows reads files that outlive any executor, and
    expensive work above is done once. The shuffles of the write serve nothing
    else, so their files go at its end. A caller that names the ``path`` may remove it
    once nothing reads it; rows that differ in ``apart`` get folders of their own.
    """
    spark = df.sparkSession
    path = path or fresh_dir(spark, label)
    with settings(spark, {CLEANUP: "true"}):
        df.write.options(**options).partitionBy(*apart).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str = "text") -> Column:
    """The text as UTF-8 bytes; a null text is empty."""
    return F.coalesce(df[text].cast("binary"), F.lit(b""))


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether a row belongs to the fold kept from training; a null key does not."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int, max_chars: int
) -> list[tuple[bytes, int]]:
    """``per_class`` labelled texts of each class, fewer only where there are no more.

    Picked by a hash of the id among the ids that ``docs`` has; those with a text of at
    most ``max_chars`` come first, and a longer text is taken as a piece of that
    length from a place its hash decides. Of several texts with one id the
    shorter kind, then the least by hash, is taken; rows with contradicting labels
    count with the larger one. Only the texts picked move.
    """
    usable = labels.filter(train & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    ids = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    texts = docs.filter(docs["doc_id"].isNotNull()).select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))
    texts = texts.withColumn("_long", F.length("text") > max_chars)
    there = ids.join(texts.groupBy("doc_id").agg(F.min("_long").alias("_long")), "doc_id")
    ordered = [F.col("_long"), F.xxhash64("doc_id"), F.col("doc_id")]
    picks = [there.filter(F.col("_label") == value).orderBy(*ordered).limit(per_class) for value in (0, 1)]
    chosen = picks[0].unionByName(picks[1]).select("doc_id", "_label")  # at most 2 * per_class narrow rows
    seed = F.xxhash64("text")
    start = F.when(F.col("_long"), F.pmod(seed, F.length("text") - max_chars + 1)).otherwise(0).cast("int") + 1
    pieces = F.struct("_long", seed.alias("_seed"), F.substring("text", start, F.lit(max_chars)).alias("_piece"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_label").agg(F.min(pieces).alias("_one"))
    rows = found.select("doc_id", "_label", "_one._piece").orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * per_class).collect()
    return [(row["_piece"].encode(), row["_label"]) for row in rows]


def by_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | None]):
    """A function over one Arrow batch as a ``mapInArrow`` function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (result := work(batch)) is not None:
                yield result

    return run


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(word, seed) for word in words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit affects every output bit."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive word hashes."""
    count = len(words) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(count, np.uint64)
        for place in range(length):
            total = total * np.uint64(0x9E3779B97F4A7C15) + words[place : place + count]
    return mix(total + np.uint64(length))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def ranked(df: DataFrame, order: Sequence[Column], name: str, label: str) -> DataFrame:
    """The frame with a column ``name``: the place of each row in the order, from 0.

    Rows are dealt to partitions by ranges of the order and written, so that the
    ranges hold; rows are numbered within each and the partitions' counts,
    one row per partition, give the number to start from.
    """
    part = free_name(df, "_part")
    dealt = stored(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), label)
    counts = dealt.groupBy(part).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumnRenamed(part, "_p").select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    numbered = dealt.withColumn(name, within.cast("bigint")).join(starts, F.col(part) == F.col("_p"))
    return numbered.select(*df.columns, (F.col(name) + F.col("_before")).alias(name))
