"""Sharding by weighted rendezvous hashing of record keys. DataFrame functions only.

Each shard draws a number for each key, and the key goes to the shard with the
cheapest draw. A draw depends on the key, the shard's number and its weight
alone, so a new shard only takes keys for itself, and a shard that goes only
gives its own away.

Defined results: a null key is the key ``none``; a null text is empty; equal keys
share a shard, so a key on a third of all rows makes its shard that much larger;
repeated rows get a slot each; an empty table gives none. Other columns stay as
they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.common import free_name, stored

# A digest of 64 hex digits serves four shards; 13 digits of each quarter make a draw of 52 bits.
LANES = 4
LANE_DIGITS = 16
DRAW_DIGITS = 13
# Every record counts so many bytes besides its text.
RECORD_BYTES = 16
# Equal rows are numbered together, up to so many at a time.
RUN = 4096


def draws(key: Column, weights: Sequence[float]) -> Column:
    """An array of (cost, shard), one for each shard; the least cost wins.

    With ``u`` uniform in (0, 1), ``-ln(u) / weight`` is an exponential waiting
    time, so a shard wins in proportion to its weight.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    name = F.coalesce(key.cast("string"), F.lit("none"))
    shares = F.lit([float(weight) for weight in weights])
    blocks = F.sequence(F.lit(0), F.lit((len(weights) - 1) // LANES))
    digests = F.transform(blocks, lambda block: F.sha2(F.concat_ws(":", name, block.cast("string")), 256))

    def lane(digest: Column, block: Column, place: int) -> Column:
        shard = block * LANES + place
        digits = F.substring(digest, place * LANE_DIGITS + 1, DRAW_DIGITS)
        u = (F.conv(digits, 16, 10).cast("bigint") + 0.5) / F.lit(float(16**DRAW_DIGITS))
        return F.struct((-F.log(u) / F.get(shares, shard)).alias("cost"), shard.cast("int").alias("shard"))

    dealt = F.transform(digests, lambda digest, block: F.array(*[lane(digest, block, place) for place in range(LANES)]))
    return F.slice(F.flatten(dealt), 1, len(weights))


def winner(drawn: Column, shards: int | None = None) -> Column:
    """The shard with the least cost, of the first ``shards`` if given."""
    return F.array_min(drawn if shards is None else F.slice(drawn, 1, shards))["shard"]


def with_shard(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", name: str = "shard") -> DataFrame:
    """All rows with their shard from 0. Nothing moves; a column of that name is replaced."""
    return docs.withColumn(name, winner(draws(F.col(key), weights)))


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], key: str = "doc_id", name: str = "shard") -> None:
    """The rows as Parquet below ``path``, a folder ``<name>=<number>`` for each shard.

    Rows are dealt by ranges of shard, key and content, so that a large shard is
    written by many tasks. ``name`` must not be a column yet.
    """
    if name in docs.columns:
        raise ValueError(f"{name} is a column already")
    placed = with_shard(docs, weights, key, name)
    content = F.xxhash64(*[F.col(column) for column in docs.columns if not docs.schema[column].dataType.typeName() == "map"])
    placed.repartitionByRange(name, F.col(key), content).write.partitionBy(name).parquet(path)


def shard_list(docs: DataFrame, weights: Sequence[float], grown: Sequence[float], text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row.

    Slots number a shard's rows from 0 by doc_id (null first), checksum and size.
    ``grown`` holds the weights after the change; they begin with ``weights``.
    Only these narrow columns move. Equal rows are counted before that and numbered
    together; ranges of the order are numbered apart, each from the sum of those
    before it, so neither a large shard nor a hot key meets in one task.
    """
    if list(grown[: len(weights)]) != list(weights):
        raise ValueError("the grown weights must begin with the present ones")
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    narrow = docs.select(
        "doc_id", (F.octet_length(raw) + RECORD_BYTES).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    counted = narrow.groupBy(*narrow.columns).agg(F.count("*").alias("_n"))
    drawn = counted.withColumn("_draws", draws(F.col("doc_id"), grown))
    placed = drawn.select(
        *counted.columns,
        winner(F.col("_draws"), len(weights)).alias("shard"),
        winner(F.col("_draws")).alias("grown_shard"),
        F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {RUN}"))).alias("_run"),
    )
    runs = placed.withColumn("_n", F.least(F.lit(RUN), F.col("_n") - F.col("_run") * RUN).cast("int"))
    order = ["doc_id", "text_crc32", "size", "_run"]
    dealt = stored(runs.repartitionByRange("shard", *order).withColumn("_part", F.spark_partition_id()), "shards")

    before = Window.partitionBy("_shard").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(F.col("shard").alias("_shard"), F.col("_part").alias("_p")).agg(F.sum("_n").alias("_sum"))
    starts = sums.select("_shard", "_p", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = dealt.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    numbered = numbered.join(starts, (F.col("shard") == F.col("_shard")) & (F.col("_part") == F.col("_p")))
    each = numbered.withColumn("_each", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return each.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("_start") + F.col("_before") + F.col("_each")).cast("bigint").alias("slot"),
        "grown_shard",
    )
