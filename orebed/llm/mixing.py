"""Mixing sources to target weights by capped water-filling. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.common import SPACE, WORD, ranked, stored

# Documents of a source are drawn in the order of a hash; this many hex digits of it make a bucket.
BUCKET_DIGITS = 3


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) of (source, source_size) rows.

    Sources in code point order, null last, take the weights in turn. Together
    they are to have ``share`` times all sizes, each at most ``cap`` times its
    own. A source above its cap is clamped and its excess goes to the others by
    weight, until none is above; each round needs two sums from the cluster.
    """
    order = [F.col("source").asc_nulls_last()]
    place = ranked(sizes, order, "place", "sources")
    turn = F.element_at(F.array(*[F.lit(weight) for weight in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = stored(place.select("source", "source_size", turn.alias("weight")), "weights")
    most = F.lit(float(cap)) * F.col("source_size")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") >= most if capped >= 0 else F.lit(False)
        spent, number, open_weight = rows.agg(
            F.coalesce(F.sum(F.when(above, most)), F.lit(0.0)),
            F.count(F.when(above, F.lit(1))),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if not open_weight or number == capped:
            break
        level, capped = (share * total - spent) / open_weight, number
    target = most if not open_weight else F.least(most, F.lit(level) * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _taken(docs: DataFrame, weights: Sequence[float], share: float, cap: float, seed: int) -> DataFrame:
    """The documents with _size, _source_size, _target, _times and _extra."""
    draw = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(f":{seed}")))
    bucket = F.substring(draw, 1, BUCKET_DIGITS)
    rows = docs.withColumns({"_size": _size(F.col("text")), "_draw": draw, "_bucket": bucket})
    sums = stored(rows.groupBy("source", "_bucket").agg(F.sum("_size").alias("sum")), "buckets")
    targets = source_targets(sums.groupBy("source").agg(F.sum("sum").alias("source_size")), weights, share, cap)
    targets = targets.withColumnRenamed("source", "_s")
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    left = F.round(F.col("target") - (F.col("_times") * F.col("source_size")).cast("double")).cast("bigint")
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    budgets = (
        sums.withColumn("_before", F.coalesce(F.sum("sum").over(before), F.lit(0)))
        .join(targets, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("_times", times)
        .select(
            "_s",
            F.col("_bucket").alias("_b"),
            F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"),
            "_times",
            (left - F.col("_before")).alias("_room"),
        )
    )
    # Drawn so far within the bucket; buckets hold a 4,096th of a source.
    ahead = Window.partitionBy("source", "_bucket").orderBy("_draw", "doc_id", "_size")
    drawn = F.coalesce(F.sum("_size").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = rows.withColumn("_drawn", drawn).join(
        budgets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b"))
    )
    extra = F.greatest(F.lit(0), F.least(F.col("_size"), F.col("_room") - F.col("_drawn")))
    return joined.withColumn("_extra", extra)


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 17
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document.

    ``size`` counts the words of the whole text (null: none), ``target`` is what the
    document's source shall have, ``taken`` how many words the mix takes from the
    document, repeats counted. All documents of a source are taken as many whole
    times as fit in its target. For the rest the source's documents are drawn in the
    order of a seeded hash of their ids until the target is met; the last drawn
    is taken in part, so a source's taken words are its target rounded.

    Null sources make one source, which comes last. Documents without words take part with
    size 0; a source of only such has target 0. Rows that share an id are drawn by size. Repeated
    rows give repeated rows. Other columns are ignored. Results depend on ids, sizes, sources and seed alone.

    Draws are summed per source and bucket of the hash, so that no task meets all of a large source.
    """
    taken = _taken(docs.select("doc_id", "text", "source"), weights, share, cap, seed)
    return taken.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_times") * F.col("_size") + F.col("_extra")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 17
) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: repeats are repeated rows.

    Where a document is taken in part, that row's text is its leading words
    joined by one space, and ``n_chars``, if there, is the length of these. Documents
    without words are neither wanted nor unwanted by any target and come once.
    """
    names = docs.columns
    inner = docs.select(*[F.col(name).alias(f"c{place}") for place, name in enumerate(names)])
    own = {name: f"c{place}" for place, name in enumerate(names)}
    rows = inner.withColumns({name: F.col(own[name]) for name in ("doc_id", "text", "source")})
    taken = _taken(rows, weights, share, cap, seed)
    whole = F.col("_times") + F.when(F.col("_size") == 0, 1 - F.col("_times")).when(F.col("_extra") == F.col("_size"), 1).otherwise(0)
    pieces = F.array_repeat(F.lit(-1).cast("bigint"), whole.cast("int"))
    part = (F.col("_extra") > 0) & (F.col("_extra") < F.col("_size"))
    pieces = F.concat(pieces, F.when(part, F.array("_extra")).otherwise(F.array().cast("array<bigint>")))
    copies = taken.withColumn("_piece", F.explode(pieces))
    words = F.filter(F.split("text", SPACE), lambda word: word != "")
    cut = F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("_piece"), F.lit(0)).cast("int")), " ")
    copies = copies.withColumn("_cut", F.when(F.col("_piece") >= 0, cut))
    result = {name: F.col(own[name]) for name in names}
    result["text"] = F.coalesce("_cut", F.col(own["text"]))
    if "n_chars" in own:
        kind = docs.schema["n_chars"].dataType
        result["n_chars"] = F.when(F.col("_piece") >= 0, F.length("_cut")).otherwise(F.col(own["n_chars"])).cast(kind)
    return copies.select(*[result[name].alias(name) for name in names])
