"""Threshold-scaled sketches of documents. DataFrame functions only.

A sketch retains every shingle hash below a fixed fraction of the hash range. It
grows with its document, so a short text can be looked for in a very long
one, and the sketch of a union is the union of sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.common import SPACE, ranked

SHINGLE = 5
# A hash is the start of an MD5 in hex. Hashes below this are retained: one in four.
DIGITS = 8
BELOW = "4"


def sketch(text: Column, shingle: int = SHINGLE, below: str = BELOW) -> Column:
    """The retained hashes of a text's word shingles as numbers, distinct and in order.

    A text of fewer words than a shingle is one shingle; one without words has none.
    """
    words = F.filter(F.split(text, SPACE), lambda word: word != "")
    # Bound by a lambda, so that the text is split once.
    parts = F.transform(
        F.array(words),
        lambda w: F.when(
            F.size(w) > 0,
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(w) - (shingle - 1), F.lit(1))),
                lambda start: F.md5(F.array_join(F.slice(w, start, shingle), " ")),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )[0]
    kept = F.filter(parts, lambda digest: digest < below)
    numbers = F.transform(kept, lambda digest: F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("int"))
    return F.array_sort(F.array_distinct(numbers))


def merged(sketches: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One sketch per group: that of its texts together."""
    hashes = sketches.select(*keys, F.explode(column).alias(column)).distinct()
    return hashes.groupBy(*keys).agg(F.array_sort(F.collect_list(column)).alias(column))


def containment(part: Column, whole: Column) -> Column:
    """The estimated share of the first text's shingles that the second has; null without hashes."""
    return F.try_divide(F.size(F.array_intersect(part, whole)), F.size(part))


def likeness(one: Column, two: Column) -> Column:
    """The estimated Jaccard likeness of two sketches; 0 if neither retains a hash."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(one, two)), F.size(F.array_union(one, two))), F.lit(0.0))


def fingerprint(text: Column, hashes: Column) -> Column:
    """A hash of the whole text, which tells short texts apart, and the sketch."""
    digits = F.transform(hashes, lambda number: F.lpad(F.lower(F.hex(number)), DIGITS, "0"))
    return F.concat(F.substring(F.md5(text), 1, 16), F.lit(":"), F.array_join(digits, "."))


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    next_doc_id) of every document.

    The edited text has the last third of the code points, rounded down, replaced by as many
    from the start of the next document (all, if it is shorter). Next is the next smaller id,
    and the largest after the smallest. Documents without id come last, rows that share an
    id in the order of a hash of their text, and repeated rows one after the other: a repeat is followed by itself. A
    null text is empty. Other columns are ignored; an empty table gives no rows.

    ``near_edited`` and ``near_next`` are the likeness of the document's sketch to that of
    the edited text and of the next document; texts that are equal have likeness 1.

    Only ids and lengths are put in order. Texts move once, by a hash of id and text, and
    the replacing part of each moves to the document before it. Both sides of that join
    take the same columns, so that Spark shuffles the texts once for both.
    """
    texts = docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"))
    row = F.xxhash64("doc_id", "text")
    third = F.floor(F.col("n") / 3).cast("int")

    # One line per distinct row, in descending order of ids.
    lines = texts.select("doc_id", row.alias("row"), F.length("text").alias("n"))
    lines = lines.groupBy("doc_id", "row", "n").agg(F.count("*").alias("copies"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("row")]
    placed = ranked(lines.select("doc_id", "row", third.alias("third"), "copies"), order, "place", "sketch-order")
    count = placed.agg(F.max("place") + 1).first()[0] or 1
    following = placed.select((F.pmod(F.col("place") - 1, F.lit(count))).alias("_place"), F.col("row").alias("next_row"))
    steps = placed.join(following, F.col("place") == F.col("_place")).select("row", "third", "copies", "next_row")

    # Distinct texts by row; their sketches go along.
    rows = texts.select(row.alias("row"), "doc_id", "text").withColumn("hashes", sketch(F.col("text")))
    first = Window.partitionBy("row").orderBy("row")
    rows = rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    wanted = steps.select(F.col("next_row").alias("_row"), F.col("row").alias("for_row"), "third", "copies")
    lead = rows.join(wanted, F.col("row") == F.col("_row")).select(
        "for_row",
        F.col("doc_id").alias("next_doc_id"),
        "copies",
        F.expr("substring(text, 1, third)").alias("lead"),
        F.substring(F.md5("text"), 1, 16).alias("next_whole"),
        F.col("hashes").alias("next_hashes"),
    )
    pairs = rows.join(lead, F.col("row") == F.col("for_row"))

    # Copies of a row but the last are followed by the same text.
    same = F.struct(
        (F.col("copies") - 1).alias("times"),
        F.expr("substring(text, 1, cast(floor(length(text) / 3) as int))").alias("lead"),
        F.lit(1.0).alias("near_next"),
        F.col("doc_id").alias("next_doc_id"),
    )
    equal = F.substring(F.md5("text"), 1, 16) == F.col("next_whole")
    near_next = F.when(equal, F.lit(1.0)).otherwise(likeness(F.col("hashes"), F.col("next_hashes")))
    last = F.struct(F.lit(1).cast("bigint").alias("times"), F.col("lead"), near_next.alias("near_next"), F.col("next_doc_id"))
    cases = F.when(F.col("copies") > 1, F.array(same, last)).otherwise(F.array(last))
    each = pairs.select("doc_id", "text", "hashes", F.explode(cases).alias("case"))
    kept = "substring(text, 1, cast(length(text) - floor(length(text) / 3) as int))"
    edited = each.withColumn("edited", F.concat(F.expr(kept), F.col("case.lead")))
    edited = edited.withColumn("edited_hashes", sketch(F.col("edited")))
    unchanged = F.col("edited") == F.col("text")
    result = edited.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), F.col("hashes")).alias("fingerprint"),
        fingerprint(F.col("edited"), F.col("edited_hashes")).alias("edited_fingerprint"),
        F.when(unchanged, F.lit(1.0)).otherwise(likeness(F.col("hashes"), F.col("edited_hashes"))).alias("near_edited"),
        F.col("case.near_next").alias("near_next"),
        F.col("case.next_doc_id").alias("next_doc_id"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("case.times"))).alias("_copy"),
    )
    return result.drop("_copy")
