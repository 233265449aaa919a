"""Column helpers. All stay inside Spark's expression engine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The accepted form of an email address, and the days-past-due
# buckets with the highest day count of each (the last one is open).
EMAIL_PATTERN = r"^([a-zA-Z0-9_\-\.]+)@([a-zA-Z0-9_\-\.]+)\.([a-zA-Z]{2,5})$"
DPD_EDGES = [("Al_Dia", 0), ("1-30", 30), ("31-60", 60), ("61-90", 90), ("Mayor_90", None)]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def valid_email(value: Column | str) -> Column:
    return _col(value).rlike(EMAIL_PATTERN)


def epoch_to_ts(value: Column | str, mode: str = "seconds") -> Column:
    """Epoch seconds to a timestamp; ``seconds`` cuts fractions, ``exact`` keeps them."""
    if mode == "seconds":
        return F.timestamp_seconds(_col(value).cast("bigint"))
    if mode == "exact":
        return F.timestamp_micros(F.round(_col(value) * 1_000_000).cast("bigint"))
    raise ValueError(f"unknown mode {mode!r}")


def to_ts(value: Column | str, mode: str = "strict") -> Column:
    """Text to a timestamp; ``strict`` fails on bad text, ``lenient`` gives null."""
    if mode == "strict":
        return _col(value).cast("timestamp")
    if mode == "lenient":
        return _col(value).try_cast("timestamp")
    raise ValueError(f"unknown mode {mode!r}")


def iso_text(value: Column | str) -> Column:
    return F.date_format(_col(value), "yyyy-MM-dd'T'HH:mm:ss")


def slug(value: Column | str) -> Column:
    return F.regexp_replace(F.lower(_col(value)), "[^a-z0-9]", "_")


def user_slug() -> Column:
    """The current user's name before any ``@``, as a slug."""
    return slug(F.split_part(F.current_user(), F.lit("@"), F.lit(1)))


def padded_id(prefix: str, value: Column | str, width: int) -> Column:
    """``prefix`` and the number, zero-padded; longer numbers keep all digits."""
    text = _col(value).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def text_prefix(value: Column | str, length: int) -> Column:
    return F.substring(_col(value), 1, length)


def map_default(value: Column | str, mapping: Mapping, default) -> Column:
    """Look a value up in a fixed mapping."""
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[_col(value)], F.lit(default))


def ladder(value: Column | str, edges: Sequence[tuple[str, float | None]]) -> Column:
    """The name of the first step whose upper edge is not below the value."""
    value = _col(value)
    result = F.when(value.isNull(), None)
    for name, upper in edges:
        result = result.when(F.lit(True) if upper is None else value <= upper, F.lit(name))
    return result


def calendar(spark: SparkSession, start: str, end: str, name: str = "day") -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    return spark.range(1).select(F.explode(days).alias(name))


def on_calendar(
    counts: DataFrame, day: str, start: str | None = None, end: str | None = None, zero: Sequence[str] = ()
) -> DataFrame:
    """Daily rows with every day of the range present; missing numbers are 0.

    Without bounds the range goes from the first day of the rows to the last.
    """
    if start is None or end is None:
        first, last = counts.agg(F.min(day).cast("string"), F.max(day).cast("string")).first()
        start, end = start or first, end or last
    days = calendar(counts.sparkSession, start, end, day)
    return days.join(counts, day, "left").na.fill(0, list(zero))
