"""Governance rules: each finds one kind of defect and returns the bad rows.

The ``*_when`` functions give the defect as a boolean column, so that a report
can count many rules of a table in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.functions.scalars import ladder
from orebed.operators.skew import as_column, known_values, skew_join


def missing_when(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating-point column (how a missing number may arrive)."""
    missing = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(column)
    return missing


def null_rule(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [missing_when(df, column) for column in columns]))


def future_when(column: str, as_of) -> Column:
    return F.col(column) > F.lit(as_of)


def future_date(df: DataFrame, column: str, as_of) -> DataFrame:
    """Dates after a given day; never the wall clock, so that reruns agree."""
    return df.filter(future_when(column, as_of))


def duplicate_key(df: DataFrame, keys: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key is held by more than one row."""
    return skew_join(df, duplicate_key(df, keys).select(*keys), keys, "left_semi")


def wrong_case_when(column: str, codes: Sequence[str]) -> Column:
    """A code that is in the list only when letter case is ignored."""
    folded = sorted({code.lower() for code in codes})
    return ~F.col(column).isin(list(codes)) & F.lower(column).isin(folded)


def outside_domain_when(column: str, codes: Sequence[str]) -> Column:
    return ~F.col(column).isin(list(codes))


def case_inconsistent(df: DataFrame, column: str, domain: DataFrame | Sequence[str]) -> DataFrame:
    """Codes that are in the domain only when letter case is ignored."""
    values = known_values(domain, limit=10_000)
    if values is not None:
        return df.filter(wrong_case_when(column, values))
    name = domain.columns[0]
    codes = domain.select(F.col(name).alias("_code")).na.drop().distinct()
    folded = codes.select(F.lower("_code").alias("_folded")).distinct()
    marked = df.withColumn("_folded", F.lower(column)).withColumn("_code", F.col(column))
    unknown = skew_join(marked, codes, ["_code"], "left_anti")
    return skew_join(unknown, folded, ["_folded"], "left_semi").select(*df.columns)


def outside_when(column: str, low, high) -> Column:
    return ~F.col(column).between(low, high)


def out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(outside_when(column, low, high))


def zero_while_when(amount: str, condition: Column) -> Column:
    return (F.col(amount) == 0) & condition


def zero_when(df: DataFrame, amount: str, condition: Column) -> DataFrame:
    return df.filter(zero_while_when(amount, condition))


def orphan_fk(df: DataFrame, ref: DataFrame, keys: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows whose key has no match in ``ref``. A mapping names both columns."""
    pairs = dict(keys) if isinstance(keys, Mapping) else {key: key for key in keys}
    known = ref.select(*[F.col(there).alias(here) for here, there in pairs.items()]).distinct()
    return skew_join(df, known, list(pairs), "left_anti").select(*df.columns)


def orphan_count(df: DataFrame, ref: DataFrame, keys: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """How many rows have no match in ``ref`` (one number); counted per key first."""
    pairs = dict(keys) if isinstance(keys, Mapping) else {key: key for key in keys}
    known = ref.select(*[F.col(there).alias(here) for here, there in pairs.items()]).distinct()
    per_key = df.groupBy(*pairs).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.join(known, list(pairs), "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))


def negative_when(column: str) -> Column:
    return F.col(column) < 0


def negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(negative_when(column))


def ends_before_when(start: str, end: str) -> Column:
    return F.col(end) < F.col(start)


def date_order(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.filter(ends_before_when(start, end))


def above_ratio_when(num: Column | str, den: Column | str, max_ratio: float) -> Column:
    """Compared as a product, so that a zero denominator needs no special case."""
    return as_column(num) > as_column(den) * F.lit(float(max_ratio))


def ratio_bound(df: DataFrame, num: Column | str, den: Column | str, max_ratio: float) -> DataFrame:
    return df.filter(above_ratio_when(num, den, max_ratio))


def bucket_differs_when(days: Column | str, stored: str, edges) -> Column:
    return F.col(stored) != ladder(days, edges)


def bucket_mismatch(df: DataFrame, days: Column | str, stored: str, edges) -> DataFrame:
    return df.filter(bucket_differs_when(days, stored, edges))


def sentinel_when(column: str, values: Sequence) -> Column:
    return F.col(column).isin(list(values))


def sentinel(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(sentinel_when(column, values))


def unknown_code(df: DataFrame, column: str, domain: DataFrame | Sequence[str]) -> DataFrame:
    """Codes outside the domain. A null code is the null rule's concern."""
    values = known_values(domain)
    if values is not None:
        return df.filter(F.col(column).isNotNull() & outside_domain_when(column, values))
    codes = domain.select(F.col(domain.columns[0]).alias(column)).distinct()
    return skew_join(df.filter(F.col(column).isNotNull()), codes, [column], "left_anti").select(*df.columns)


def zero_with_activity(
    df: DataFrame, total: str, activity: Column | DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Zero totals although there was activity: a condition, or rows on ``keys``."""
    zeros = df.filter(F.col(total) == 0)
    if isinstance(activity, DataFrame):
        return skew_join(zeros, activity.select(*keys).distinct(), keys, "left_semi").select(*df.columns)
    return zeros.filter(activity)


@dataclass(frozen=True)
class Unique:
    """A key that one row may hold. Counts the rows too many; null is a key like any other."""

    keys: Sequence[str]


@dataclass(frozen=True)
class Known:
    """A key that must be held by a row of another table of the report. Counts the rows whose key is not.

    ``where`` limits the rows of that table. A key with a null part is unknown,
    or left to the null rule with ``null_is_unknown=False`` (as codes are).
    """

    keys: Sequence[str]
    table: str
    ref_keys: Sequence[str] | None = None
    where: Column | None = None
    null_is_unknown: bool = True


@dataclass
class TableChecks:
    """The rules of one table: conditions on a row, rules on keys, and ready counts."""

    table: str
    df: DataFrame
    row_rules: Mapping[str, Column] = field(default_factory=dict)
    # Anything else: a one-row frame with one number each.
    counted: Mapping[str, DataFrame] = field(default_factory=dict)
    key_rules: Mapping[str, Unique | Known] = field(default_factory=dict)


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows would have to go for the key to be unique (one number)."""
    return duplicate_key(df, keys).agg(F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("n"))


def _key_columns(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """Where the parts of a key go in a tag: whole numbers to k0, k1, ..., the rest as text to s0, s1, ..."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    places: dict[str, Column] = {}
    for key in keys:
        letter, kind = ("k", "bigint") if isinstance(df.schema[key].dataType, whole) else ("s", "string")
        number = sum(place[0] == letter for place in places)
        places[f"{letter}{number}"] = F.col(key).cast(kind)
    return places


def _kinds(df: DataFrame, keys: Sequence[str]) -> list[str]:
    kinds = [df.schema[key].dataType for key in keys]
    return [place if place[0] == "k" else kind.simpleString() for place, kind in zip(_key_columns(df, keys), kinds)]


@dataclass
class _Space:
    """The keys of one table that rules of several tables look at, or the row rules of a table."""

    number: int
    users: int = 0


@dataclass
class _Tag:
    """What a row adds: one to some slots of a key. Slot 0 counts the rows that hold the key."""

    space: _Space
    slots: Mapping[int, Column]
    key: Mapping[str, Column] = field(default_factory=dict)
    when: Column | None = None

    def struct(self, places: Sequence[str], width: int) -> Column:
        key = [self.key.get(place, F.lit(None).cast("bigint" if place[0] == "k" else "string")) for place in places]
        counts = [self.slots.get(slot, F.lit(0)).cast("bigint").alias(f"n{slot}") for slot in range(width)]
        made = F.struct(
            F.lit(self.space.number).alias("space"), *[part.alias(place) for part, place in zip(key, places)], *counts
        )
        return made if self.when is None else F.when(self.when, made)


def _keyed_counts(checks: Sequence[TableChecks]) -> DataFrame:
    """Row and key rules of tables that key rules look at, with one scan of each and one exchange.

    Each row becomes a tag per key it holds or looks up, and one if it breaks a row
    rule. Tags are added up per key before and after the exchange, so a key on
    many rows is a few rows there, and duplicates and unknown keys of all tables
    come from the same sums.
    """
    frames = {check.table: check.df for check in checks}
    spaces: dict[tuple, _Space] = {}
    tags: dict[str, list[_Tag]] = {name: [] for name in frames}
    lines: list[tuple[str, str, Column]] = []

    def one(slot: int) -> dict[int, Column]:
        return {slot: F.lit(1)}

    def space_of(table: str, keys: Sequence[str], where: Column | None) -> _Space:
        name = (table, tuple(keys), str(where))
        if name not in spaces:
            spaces[name] = _Space(len(spaces))
            tags[table].append(_Tag(spaces[name], one(0), _key_columns(frames[table], keys), where))
        return spaces[name]

    def add_line(table: str, rule: str, space: _Space, counted: Column, when: Column | None = None) -> None:
        here = F.col("space") == space.number
        lines.append((table, rule, F.when(here if when is None else here & when, counted)))

    holders = F.col("n0")
    for check in checks:
        if check.row_rules:
            space = spaces.setdefault((check.table,), _Space(len(spaces), len(check.row_rules) - 1))
            broken = {slot: F.coalesce(when, F.lit(False)) for slot, when in enumerate(check.row_rules.values())}
            slots = {slot: when.cast("int") for slot, when in broken.items()}
            tags[check.table].append(_Tag(space, slots, when=reduce(lambda a, b: a | b, broken.values())))
            for slot, name in enumerate(check.row_rules):
                add_line(check.table, name, space, F.col(f"n{slot}"))
        for name, rule in check.key_rules.items():
            if isinstance(rule, Unique):
                add_line(check.table, name, space_of(check.table, rule.keys, None), holders - 1, holders > 1)
                continue
            there = rule.ref_keys or rule.keys
            kinds, known = _kinds(check.df, rule.keys), _kinds(frames[rule.table], there)
            if kinds != known:
                raise ValueError(f"{check.table}.{name}: keys of types {kinds} are looked up among {known}")
            space = space_of(rule.table, there, rule.where)
            space.users += 1
            key = _key_columns(check.df, rule.keys)
            tags[check.table].append(_Tag(space, one(space.users), key))
            null = reduce(lambda a, b: a | b, [F.col(place).isNull() for place in key])
            unknown = (null | (holders == 0)) if rule.null_is_unknown else (~null & (holders == 0))
            add_line(check.table, name, space, F.col(f"n{space.users}"), unknown)
    places = sorted({place for made in tags.values() for tag in made for place in tag.key})
    width = 1 + max(space.users for space in spaces.values())
    parts = [
        df.select(F.inline(F.array(*[tag.struct(places, width) for tag in tags[table]]))).filter("space IS NOT NULL")
        for table, df in frames.items()
        if tags[table]
    ]
    per_key = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("space", *places)
        .agg(*[F.sum(f"n{slot}").alias(f"n{slot}") for slot in range(width)])
    )
    totals = per_key.agg(*[F.coalesce(F.sum(value), F.lit(0)).alias(f"r{i}") for i, (_, _, value) in enumerate(lines)])
    return totals.select(F.inline(F.array(*[_line(table, rule, f"r{i}") for i, (table, rule, _) in enumerate(lines)])))


def _line(table: str, rule: str, number: str) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.col(number).alias("n_violations"))


def dq_report(checks: Sequence[TableChecks], total: str | None = None) -> DataFrame:
    """Violations per table and rule; ``total`` names an extra line over all.

    Key rules name their tables by the ``table`` of a check. Each table is read once.
    """
    rules = [rule for check in checks for rule in check.key_rules.values()]
    looked_at = {rule.table for rule in rules if isinstance(rule, Known)}
    keyed = [check for check in checks if check.key_rules or check.table in looked_at]
    parts: list[DataFrame] = [_keyed_counts(keyed)] if keyed else []
    for check in checks:
        if check.row_rules and not any(check is other for other in keyed):
            names = list(check.row_rules)
            counts = check.df.agg(*[F.count_if(check.row_rules[name]).alias(f"r{i}") for i, name in enumerate(names)])
            parts.append(counts.select(F.inline(F.array(*[_line(check.table, name, f"r{i}") for i, name in enumerate(names)]))))
        for name, number in check.counted.items():
            value = F.col(number.columns[0]).cast("bigint").alias("n_violations")
            parts.append(number.select(F.lit(check.table).alias("table_name"), F.lit(name).alias("rule"), value))
    report = reduce(DataFrame.unionByName, parts)
    if total is None:
        return report
    line = F.col("line")
    return (
        report.rollup(F.struct("table_name", "rule").alias("line"))
        .agg(F.sum("n_violations").alias("n_violations"))
        .select(
            F.coalesce(line["table_name"], F.lit(total)).alias("table_name"),
            F.coalesce(line["rule"], F.lit(total)).alias("rule"),
            "n_violations",
        )
    )
