"""Secrets in text: regex rules behind a trigram index. DataFrame functions only."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """What to look for: a pattern, and the least length of one of its groups (0: the match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The rules every scan has, in their order of rank.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    # A maximal run of 24 and more, so that shorter runs need not be matched first.
    Rule("hex", "[0-9a-f]{24,}", least=24),
)
# Well-known credential formats.
MORE_RULES = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

# A Boolean query in disjunctive form: any clause whose trigrams all occur.
Query = list[frozenset[str]]
ANY: Query = [frozenset()]
# No more literal strings than this are carried on at a time.
MAX_STRINGS = 64


def trigram_query(pattern: str) -> Query:
    """Clauses of lower-case trigrams, one of which occurs in full in any lower-cased match.

    An empty clause means that the pattern demands no trigram.
    """
    strings, query = _concat(re._parser.parse(pattern))
    return _simple(_both(query, _of_strings(strings)))


def _simple(query: Query) -> Query:
    kept = [one for one in set(query) if not any(other < one for other in query)]
    return sorted(kept, key=lambda clause: sorted(clause))


def _both(one: Query, two: Query) -> Query:
    return _simple([a | b for a, b in product(one, two)])


def _of_strings(strings: set[str]) -> Query:
    return _simple([frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings])


def _concat(nodes) -> tuple[set[str], Query]:
    """Literal strings the part ends with, and what must occur besides."""
    strings, query = {""}, ANY
    for node in nodes:
        exact, must = _node(node)
        query = _both(query, must)
        joined = {a + b for a, b in product(strings, exact)} if exact is not None else set()
        if exact is None or len(joined) > MAX_STRINGS:
            query = _both(query, _of_strings(strings))
            strings = {""}
        else:
            strings = joined
    return strings, query


def _node(node) -> tuple[set[str] | None, Query]:
    """All strings the node can match, or None if unknown or many, and what must occur besides."""
    name, value = str(node[0]), node[1]
    if name == "LITERAL":
        return {chr(value).lower()}, ANY
    if name == "IN" and all(str(part[0]) == "LITERAL" for part in value):
        return {chr(part[1]).lower() for part in value}, ANY
    if name == "SUBPATTERN":
        return _part(value[3])
    if name == "BRANCH":
        parts = [_part(branch) for branch in value[1]]
        if all(strings is not None and must == ANY for strings, must in parts):
            return set().union(*(strings for strings, _ in parts)), ANY
        needs = [_both(must, _of_strings(strings) if strings is not None else ANY) for strings, must in parts]
        return None, _simple([clause for need in needs for clause in need])
    if name == "MAX_REPEAT":
        low, high, body = value
        strings, must = _part(body)
        if (low, high) == (0, 1) and strings is not None and must == ANY:
            return strings | {""}, ANY
        if low == 0:
            return None, ANY
        return None, _both(must, _of_strings(strings) if strings is not None else ANY)
    return None, ANY


def _part(nodes) -> tuple[set[str] | None, Query]:
    """A nested part: its strings if it is literal throughout, else what it demands."""
    exact = {""}
    for node in nodes:
        strings, must = _node(node)
        if strings is None or must != ANY or len(exact) * len(strings) > MAX_STRINGS:
            tail, query = _concat(nodes)
            return None, _both(query, _of_strings(tail))
        exact = {a + b for a, b in product(exact, strings)}
    return exact, ANY


def postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """The inverted index (trigram, row) of the given lower-case trigrams; ``row`` is the hash of id and text."""
    lowered = docs.select(_row(docs).alias("row"), F.lower("text").alias("low"))
    hits = F.array(*[F.when(F.contains("low", F.lit(trigram)), F.lit(trigram)) for trigram in trigrams])
    return lowered.select("row", F.explode(hits).alias("trigram")).filter("trigram IS NOT NULL")


def _row(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"], docs["text"])


def candidates(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(row, kinds): the rules whose Boolean trigram query a document meets, by intersecting postings."""
    wanted = [
        (rule.kind, number, trigram, len(clause))
        for rule in rules
        for number, clause in enumerate(trigram_query(rule.pattern))
        for trigram in sorted(clause)
    ]
    # As long as the rules are; unrelated to the data.
    schema = "kind string, clause int, trigram string, size int"
    clauses = F.broadcast(docs.sparkSession.createDataFrame(wanted, schema))
    # Repeated rows repeat their postings, so each trigram counts once; a clause may have any number of them.
    index = postings(docs, sorted({trigram for _, _, trigram, _ in wanted}))
    met = index.join(clauses, "trigram").groupBy("row", "kind", "clause", "size", "trigram").agg(F.count("*").alias("n"))
    met = met.groupBy("row", "kind", "clause", "size").agg(F.count("*").alias("n")).filter("n = size")
    return met.groupBy("row").agg(F.collect_set("kind").alias("kinds"))


def _running(lengths: Column, block: int = 256) -> Column:
    """For each length the sum of those before it. By blocks, so that long lists stay cheap."""
    zero = F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<bigint>").alias("sums"))

    def within(part: Column) -> Column:
        return F.aggregate(
            part,
            zero,
            lambda acc, x: F.struct(
                (acc["total"] + x).alias("total"), F.concat(acc["sums"], F.array(acc["total"])).alias("sums")
            ),
        )

    starts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(block))
    blocks = F.transform(starts, lambda start: within(F.slice(lengths, start, block)))
    lists = F.array().cast("array<array<bigint>>")
    total = F.aggregate(
        blocks,
        F.struct(F.lit(0).cast("bigint").alias("total"), lists.alias("lists")),
        lambda acc, part: F.struct(
            (acc["total"] + part["total"]).alias("total"),
            F.concat(acc["lists"], F.array(F.transform(part["sums"], lambda x: x + acc["total"]))).alias("lists"),
        ),
    )
    return F.flatten(total["lists"])


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """Leftmost matches that do not overlap, as array<struct<start, rank, end, kind>> in code points.

    The text between matches and the matches themselves alternate, so their lengths add up to places.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found))
    gap, long = F.transform(gaps, F.length), F.transform(found, F.length)
    before = _running(F.transform(F.arrays_zip(gap.alias("g"), long.alias("m")), lambda x: (x["g"] + x["m"]).cast("bigint")))
    places = F.arrays_zip(before.alias("b"), gap.alias("g"), long.alias("m"), F.transform(group, F.length).alias("n"))
    kept = F.filter(places, lambda x: x["n"] >= rule.least)
    return F.transform(
        kept,
        lambda x: F.struct(
            (x["b"] + x["g"]).alias("start"),
            F.lit(rank).alias("rank"),
            (x["b"] + x["g"] + x["m"]).alias("end"),
            F.lit(rule.kind).alias("kind"),
        ),
    )


SPANS = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, spans) of every document: all matches by start, then in the order of the rules.

    Texts are scanned whole; a null text is empty. Repeated rows give repeated
    rows, null ids stay. Other columns are ignored. Places are code points, the end exclusive.

    Each rule's pattern gives a Boolean query over trigrams that any match must
    contain. An inverted index of just these trigrams is intersected, and only the
    documents that meet a rule's query are matched against its pattern. Rules
    that demand no trigram look at every document.
    """
    full = [rule.kind for rule in rules if frozenset() in trigram_query(rule.pattern)]
    indexed = [rule for rule in rules if rule.kind not in full]
    rows = docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", _row(rows).alias("row"))
    if indexed:
        picked = candidates(rows, indexed).withColumnRenamed("row", "_row")
        rows = rows.join(picked, F.col("row") == F.col("_row"), "left")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    parts = []
    for rank, rule in enumerate(rules):
        due = F.lit(True) if rule.kind in full else F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        spans = matches(F.col("text"), rule, rank).cast(SPANS)
        parts.append(F.when(due & F.col("text").rlike(rule.pattern), spans).otherwise(F.array().cast(SPANS)))
    return rows.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
