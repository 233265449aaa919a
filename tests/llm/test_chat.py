import random
from collections import Counter
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from orebed.llm import chat
from orebed.llm.chat import format_conversations
from orebed.llm.common import settings, stored
from orebed.llm.queries import REGISTRY

ROLES = ["system", "user", "assistant", "tool", None]
NEXT = {None: ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]}


def least(roles):
    """The least cost of a repair, by trying everything: shortest paths over (turns taken, last role)."""
    import heapq

    known = {"system", "user", "assistant"}
    relabel = lambda old, new: 0 if old == new else (4 if old in known else 1)
    heap, done = [(0, 0, "")], set()
    while heap:
        cost, taken, last = heapq.heappop(heap)
        if (taken, last) in done:
            continue
        done.add((taken, last))
        if taken == len(roles) and last in ("assistant",):
            return cost
        for new in NEXT[last or None]:
            heapq.heappush(heap, (cost + 3, taken, new))
            if taken < len(roles):
                heapq.heappush(heap, (cost + relabel(roles[taken], new), taken + 1, new))
        if last and taken < len(roles):
            heapq.heappush(heap, (cost + 1 + relabel(roles[taken], last), taken + 1, last))


def check(rows):
    """The rows of one conversation in order: legal when rendered, and their cost."""
    rows = sorted(rows, key=lambda r: (r.block, r.seq))
    text = "".join(r.rendered for r in rows)
    turns = [part.split("|>\n", 1) for part in text.split("<|end|>\n")]
    assert turns[-1] == [""]
    names = [name.removeprefix("<|") for name, _ in turns[:-1]]
    last = None
    for name in names:
        assert name in NEXT[last]
        last = name
    assert last == "assistant"
    assert sum(not body for _, body in turns[:-1]) >= sum(r.inserted for r in rows) - 0
    cost = sum(r.inserted * 3 + ("merge" in r.action) for r in rows)
    cost += sum(("relabel" in r.action) * (4 if r.role in ("system", "user", "assistant") else 1) for r in rows)
    opened = sum("merge" not in r.action for r in rows) + sum(r.inserted for r in rows)
    assert opened == len(names)
    return cost, turns


@pytest.mark.parametrize("block", [512, 2])
def test_least_cost(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rng = random.Random(block)
    convs = {i: [rng.choice(ROLES) for _ in range(rng.randrange(1, 12))] for i in range(150)}
    convs[500] = ["user"] * 700
    convs[501] = ["system", "system", "assistant", "assistant"]
    convs[None] = ["user", "assistant"]
    rows = [(c, t, r, f"text {c} {t}") for c, roles in convs.items() for t, r in enumerate(roles)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("block", F.lit("x"))
    found = format_conversations(df).collect()
    assert len(found) == len(rows)
    key = lambda r: (r.conv_id is None, r.conv_id)
    for _, group in groupby(sorted(found, key=lambda r: (r.conv_id is None, r.conv_id or 0)), key=key):
        group = list(group)
        conv = group[0].conv_id
        cost, turns = check(group)
        assert cost == least(convs[conv])
        bodies = "\n\n".join(body for _, body in turns[:-1] if body).split("\n\n")
        assert bodies == [f"text {conv} {t}" for t in range(len(convs[conv]))]


@pytest.mark.parametrize("block", [512, 3])
def test_no_block_grows_with_rows_that_share_a_turn(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rows = [(None, t, r, f"{r} {t} {i}") for t in range(5) for r in ROLES[1:4] for i in range(80)]
    rows += [(7, None, "user", "same")] * 900 + [(8, 3, "assistant", f"{i}") for i in range(700)]
    rows += [(i, 0, "user", "short") for i in range(10, 100)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = format_conversations(df).collect()
    assert Counter((r.conv_id, r.turn, r.role) for r in found) == Counter(row[:3] for row in rows)
    assert max(Counter(r.block for r in found).values()) <= block
    wanted = {None: [r for _ in range(5) for r in ROLES[1:4] for _ in range(80)], 7: ["user"] * 900, 8: ["assistant"] * 700, 10: ["user"]}
    for conv, roles in wanted.items():
        assert check([r for r in found if r.conv_id == conv])[0] == least(roles)


def test_rows_that_tie_go_to_many_partitions(spark, monkeypatch):
    written = []
    monkeypatch.setattr(chat, "stored", lambda df, label: written.append(stored(df, label)) or written[-1])
    rows = [(None, None, "user", "same")] * 3000 + [(i, 0, "user", "short") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}):
        placed = chat._ordered(df)
    parts = Counter(r.at >> chat.WITHIN for r in written[0].select("at").collect())
    assert sorted(r.place for r in placed.select("place").collect()) == list(range(6000))
    assert max(parts.values()) < 1500


def test_odd_rows(spark):
    rows = [(1, None, "user", "null turn"), (1, 0, " USER ", None), (1, 0, "assistant", ""), (1, 1, "user", "a<|end|>b"),
            (1, 1, "user", "a<|end|>b"), (2, -5, None, None), (3, 2**40, "system", "x" * 100_000), (4, 7, "", "blank role")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = format_conversations(df).collect()
    assert len(found) == len(rows)
    for conv in (1, 2, 3, 4):
        check([r for r in found if r.conv_id == conv])
    assert "a< |end|>b" in "".join(r.rendered for r in found)
    assert format_conversations(df.limit(0)).count() == 0


def test_query(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    found = REGISTRY["op3_chat_format"](spark, sf_dir).collect()
    assert len(found) == len(turns)
    convs, parts = {}, {}
    for row in sorted(turns, key=lambda r: (r.conv_id, r.turn)):
        convs.setdefault(row.conv_id, []).append(row.role)
    for row in found:
        parts.setdefault(row.conv_id, []).append(row)
    for conv, roles in convs.items():
        assert check(parts[conv])[0] == least(roles)
