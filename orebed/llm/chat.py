"""Chat formatting: conversations repaired at least cost to a legal sequence of turns, then rendered.

Legal sequences may begin with a system turn, go on with user and assistant turns
in alternation and end with an assistant turn. A source turn may be kept,
relabelled, or merged into the turn before, and empty turns may be inserted. Costs add up along
the sequence, so each stretch of turns has a small matrix: the least cost from any state
of the automaton to any other. Matrices of consecutive stretches combine like shortest
paths, which lets one long conversation be solved by many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.common import stored

ROLES = ("system", "user", "assistant")
# States: nothing yet (0), or the number of the role of the last turn plus 1.
LEGAL = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
MERGE, INSERT, RELABEL, UNKNOWN = 1, 3, 4, 1
STATES, OTHER, NEVER = 4, 4, 1 << 40
# Turns that a task holds together, and blocks of turns whose matrices it holds together.
BLOCK = 512
# Bits of Spark's increasing id that count rows within a partition.
WITHIN = 33
CLOSE = "<|end|>\n"


def _inserted(state: int) -> list[tuple[int, tuple[int, ...]]]:
    """States that empty turns lead to, with the turns: none, one or two."""
    found = [(state, ())]
    for _ in range(2):
        found += [(new, (*path, new)) for at, path in found for new in LEGAL[at] if (new, (*path, new)) not in found]
    return found


def _relabel(code: int, role: int) -> int:
    return 0 if code == role else (UNKNOWN if code == OTHER else RELABEL)


def _steps(code: int) -> dict[tuple[int, int], tuple[int, tuple[int, ...], str]]:
    """Per pair of states the cheapest way to take a source turn of a role: cost, empty turns before it, action.

    Of equal costs the one with fewer empty turns counts, then keep, merge and relabel in this order.
    """
    options: dict[tuple[int, int], list] = {}
    for state in range(STATES):
        if state:
            cost = _relabel(code, state)
            options.setdefault((state, state), []).append((MERGE + cost, 0, 1, (), "merge" if not cost else "relabel and merge"))
        for at, path in _inserted(state):
            for new in LEGAL[at]:
                cost = _relabel(code, new)
                entry = (INSERT * len(path) + cost, len(path), 2 if cost else 0, path, "relabel" if cost else "keep")
                options.setdefault((state, new), []).append(entry)
    return {pair: (best[0], best[3], best[4]) for pair, found in options.items() for best in [min(found)]}


STEPS = {code: _steps(code) for code in range(1, OTHER + 1)}
# Empty turns that end a conversation in each state.
ENDING = {0: (), 1: (2, 3), 2: (3,), 3: ()}
ENDINGS = np.array([INSERT * len(ENDING[state]) for state in range(STATES)])


def _matrix(code: int) -> np.ndarray:
    matrix = np.full((STATES, STATES), NEVER, np.int64)
    for (state, new), (cost, _, _) in STEPS[code].items():
        matrix[state, new] = cost
    return matrix


MATRICES = {code: _matrix(code) for code in STEPS}


def _through(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Least costs of one stretch followed by another."""
    return np.minimum((one[:, :, None] + two[None, :, :]).min(axis=1), NEVER)


def stretch(codes: list[int]) -> np.ndarray:
    """The least cost of a run of source turns from any state to any other."""
    total = MATRICES[codes[0]]
    for code in codes[1:]:
        total = _through(total, MATRICES[code])
    return total


def _states(matrices: list[np.ndarray], entry: int, leave: int | None) -> list[int]:
    """The states before, between and after stretches on the cheapest way; without ``leave`` the conversation ends there."""
    costs, before = np.full(STATES, NEVER, np.int64), []
    costs[entry] = 0
    for matrix in matrices:
        step = costs[:, None] + matrix
        before.append(step.argmin(axis=0))
        costs = np.minimum(step.min(axis=0), NEVER)
    states = [int(np.argmin(costs + ENDINGS)) if leave is None else leave]
    for back in reversed(before):
        states.append(int(back[states[-1]]))
    return states[::-1]


def repair(codes: list[int], entry: int, leave: int | None) -> list[tuple[int, tuple[int, ...], str, int]]:
    """For each source turn of a stretch: state before, empty turns, action, state after."""
    states = _states([MATRICES[code] for code in codes], entry, leave)
    return [(a, *STEPS[code][a, b][1:], b) for code, a, b in zip(codes, states, states[1:])]


def _open(role: int) -> str:
    return f"<|{ROLES[role - 1]}|>\n"


def render(text: str, state: int, empties: tuple[int, ...], action: str, new: int, last: bool) -> str:
    """A source turn's part of the formatted conversation. Marks in the text itself are broken up."""
    text = text.replace("<|", "< |")
    if "merge" in action:
        part = "\n\n" + text
    else:
        part = (CLOSE if state else "") + "".join(_open(role) + CLOSE for role in empties) + _open(new) + text
    if last:
        part += CLOSE + "".join(_open(role) + CLOSE for role in ENDING[new])
    return part


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple]]]:
    """Runs of rows that agree in the first column, from sorted batches."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    for key, group in groupby(rows, key=lambda row: row[0]):
        yield key, list(group)


def _conversations(group: list[tuple]) -> list[list[tuple]]:
    """The rows of a group by conversation, which is the second column."""
    return [list(rows) for _, rows in groupby(group, key=lambda row: row[1])]


def _edges(group: list[tuple]) -> list[list[tuple]]:
    """The first and the last conversation of a group; only these can go on in other groups."""
    found = _conversations(group)
    return found if len(found) < 3 else [found[0], found[-1]]


def _out(results: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in results:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _mapped(df: DataFrame, work: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str, arrow: list):
    kinds = pa.schema(arrow)
    return df.mapInArrow(lambda batches: _out(work(_by_key(batches)), kinds), schema)


def _ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, code, role, text, place) of all turns; ``place`` counts them in the order of the result.

    Rows are dealt by ranges of the order and written. Rows that tie are alike, so a running number may spread them.
    """
    code = F.lit(OTHER)
    for number, name in enumerate(ROLES, 1):
        code = F.when(F.lower(F.trim("role")) == name, number).otherwise(code)
    rows = turns.select("conv_id", "turn", code.alias("code"), "role", F.xxhash64("text").alias("mark"), "text")
    order = [F.col(name).asc_nulls_first() for name in ("conv_id", "turn", "code", "role", "mark", "tie")]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stored(dealt.select("conv_id", "turn", "code", "role", "text").withColumn("at", F.monotonically_increasing_id()), "turns")
    part = F.shiftright("at", WITHIN)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # one row per partition
    placed = dealt.withColumn("part", part).join(F.broadcast(starts), "part")
    place = F.col("start") + F.col("at").bitwiseAND((1 << WITHIN) - 1)
    return placed.select("conv_id", "turn", "code", "role", "text", place.alias("place"))


def _ways(narrow: DataFrame) -> DataFrame:
    """(block, conv_id, entry, leave, last) of the first and last conversation of each block of (block, conv_id, code, place).

    Blocks are combined in groups of as many, and groups by conversation.
    """

    def costs(groups):
        for block, group in groups:
            for rows in _edges(group):
                yield block, rows[0][1], stretch([row[2] for row in rows]).ravel().tolist()

    def matrices(rows):
        return [np.array(row[-1], np.int64).reshape(STATES, STATES) for row in rows]

    def combined(groups):
        for group, blocks in groups:
            for rows in _edges(blocks):
                yield group, rows[0][1], reduce(_through, matrices(rows)).ravel().tolist()

    def through(groups):
        for conv, rows in groups:
            states = _states(matrices(rows), 0, None)
            for number, row in enumerate(rows):
                yield row[1], conv, states[number], states[number + 1], number == len(rows) - 1

    def within(groups):
        for _, rows in groups:
            # The ways of groups come before their blocks.
            known = {row[1]: row[3:6] for row in rows if row[2] is None}
            for blocks in _conversations([row for row in rows if row[2] is not None]):
                entry, leave, last = known.get(blocks[0][1], (0, None, True))
                states = _states(matrices(blocks), entry, leave)
                for number, row in enumerate(blocks):
                    yield row[2], row[1], states[number], states[number + 1], last and number == len(blocks) - 1

    conv, cost = ("conv_id", pa.int64()), ("costs", pa.list_(pa.int64()))
    way = [("entry", pa.int32()), ("leave", pa.int32()), ("last", pa.bool_())]
    fields = "bigint, conv_id bigint, costs array<bigint>"
    dealt = narrow.repartition("block").sortWithinPartitions("block", "place").select("block", "conv_id", "code")
    blocks = _mapped(dealt, costs, f"block {fields}", [("block", pa.int64()), conv, cost])
    blocks = stored(blocks.withColumn("group", F.floor(F.col("block") / BLOCK)), "blocks")
    dealt = blocks.repartition("group").sortWithinPartitions("group", "block", "conv_id").select("group", "conv_id", "costs")
    groups = _mapped(dealt, combined, f"group {fields}", [("group", pa.int64()), conv, cost])
    dealt = groups.repartition("conv_id").sortWithinPartitions("conv_id", "group").select("conv_id", "group", "costs")
    outer = _mapped(dealt, through, "group bigint, conv_id bigint, entry int, leave int, last boolean", [("group", pa.int64()), conv, *way])
    both = blocks.unionByName(outer, allowMissingColumns=True).repartition("group").sortWithinPartitions("group", "block", "conv_id")
    both = both.select("group", "conv_id", "block", "entry", "leave", "last", "costs")
    return _mapped(both, within, "block bigint, conv_id bigint, entry int, leave int, last boolean", [("block", pa.int64()), conv, *way])


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, block, seq, turn, role, repaired_role, action, inserted, rendered) of every source turn.

    ``rendered`` in the order of block and seq makes up the formatted conversation: turns opened by
    ``<|role|>``, closed by ``<|end|>``, merged texts set apart by an empty line. ``action`` is keep, merge,
    relabel or "relabel and merge"; ``inserted`` counts empty turns put in before the turn and, for the last, behind it.

    Turns go by their number, null first, then by role and a hash of their text. Unknown and null roles must
    be relabelled, at a lower cost. Null texts are empty and kept as turns. Rows without conversation id
    make one conversation. Repeated rows are turns of their own. Other columns are ignored; an empty table gives no rows.

    All turns of the table are put in order and cut into blocks of 512 by their place, whatever their conversations
    and turn numbers. Conversations within a block are solved there. One that crosses blocks has a cost
    matrix per block, combined in groups of 512 blocks; the cheapest way leads through its groups, then
    through the blocks of each, then through the turns of each block between its two states.
    """
    rows = _ordered(turns).withColumn("block", F.floor(F.col("place") / BLOCK))
    ways = _ways(rows.select("block", "conv_id", "code", "place"))
    # The ways of a block come before its turns.
    both = rows.unionByName(ways, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "place")
    both = both.select("block", "conv_id", "place", "turn", "code", "role", "text", "entry", "leave", "last")

    def repaired(groups):
        for block, group in groups:
            known = {row[1]: row[7:] for row in group if row[2] is None}
            for held in _conversations([row for row in group if row[2] is not None]):
                conv = held[0][1]
                entry, leave, ends = known.get(conv, (0, None, True))
                steps = repair([row[4] for row in held], entry, leave)
                for seq, (row, (state, empties, action, new)) in enumerate(zip(held, steps)):
                    last = ends and seq == len(held) - 1
                    inserted = len(empties) + (len(ENDING[new]) if last else 0)
                    text = render(row[6] or "", state, empties, action, new, last)
                    yield conv, block, seq, row[3], row[5], ROLES[new - 1], action, inserted, text

    numbers = [(name, pa.int64()) for name in ("conv_id", "block", "seq", "turn")]
    strings = [(name, pa.string()) for name in ("role", "repaired_role", "action")]
    kinds = [*numbers, *strings, ("inserted", pa.int64()), ("rendered", pa.string())]
    schema = "conv_id bigint, block bigint, seq bigint, turn bigint, role string, repaired_role string, action string, inserted bigint, rendered string"
    return _mapped(both, repaired, schema, kinds)
