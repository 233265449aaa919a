"""Hamming distances over vertical bit planes.

64-bit fingerprints are turned on their side: plane ``p`` holds bit ``p`` of all
fingerprints, 64 of them to a machine word. One XOR per plane then compares a
bit of 64 pairs, and a carry-save adder sums four planes into bitwise counters.
The counters start so high that they overflow at ``radius + 1`` differences;
lanes that overflowed stay marked, and a block of lanes is abandoned as soon as
all of them are.
"""

from __future__ import annotations

import numpy as np

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
# Segments up to this size are compared by shifting the planes against themselves.
SMALL = 64


def planes_of(values: np.ndarray) -> np.ndarray:
    """The bit planes of fingerprints, as 64 rows of words; lane i is bit i % 64 of word i // 64."""
    lanes = -(-len(values) // 64) * 64
    padded = np.zeros(lanes, ">u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8)).reshape(lanes, 64)
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8").astype(np.uint64)


def lanes_of(words: np.ndarray, count: int) -> np.ndarray:
    """The numbers of the set lanes among the first ``count``."""
    bits = np.unpackbits(np.ascontiguousarray(words).astype("<u8").view(np.uint8), bitorder="little")
    return np.flatnonzero(bits[:count])


def _carry_save(a, b, c):
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def within(differences, shape: tuple[int, ...], radius: int) -> np.ndarray:
    """Lanes with at most ``radius`` differing planes.

    ``differences(p, keep)`` gives plane ``p`` of the XOR for the words in
    ``keep``; words whose lanes have all overflowed are left out from then on.
    """
    width = max(2, radius.bit_length())
    start = (1 << width) - (radius + 1)
    counters = [np.full(shape, ALL if start >> bit & 1 else 0, np.uint64) for bit in range(width)]
    over = np.zeros(shape, np.uint64)
    keep = np.arange(shape[-1])
    result = np.zeros(shape, np.uint64)
    for block in range(0, 64, 4):
        w, x, y, z = (differences(block + place, keep) for place in range(4))
        counters[0], twos = _carry_save(counters[0], w, x)
        counters[0], more = _carry_save(counters[0], y, z)
        counters[1], carry = _carry_save(counters[1], twos, more)
        for bit in range(2, width):
            counters[bit], carry = counters[bit] ^ carry, counters[bit] & carry
        over |= carry
        alive = over != ALL
        if alive.ndim == 2:
            alive = alive.any(axis=0)
        left = np.count_nonzero(alive)
        if not left:
            return result
        if left <= len(keep) // 2:
            keep = keep[alive]
            over = over[..., alive]
            counters = [counter[..., alive] for counter in counters]
    result[..., keep] = ~over
    return result


def near_queries(queries: np.ndarray, planes: np.ndarray, radius: int) -> np.ndarray:
    """For each query a row of words whose set lanes lie within the radius."""
    bits = np.unpackbits(queries.astype(">u8").view(np.uint8)).reshape(len(queries), 64)
    masks = np.where(bits == 1, ALL, np.uint64(0))
    return within(
        lambda p, keep: planes[p, keep][None, :] ^ masks[:, p][:, None], (len(queries), planes.shape[1]), radius
    )


def small_components(values: np.ndarray, ends: np.ndarray, radius: int) -> np.ndarray:
    """The first linked row of each row, for many segments of at most 64 rows at once.

    ``ends`` is the end of each row's segment; longer segments come first, so
    the rows with a neighbour ``step`` places on are at the front. All pairs of
    that distance are compared in one go: the planes against themselves, shifted.
    """
    places = np.arange(len(values))
    planes = np.pad(planes_of(values), ((0, 0), (0, 1)))
    firsts, seconds = [], []
    for step in range(1, SMALL):
        rows = np.flatnonzero(places + step < ends)
        if not len(rows):
            break
        used = rows[-1] // 64 + 1
        valid = np.zeros(used * 64, np.uint8)
        valid[rows] = 1
        mask = np.packbits(valid, bitorder="little").view("<u8").astype(np.uint64)
        right, left = np.uint64(step), np.uint64(64 - step)

        def differ(p, keep, right=right, left=left):
            return planes[p, keep] ^ ((planes[p, keep] >> right) | (planes[p, keep + 1] << left))

        found = lanes_of(within(differ, (used,), radius) & mask, used * 64)
        firsts.append(found)
        seconds.append(found + step)
    roots = places.copy()
    if firsts:
        first, second = np.concatenate(firsts), np.concatenate(seconds)
        while True:
            low = np.minimum(roots[first], roots[second])
            if np.array_equal(low, roots[first]) and np.array_equal(low, roots[second]):
                break
            np.minimum.at(roots, first, low)
            np.minimum.at(roots, second, low)
    return roots


def large_components(values: np.ndarray, radius: int) -> np.ndarray:
    """The first linked row of each row of one long segment.

    Breadth first, one component after the other: rows found are compared no
    further, so a dense group costs little more than its size.
    """
    count = len(values)
    roots, done = np.arange(count), np.zeros(count, bool)
    open_rows, planes = np.arange(count), planes_of(values)

    def search(batch: list[int]) -> np.ndarray:
        nonlocal open_rows, planes
        if np.count_nonzero(done[open_rows]) * 2 >= len(open_rows) > SMALL:
            open_rows = open_rows[~done[open_rows]]
            planes = planes_of(values[open_rows])
        return near_queries(values[batch], planes, radius)

    def unseen(words: np.ndarray) -> np.ndarray:
        rows = open_rows[lanes_of(words, len(open_rows))]
        return rows[~done[rows]]

    for start in range(0, count, 64):
        seeds = [row for row in range(start, min(start + 64, count)) if not done[row]]
        if not seeds:
            continue
        # Components found so far are complete, so a seed that sees only itself is alone.
        alone = [len(unseen(words)) <= 1 for words in search(seeds)]
        for seed, single in zip(seeds, alone):
            if done[seed]:
                continue
            done[seed] = True
            frontier = [] if single else [seed]
            while frontier:
                batch, frontier = frontier[:64], frontier[64:]
                found = unseen(np.bitwise_or.reduce(search(batch), axis=0))
                done[found] = True
                roots[found] = seed
                frontier.extend(found.tolist())
    return roots
