"""Best-fit packing of documents into sequences of a fixed number of tokens.

The lengths of all pieces are counted; the histogram has at most ``capacity`` entries, whatever the input.  On it a
configuration program is solved: which fillings of a sequence, and how often each.  Multiplicative weights hold a price
for each length, lower the more of its pieces are placed; the best filling at these prices is found by a knapsack dynamic
programme over the capacity, and used for a share of the pieces.  The fractional counts are rounded down, and the
pieces left over are placed best fit first; of several such plans the shortest is taken.  The plan that results names, for each length, which ranks go to which
sequence; pieces get their rank from counts per task, so no task or driver ever holds the pieces.
"""

import bisect
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelry.llm.common import settled, texts

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def pieces(docs, encoder, capacity=1024, end=2):
    """Each document's ids followed by ``end``, cut into pieces of ``capacity`` from the back, so that only the first may be shorter.

    A missing or empty text is the one id ``end``; repeated rows are separate documents.  ``part`` and ``place`` tell the
    task and the running number among its pieces of that length.
    """
    tail = int(end).to_bytes(4, "little")

    def run(batches):
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            encode, rows = encoder.value.encode, []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + tail
                n = len(ids) // 4
                starts = [0, *range(n % capacity or capacity, n, capacity)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), part, seen[b - a]))
                    seen[b - a] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                names = [x.split()[0] for x in PIECE.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return texts(docs).mapInArrow(run, PIECE)


def best_filling(prices, capacity):
    """Knapsack by dynamic programming: how often to take each length, for the highest sum of prices."""
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    for room in range(1, capacity + 1):
        gains = prices[1 : room + 1] + best[room - 1 :: -1]
        took[room] = np.argmax(gains) + 1
        best[room] = gains[took[room] - 1]
        if best[room] <= best[room - 1]:
            best[room], took[room] = best[room - 1], 0
    filling, room = Counter(), capacity
    while room > 0:
        if took[room]:
            filling[int(took[room])] += 1
            room -= took[room]
        else:
            room -= 1
    return filling


def fillings(counts, capacity, eta=2.0, share=0.5, rounds=1200):
    """Fractional use of each filling, by multiplicative weights. After ``rounds``, each filling takes all that it can."""
    lengths = np.array(sorted(counts))
    total = np.zeros(capacity + 1)
    total[lengths] = [counts[x] for x in lengths]
    rest, used, k = total.copy(), {}, 0
    worth = np.arange(capacity + 1) / capacity
    while (rest > 0.5).any():
        prices = np.where(rest > 0.5, worth * np.exp(eta * rest / np.maximum(total, 1)), 0.0)
        filling = best_filling(prices, capacity)
        most = min(rest[x] / n for x, n in filling.items())
        step = most * share if k < rounds and most * share >= 1 else most
        key = tuple(sorted(filling.items(), reverse=True))
        used[key] = used.get(key, 0.0) + step
        for x, n in filling.items():
            rest[x] -= step * n
        k += 1
    return used


def best_fit(counts, capacity):
    """Fillings and how often each, the longest pieces first, each into the fullest sequence that has room for it.

    Sequences filled alike are kept as one entry, so the work depends on the number of lengths, not of pieces.
    """
    rooms, held = [], []

    def keep(room, filling, times):
        bisect.insort(rooms, (room, len(held)))
        held.append([filling, times])

    for x in sorted(counts, reverse=True):
        left = counts[x]
        while left:
            k = bisect.bisect_left(rooms, (x, -1))
            room, at = rooms[k] if k < len(rooms) else (capacity, None)
            filling, times = held[at] if at is not None else ({}, left)
            copies = min(room // x, left)
            taken = min(times, left // copies)
            if at is not None:
                held[at][1] -= taken
                if not held[at][1]:
                    rooms.pop(k)
            keep(room - copies * x, {**filling, x: copies}, taken)
            left -= copies * taken
    return [(filling, times) for filling, times in held if times]


def rounded(used, counts, capacity, slack):
    """Fillings and how often each: the fractional ones that leave at most ``slack`` tokens free, rounded down, and best fit for the rest."""
    rest, steps = Counter(counts), []
    for filling, times in used.items():
        whole = min([int(times + 1e-6), *(rest[x] // n for x, n in filling)])
        if whole and sum(x * n for x, n in filling) >= capacity - slack:
            steps.append((dict(filling), whole))
            for x, n in filling:
                rest[x] -= n * whole
    return steps + best_fit({x: n for x, n in rest.items() if n}, capacity)


def plan(counts, capacity, slack=1):
    """Which ranks of each length go where: rows of (length, first rank, first sequence, copies in a sequence, offset).

    ``counts`` maps each length to its number of pieces. Pieces that fill a sequence need no filling.  The programme is rounded
    keeping only fillings that leave at most ``slack`` tokens free, keeping looser ones, all, and none; of these plans, that
    with fewest sequences is taken.
    """
    rest = {x: n for x, n in counts.items() if x < capacity and n}
    steps = []
    if rest:
        used = fillings(rest, capacity)
        slacks = dict.fromkeys([slack, *(capacity >> k for k in range(8, -1, -1)), -1])
        steps = min((rounded(used, rest, capacity, x) for x in slacks), key=lambda found: sum(times for _, times in found))
    rows, ranks, sequence = [], Counter(), 0
    if counts.get(capacity):
        rows.append((capacity, 0, 0, 1, 0))
        sequence = counts[capacity]
    for filling, times in steps:
        offset = 0
        for x in sorted(filling, reverse=True):
            rows.append((x, ranks[x], sequence, filling[x], offset))
            ranks[x] += filling[x] * times
            offset += x * filling[x]
        sequence += times
    return sorted(rows)


def pack(docs, encoder, capacity=1024, end=2):
    """``pieces`` with ``sequence_id`` and ``offset``: in each sequence, offsets run from 0 without gaps, up to ``capacity``.

    An empty table gives an empty table.  The plan sent to the tasks has a few rows per length; its size is bounded by the
    capacity, not by the data.
    """
    cut = settled(pieces(docs, encoder, capacity, end), "pieces")
    tally = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    bases = tally.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(bases, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("rank"))
    rows = plan(counts, capacity)
    steps = np.array(rows or [(0, 0, 0, 1, 0)], np.int64)

    def run(batches):
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.empty(len(rank), np.int64)
            for x in np.unique(length):
                a, b = np.searchsorted(steps[:, 0], [x, x + 1])
                mine = length == x
                at[mine] = a - 1 + np.searchsorted(steps[a:b, 1], rank[mine], "right")
            _, first, sequence, copies, offset = steps[at].T
            k = rank - first
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence + k // copies), pa.array(offset + k % copies * length)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
