"""Passages that an earlier document also has: depth-limited suffix sorting by most-significant-digit passes.

Only equality of the first ``depth`` bytes of suffixes matters, so the digits are hashes of byte runs, and only suffixes
that can tell something are sorted.  Every window of ``depth`` bytes holds one marked suffix: the start in it whose first
KEY bytes have the smallest hash; windows side by side share it, and equal windows have it at the same place.

* First digit: the KEY bytes at the mark.  It also deals the suffixes to the tasks, in blocks of many documents.
* Second digit: all bytes that the windows of one mark cover, for the suffixes equal so far.  One class of equal second
  digits means that all these windows are repeated alike, and the smallest document of the class owns them.
* Last digit: where one first digit has several second digits, the windows themselves to full depth.

Blocks send each distinct class once, so a passage in a third of all documents is a row per block, not per document.
Hashes have 64 bits for windows and over 88 for classes (the bucket and 40 bits of the first digit, 48 of the second).  Nothing is sampled and no group is capped.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from parcelry.llm.common import blocks_for, ready
from parcelry.llm.hashing import Powers, mixed

KEY = 30
#: Text of a block; a task holds about 20 bytes for each of them. A bucket gets the marks of BLOCKS_A_BUCKET blocks' text.
BLOCK_BYTES = 4 << 20
BLOCKS_A_BUCKET = 3
CHUNK_BYTES = 1 << 19
LAST = (1 << 63) - 1
LOW24, LOW48 = np.uint64((1 << 24) - 1), np.uint64((1 << 48) - 1)


class Chunk:
    """Some whole documents side by side, with the marks of their windows."""

    def __init__(self, docs, depth):
        self.data = np.frombuffer(b"".join(docs), np.uint8)
        n = len(self.data)
        sizes = np.array([len(d) for d in docs])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        Powers.reach(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * Powers.up[:n], out=self.sums[1:])
        key = min(KEY, depth)
        grams = n - key + 1
        room = depth - key + 1
        owner = np.repeat(np.arange(len(docs)), sizes)
        s = np.arange(n)
        s = s[self.ends[owner] - s >= depth]
        if not len(s):
            self.doc = self.first = self.last = self.mark = np.empty(0, np.int64)
            self.key = self.context = np.empty(0, np.uint64)
            return
        hashes = self.hash(np.arange(grams), key)
        low = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)
        span = 1
        while 2 * span <= room:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < room:
            low = np.minimum(low[: len(low) - (room - span)], low[room - span :])
        mark = (low[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        edge = np.flatnonzero(np.r_[True, mark[1:] != mark[:-1]])
        self.first, self.last, self.mark = s[edge], s[np.r_[edge[1:], len(s)] - 1], mark[edge]
        self.doc, self.key = owner[self.first], hashes[self.mark]
        length = self.last - self.first + depth
        self.context = mixed(self.hash(self.first, length) ^ (length.astype(np.uint64) << np.uint64(16)) ^ (self.mark - self.first).astype(np.uint64))

    def hash(self, at, length):
        """Hash of ``length`` bytes at each place: it depends on these bytes only."""
        return mixed((self.sums[at + length] - self.sums[at]) * Powers.down[at])


def chunks(ids, data, depth):
    """The documents of a block in chunks of about CHUNK_BYTES; a longer document is a chunk of its own."""
    held, size = [], 0
    for k, text in enumerate(data):
        if held and size + len(text) > CHUNK_BYTES:
            yield held, Chunk([data[i] for i in held], depth)
            held, size = [], 0
        held.append(k)
        size += len(text)
    if held:
        yield held, Chunk([data[i] for i in held], depth)


class Block:
    """All marks of a block, and its distinct classes (first digit, second digit) in order, with their smallest document."""

    def __init__(self, table, depth):
        self.ids = table.column("owner").to_numpy()
        self.data = table.column("data").to_pylist()
        self.chunks = list(chunks(self.ids, self.data, depth))
        gather = lambda name, kind: np.concatenate([getattr(c, name) for _, c in self.chunks] or [np.empty(0, kind)])
        key, context = gather("key", np.uint64), gather("context", np.uint64) & LOW48
        # the upper 24 bits choose the bucket, so that the rest can be sent in order
        key = key << np.uint64(24) | key >> np.uint64(40)
        owner = np.concatenate([self.ids[np.array(held)][c.doc] for held, c in self.chunks] or [np.empty(0, np.int64)])
        order = np.lexsort((owner, context, key))
        fresh = np.r_[True, (key[order][1:] != key[order][:-1]) | (context[order][1:] != context[order][:-1])][: len(order)]
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(fresh) - 1
        at = order[fresh]
        self.key, self.context, self.owner = key[at], context[at], owner[at]


def packed(x, width):
    """The low ``width`` bytes of each integer, all lowest ones first: the upper bytes of sorted numbers compress well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpacked(data, width):
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def with_owners(owners):
    """Owners as the distinct ones (steps from one to the next) and a place among them, and the number of bytes of a place."""
    names, at = np.unique(owners, return_inverse=True)
    width = 1 if len(names) <= 1 << 8 else 2 if len(names) <= 1 << 16 else 4
    return packed(np.diff(names, prepend=0), 8), packed(at.astype(np.uint64), width), width


def owners_of(names, at, width):
    return np.cumsum(unpacked(names, 8).view(np.int64))[unpacked(at, width).astype(np.int64)]


REQUEST = "bucket int, block int, digits binary, names binary, at binary, width int"
REPLY = "block int, bucket int, kind int, places binary, owners binary"


def requests(block, digits, owners, n_buckets, by):
    """One row per bucket with this block's sorted digits of it; by: what deals them out."""
    bucket = (by % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    rows = []
    for k in range(n_buckets):
        mine = order[edges[k] : edges[k + 1]]
        if len(mine):
            names, at, width = with_owners(owners[mine])
            rows.append((k, block, b"".join(packed(d[mine], w) for d, w in digits), names, at, width))
    columns = list(zip(*rows)) or [[]] * 6
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["bucket", "block", "digits", "names", "at", "width"])


def places_in_buckets(by, n_buckets):
    """For each bucket, the places of a block's digits that went there, in the order they were sent."""
    bucket = (by % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n_buckets + 1))


def replies(rows):
    columns = list(zip(*rows)) or [[]] * 5
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["block", "bucket", "kind", "places", "owners"])


def sizes_of(table):
    return [len(a) // w for a, w in zip(table.column("at").to_pylist(), table.column("width").to_pylist())]


def settle_classes(table):
    """Replies to the blocks of one bucket: smaller owners of their classes (kind 0), and classes whose windows must be compared (kind 1)."""
    sizes = sizes_of(table)
    parts = table.column("digits").to_pylist()
    key = np.concatenate([unpacked(d[: 5 * n], 5) for d, n in zip(parts, sizes)])
    context = np.concatenate([unpacked(d[5 * n :], 6) for d, n in zip(parts, sizes)])
    owner = np.concatenate([owners_of(*x) for x in zip(*(table.column(c).to_pylist() for c in ("names", "at", "width")))])
    order = np.lexsort((owner, context, key))
    new_key = np.r_[True, key[order][1:] != key[order][:-1]]
    fresh = new_key | np.r_[True, context[order][1:] != context[order][:-1]]
    number = np.cumsum(fresh) - 1
    least, several = np.empty_like(owner), np.empty(len(owner), bool)
    least[order] = owner[order][fresh][number]
    several[order] = (np.bincount(np.cumsum(new_key)[fresh])[np.cumsum(new_key)] > 1)
    rows, edges, bucket = [], np.cumsum([0, *sizes]), table.column("bucket")[0].as_py()
    for k, block in enumerate(table.column("block").to_pylist()):
        s = slice(edges[k], edges[k + 1])
        moved = np.flatnonzero(least[s] < owner[s])
        if len(moved):
            rows.append((block, bucket, 0, moved.astype("<u4").tobytes(), least[s][moved].astype("<i8").tobytes()))
        # a class with a smaller owner elsewhere is repeated as a whole; its windows are told by that owner's block
        open_ = np.flatnonzero(several[s] & (least[s] == owner[s]))
        if len(open_):
            rows.append((block, bucket, 1, open_.astype("<u4").tobytes(), b""))
    return replies(rows)


def settle_windows(table):
    """Replies to the blocks of one bucket: smaller owners of their windows (kind 2)."""
    sizes = sizes_of(table)
    digit = np.concatenate([unpacked(d, 8) for d in table.column("digits").to_pylist()])
    owner = np.concatenate([owners_of(*x) for x in zip(*(table.column(c).to_pylist() for c in ("names", "at", "width")))])
    order = np.lexsort((owner, digit))
    fresh = np.r_[True, digit[order][1:] != digit[order][:-1]]
    least = np.empty_like(owner)
    least[order] = owner[order][fresh][np.cumsum(fresh) - 1]
    rows, edges, bucket = [], np.cumsum([0, *sizes]), table.column("bucket")[0].as_py()
    for k, block in enumerate(table.column("block").to_pylist()):
        s = slice(edges[k], edges[k + 1])
        moved = np.flatnonzero(least[s] < owner[s])
        if len(moved):
            rows.append((block, bucket, 2, moved.astype("<u4").tobytes(), least[s][moved].astype("<i8").tobytes()))
    return replies(rows)


def apply_replies(table, kind, places, targets):
    """Set the owners that replies of a kind name; gives the places named."""
    order, edges = places
    named = []
    for row in table.to_pylist():
        if row["kind"] == kind:
            at = order[edges[row["bucket"]] : edges[row["bucket"] + 1]][np.frombuffer(row["places"], "<u4")]
            named.append(at)
            if row["owners"]:
                targets[at] = np.minimum(targets[at], np.frombuffer(row["owners"], "<i8"))
    return np.concatenate(named) if named else np.empty(0, np.int64)


def open_windows(block, classes, asked, depth):
    """Distinct windows of the asked classes with their smallest owner, and for each mark of such a class its windows' places."""
    wanted = np.zeros(len(classes), bool)
    wanted[asked] = True
    digits, owners, base = [], [], 0
    for held, chunk in block.chunks:
        of = block.of[base : base + len(chunk.mark)]
        base += len(chunk.mark)
        for_window, starts = spread(chunk, wanted[of])
        digits.append(chunk.hash(starts, depth))
        owners.append(np.minimum(classes[of][for_window], block.ids[np.array(held)][chunk.doc[for_window]]))
    digits = np.concatenate(digits or [np.empty(0, np.uint64)])
    owners = np.concatenate(owners or [np.empty(0, np.int64)])
    names, of = np.unique(digits, return_inverse=True)
    least = np.full(len(names), LAST)
    np.minimum.at(least, of, owners)
    return wanted, names, of, least


def spread(chunk, chosen):
    """For all windows of the chosen marks: the mark, and the window's start."""
    marks = np.flatnonzero(chosen)
    count = chunk.last[marks] - chunk.first[marks] + 1
    of = np.repeat(marks, count)
    within = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    return of, chunk.first[of] + within


RESULT = "doc_id long, text binary, spans array<struct<start:long,stop:long>>"


def find_repeats(docs, depth=50, carry=()):
    """``doc_id``, ``text`` (bytes) and ``spans``: the maximal byte runs covered by strings of ``depth`` bytes that a document with a smaller id also has.

    A missing text is the empty one; a document without an id comes after all others; rows with the same id don't make
    each other repeated; texts shorter than ``depth`` have no spans; an empty table gives an empty table.  Columns named in
    ``carry`` are passed on, others are not looked at.
    """
    spark = ready(docs.sparkSession)
    rows = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("owner"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"), *carry)
    n = blocks_for(rows, BLOCK_BYTES, "data", least=64)
    m = -(-n // BLOCKS_A_BUCKET)
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("owner", "data"), F.lit(n)).cast("int")).repartition(n, "block")

    def ask(table):
        block = Block(table, depth)
        return requests(table.column("block")[0].as_py(), [(block.key >> np.uint64(24), 5), (block.context, 6)], block.owner, m, block.key & LOW24)

    def ask_windows(table, answers):
        if not table.num_rows or not answers.num_rows:
            return requests(0, [], np.empty(0, np.int64), m, np.empty(0, np.uint64))
        block = Block(table, depth)
        classes = block.owner.copy()
        places = places_in_buckets(block.key & LOW24, m)
        apply_replies(answers, 0, places, classes)
        asked = apply_replies(answers, 1, places, classes)
        _, names, _, least = open_windows(block, classes, asked, depth)
        return requests(table.column("block")[0].as_py(), [(names, 8)], least, m, names >> np.uint64(8))

    def finish(table, answers):
        ids, spans = table.column("owner").to_numpy(), [[] for _ in range(table.num_rows)]
        if answers.num_rows or table.num_rows > 1:
            block = Block(table, depth)
            classes = block.owner.copy()
            places = places_in_buckets(block.key & LOW24, m)
            apply_replies(answers, 0, places, classes)
            asked = apply_replies(answers, 1, places, classes)
            wanted, names, of_window, least = open_windows(block, classes, asked, depth)
            apply_replies(answers, 2, places_in_buckets(names >> np.uint64(8), m), least)
            base = at = 0
            for held, chunk in block.chunks:
                of = block.of[base : base + len(chunk.mark)]
                base += len(chunk.mark)
                own = ids[np.array(held)][chunk.doc]
                whole = classes[of] < own
                change = np.zeros(len(chunk.data) + 1, np.int64)
                np.add.at(change, chunk.first[whole], 1)
                np.add.at(change, chunk.last[whole] + depth, -1)
                for_window, starts = spread(chunk, wanted[of])
                hit = least[of_window[at : at + len(starts)]] < own[for_window]
                at += len(starts)
                np.add.at(change, starts[hit], 1)
                np.add.at(change, starts[hit] + depth, -1)
                covered = np.cumsum(change[:-1]) > 0
                for k, a, b in zip(held, chunk.starts, chunk.ends):
                    if covered[a:b].any():
                        edge = np.flatnonzero(np.diff(np.r_[False, covered[a:b], False].astype(np.int8)))
                        spans[k] = [{"start": x, "stop": y} for x, y in edge.reshape(-1, 2).tolist()]
        return pa.Table.from_arrays(
            [pa.array([None if x == LAST else x for x in ids.tolist()], pa.int64()), table.column("data").cast(pa.binary()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), *(table.column(c) for c in carry)],
            names=["doc_id", "text", "spans", *carry],
        )

    by_block = blocks.groupBy("block")
    first = by_block.applyInArrow(ask, REQUEST).groupBy("bucket").applyInArrow(settle_classes, REPLY)
    second = by_block.cogroup(first.groupBy("block")).applyInArrow(ask_windows, REQUEST).groupBy("bucket").applyInArrow(settle_windows, REPLY)
    return by_block.cogroup(first.union(second).groupBy("block")).applyInArrow(finish, ", ".join([RESULT, *(f"{c} {dict(docs.dtypes)[c]}" for c in carry)]))


def cut_out(found, carry=()):
    """``doc_id``, ``kept`` (the bytes outside the spans) and counts of what ``find_repeats`` found."""

    @F.pandas_udf("binary")
    def outside(text: pd.Series, spans: pd.Series) -> pd.Series:
        kept = []
        for data, cuts in zip(text, spans):
            at, parts = 0, []
            for s in cuts:
                parts.append(data[at : s["start"]])
                at = s["stop"]
            kept.append(b"".join([*parts, data[at:]]))
        return pd.Series(kept)

    cut = found.select("doc_id", outside("text", "spans").alias("kept"), F.octet_length("text").alias("n"), F.size("spans").cast("long").alias("n_spans"), *carry)
    return cut.select("doc_id", "kept", (F.col("n") - F.octet_length("kept")).cast("long").alias("n_removed"), "n_spans", *carry)


def readable(kept):
    """Text of kept bytes; what a cut left of a character is dropped."""

    @F.pandas_udf("string")
    def decoded(data: pd.Series) -> pd.Series:
        return pd.Series([x.decode("utf-8", "ignore") for x in data])

    return decoded(kept)
