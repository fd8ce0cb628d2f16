"""Near duplicates by SimHash fingerprints, linked through a Gray-ordered hierarchical index.

Fingerprints that differ in at most d bits agree on two of d + 2 bit blocks, so each distinct fingerprint is sent once for
each pair of blocks.  The fingerprints of every pair of blocks are ordered by Gray rank, which puts those that differ in few
bits side by side; the order is halved down to leaves, every node keeps which bits all its members share, and two nodes
whose shared bits differ in more than d places are dropped with all pairs below them.  Copies of a fingerprint take part
once.  Links are joined to groups of fingerprints by star contractions, all as tables in the shared folder.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from parcelry.llm.common import ready, settled, texts, unique_join

LEAF = 4
#: Fingerprints that one task compares at once; more under one key are dealt out in pairs of parts.
PART = 8192


def fingerprint(text, words=3, seed=42):
    """Majority bits of the hashes of all word shingles; text as UTF-8 bytes. No word: zero."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), seed)
    counts, n, digest, join = np.zeros(64, np.int64), len(tokens) - words + 1, xxhash.xxh64_intdigest, b" ".join
    shingles = map(join, zip(*(tokens[i:] for i in range(words))))
    hashes = np.fromiter((digest(x, seed) for x in shingles), "<u8", n)
    for a in range(0, n, 1 << 16):
        counts += np.unpackbits(hashes[a : a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def digest_of(text):
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def fingerprints(docs, words=3, seed=42):
    """``doc_id``, ``fp`` (the 64 bits as a signed integer) and ``digest`` of each document; a missing text has no words."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, words, seed) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), batch.column(2)], names=["doc_id", "fp", "digest"])

    ready(docs.sparkSession)
    rows = texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"), digest_of("text").alias("digest"))
    return rows.mapInArrow(run, "doc_id long, fp long, digest binary")


def gray_rank(fps):
    rank = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


class Groups:
    """Labels of rows that are merged link by link: the smallest row of each group."""

    def __init__(self, n):
        self.label = np.arange(n)

    def merge(self, a, b):
        a, b = self.label[a], self.label[b]
        differ = a != b
        if not differ.any():
            return
        pairs = np.unique(np.stack([np.maximum(a, b)[differ], np.minimum(a, b)[differ]]), axis=1)
        over = {}

        def top(x):
            while x in over:
                x = over[x]
            return x

        for x, y in pairs.T.tolist():
            x, y = top(x), top(y)
            if x != y:
                over[max(x, y)] = min(x, y)
        if over:
            to = np.arange(len(self.label))
            for x in over:
                to[x] = top(x)
            self.label = to[self.label]


def linked(keys, fps, distance):
    """The group (as its first row in the order of the index) of each fingerprint; rows are only linked under one key.

    Returns the rows in the order of the index and the label of each, as places in that order.
    """
    order = np.lexsort((gray_rank(fps), keys))
    keys, fps, n = keys[order], fps[order], len(order)
    groups = Groups(n)
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    start, stop = edges[:-1], edges[1:]
    start, stop = start[stop - start > 1], stop[stop - start > 1]
    if not len(start):
        return order, groups.label
    padded = np.r_[fps, fps[-1:]]
    a = b = np.arange(len(start))
    while True:
        # bits that all, and bits that some members of each node have
        cut = np.stack([start, stop], axis=1).ravel()
        both, some = np.bitwise_and.reduceat(padded, cut)[::2], np.bitwise_or.reduceat(padded, cut)[::2]
        near = np.bitwise_count((both[a] & ~some[b]) | (both[b] & ~some[a])) <= distance
        a, b, size = a[near], b[near], stop - start
        if not len(size) or size.max() <= LEAF:
            break
        split = size > LEAF
        first = np.cumsum(1 + split) - (1 + split)
        middle = np.where(split, (start + stop) // 2, stop)
        grown = np.zeros((int((1 + split).sum()), 2), start.dtype)
        grown[first] = np.stack([start, middle], axis=1)
        grown[first[split] + 1] = np.stack([middle, stop], axis=1)[split]
        pairs = [(first[a], first[b])]
        for x, y in ((0, 1), (1, 0), (1, 1)):
            fits = (split[a] | (x == 0)) & (split[b] | (y == 0)) & ~((a == b) & (x > y))
            pairs.append((first[a[fits]] + x, first[b[fits]] + y))
        a, b = np.concatenate([p for p, _ in pairs]), np.concatenate([q for _, q in pairs])
        start, stop = grown.T
    lag = np.argsort(b - a, kind="stable")
    a, b, slot = a[lag], b[lag], np.arange(LEAF)
    for k in range(0, len(a), 1 << 14):
        x, y = a[k : k + (1 << 14)], b[k : k + (1 << 14)]
        # leaves whose members are all in one group have no link to add
        low, high = (f.reduceat(np.r_[groups.label, 0], np.stack([start, stop], axis=1).ravel())[::2] for f in (np.minimum, np.maximum))
        open_ = ~((low[x] == high[x]) & (low[y] == high[y]) & (low[x] == low[y]))
        x, y = x[open_], y[open_]
        p, q = start[x][:, None] + slot, start[y][:, None] + slot
        i = np.flatnonzero(((p < stop[x][:, None])[:, :, None] & (q < stop[y][:, None])[:, None, :] & (p[:, :, None] < q[:, None, :])).ravel())
        p, q = np.repeat(p.ravel(), LEAF)[i], np.repeat(q, LEAF, axis=0).ravel()[i]
        close = np.bitwise_count(fps[p] ^ fps[q]) <= distance
        groups.merge(p[close], q[close])
    return order, groups.label


def links(nodes, distance=3):
    """Links (a, b), a > b, between the numbers ``doc`` of ``nodes`` (fp, doc): enough to connect all within ``distance``."""
    n_blocks = distance + 2
    cuts = [64 * i // n_blocks for i in range(n_blocks + 1)]
    masks = [sum(((1 << cuts[i + 1]) - (1 << cuts[i])) for i in pair) for pair in combinations(range(n_blocks), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = nodes.select("fp", "doc", F.explode(F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m))) for k, m in enumerate(signed)])).alias("key"))
    crowded = settled(keyed.groupBy("key").count().where(F.col("count") > PART).withColumn("parts", F.ceil(F.col("count") / PART).cast("int")), "crowded")
    if not crowded.isEmpty():
        own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.xxhash64("key", F.least(own, o), F.greatest(own, o)))
        split = keyed.join(crowded.select("key", "parts"), "key", "left")
        keyed = split.select("fp", "doc", F.explode(F.when(F.col("parts").isNull(), F.array("key")).otherwise(pairs)).alias("key"))

    def groups(key, fp, doc):
        """Links among the rows of some keys."""
        order, label = linked(key, fp, distance)
        moved = np.flatnonzero(label != np.arange(len(label)))
        a, b = doc[order[moved]], doc[order[label[moved]]]
        differ = a != b
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)[differ]), pa.array(np.minimum(a, b)[differ])], names=["a", "b"])

    def run(batches):
        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            columns = [np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(held)]
            last = np.searchsorted(columns[0], columns[0][-1]) if len(columns[0]) else 0
            held = [c[last:] for c in columns]
            if last:
                key, fp, doc = (c[:last] for c in columns)
                yield groups(key, fp.view(np.uint64), doc)
        if len(held[0]):
            yield groups(held[0], held[1].view(np.uint64), held[2])

    dealt = keyed.select("key", "fp", "doc")
    n = max(int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return dealt.repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def components(edges):
    """``node`` and ``component``, the smallest node it is connected with, for each end of the links (a, b) with a > b.

    Alternating star contractions: each node's larger neighbours, then its smaller ones, are hung on its smallest. Each
    round is a table in the shared folder; rounds grow with the logarithm of the longest chain.
    """
    now = settled(edges.distinct(), "links")
    state = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b")).distinct()
        state = mark
        lower = now.groupBy("a").agg(F.min("b").alias("m"))
        large = now.join(lower.select(F.col("a").alias("b"), "m"), "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        # the smallest neighbour of a takes part as a's own neighbour too
        large = large.union(lower.select("a", F.col("m").alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        now = settled(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")


def grouped(docs, words=3, distance=3, seed=42):
    """``doc_id``, ``fp``, ``digest`` of the text, and ``component``, the least fingerprint of the group, for each row."""
    spark = ready(docs.sparkSession)
    marked = settled(fingerprints(docs, words, seed), "fingerprints")
    nodes = settled(marked.groupBy("fp").agg(F.count("*").alias("n_rows")), "nodes")
    found = components(links(nodes.select("fp", F.col("fp").alias("doc")), distance))
    placed = settled(nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "n_rows", F.coalesce("component", "fp").alias("component")), "placed")
    return unique_join(marked, placed, "fp", ["component"])


def near_duplicates(docs, words=3, distance=3, seed=42):
    """``doc_id``, ``fp`` and ``component_id``, the smallest id among the documents it is linked with, itself included.

    Two documents are linked if their fingerprints differ in at most ``distance`` bits. A text without words, a missing
    one too, has fingerprint zero and is linked like any other. Rows without an id link others and have the smallest id of
    their group, or none if the group has none; rows of one id are grouped each by its own text, so one id can be in several
    groups. Repeated rows stay; an empty table gives an empty table.
    """
    found = settled(grouped(docs, words, distance, seed), "grouped")
    least = settled(found.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n_rows")), "least")
    return unique_join(found, least, "component", ["component_id"]).select("doc_id", "fp", "component_id")


def one_of_each(docs, words=3, distance=3, seed=42):
    """The rows of ``docs`` that stay when one of each group of linked rows does: the smallest id's, then that with the smallest digest.

    A row without an id stays only if its group has none with one; of repeated rows one stays.
    """
    found = settled(grouped(docs, words, distance, seed), "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    kept = settled(found.groupBy("component").agg(first).select(F.col("first.doc_id").alias("__id"), F.col("first.digest").alias("__kept")), "kept")
    rows = docs.withColumn("__own", digest_of("text"))
    # rows of one id and one text are the only case in which a kept one has others beside it
    if not found.groupBy("doc_id", "digest").count().where("count > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "__own"])
    return rows.join(kept, (F.col("__own") == F.col("__kept")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi").select(docs.columns)
