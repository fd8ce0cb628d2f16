"""Approximate nearest neighbours by inner product, with a robust-pruned directed graph in each shard.

Vectors are dealt to shards by hash.  In a shard, greedy searches from one entry propose neighbours for each vector; of
these, pruning keeps the nearest and drops every other that is nearer to a kept one than to the vector itself by more than
a slack factor, so edges go in different directions; kept edges are added backwards too, and full lists are pruned again.
Each query, in blocks of queries, runs a beam search in every shard, and the best finds of all shards are joined.

Inner products are turned into distances by one more component that gives all vectors one length.  Equal vectors enter the
graph once and carry the smallest ``k`` + 1 of their ids, which is all that any answer of ``k`` can hold.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from parcelry.llm.common import ready, settled

SHARD_ROWS = 8192
QUERY_BLOCK = 512
DEGREE = 32
BEAM = 64
SLACK = 1.2
BATCH = 512


def usable(vectors, id_col="vec_id", vector_col="embedding"):
    """Ids and vectors (doubles) that take part: no null, zero or non-finite vector, nor one with a null or non-finite component."""
    v = F.col(vector_col)
    good = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return vectors.where(good).select(F.col(id_col).alias("vec_id"), v.cast("array<double>").alias("v"))


def beam_search(points, edges, entry, queries, beam):
    """Places of the ``beam`` nearest points found for each query, nearest first (-1: none), and their squared distances.

    All queries take one step at a time: each opens its nearest unopened find.
    """
    n, width = len(queries), edges.shape[1]
    norms = (points**2).sum(axis=1)
    found = np.full((n, beam), -1)
    far = np.full((n, beam), np.inf)
    found[:, 0] = entry
    far[:, 0] = norms[entry] - 2 * queries @ points[entry]
    opened = np.zeros((n, beam), bool)
    live = np.arange(n)
    while len(live):
        todo = np.where(opened[live] | (found[live] < 0), np.inf, far[live])
        pick = todo.argmin(axis=1)
        more = np.isfinite(todo[np.arange(len(live)), pick])
        live, pick = live[more], pick[more]
        if not len(live):
            break
        opened[live, pick] = True
        next_ = edges[found[live, pick]]
        d = norms[next_] - 2 * np.einsum("nd,nwd->nw", queries[live], points[next_])
        d[next_ < 0] = np.inf
        # a find that is in the beam already keeps its place and its mark
        both = np.concatenate([found[live], next_], axis=1)
        dist = np.concatenate([far[live], d], axis=1)
        mark = np.concatenate([opened[live], np.zeros((len(live), width), bool)], axis=1)
        by_id = np.lexsort((~mark, both), axis=1)
        rows = np.arange(len(live))[:, None]
        sorted_ = both[rows, by_id]
        again = np.zeros_like(mark)
        again[rows, by_id] = np.concatenate([np.zeros((len(live), 1), bool), sorted_[:, 1:] == sorted_[:, :-1]], axis=1)
        dist[again] = np.inf
        best = np.argpartition(dist, beam - 1, axis=1)[:, :beam]
        found[live], far[live], opened[live] = both[rows, best], dist[rows, best], mark[rows, best]
        found[live] = np.where(np.isfinite(far[live]), found[live], -1)
    order = np.argsort(far, axis=1, kind="stable")
    rows = np.arange(n)[:, None]
    return found[rows, order], far[rows, order]


def prune(points, centre, candidates, degree, slack):
    """For each centre, up to ``degree`` of its candidates (-1: none): nearest first, without those that a kept one covers."""
    n, m = candidates.shape
    c = points[candidates]
    to_centre = ((c - points[centre][:, None, :]) ** 2).sum(axis=2)
    to_centre[(candidates < 0) | (candidates == centre[:, None])] = np.inf
    norms = (c**2).sum(axis=2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * c @ c.transpose(0, 2, 1)
    kept = np.full((n, degree), -1)
    rows = np.arange(n)
    open_ = to_centre.copy()
    for k in range(degree):
        pick = open_.argmin(axis=1)
        ok = np.isfinite(open_[rows, pick])
        if not ok.any():
            break
        kept[ok, k] = candidates[rows, pick][ok]
        covered = slack * slack * between[rows, pick] <= to_centre
        open_[covered & ok[:, None]] = np.inf
        open_[rows, pick] = np.inf
    return kept


def build_graph(points, degree=DEGREE, beam=BEAM, slack=SLACK, seed=1):
    """Edges (n by ``degree``, -1: none) and the entry point."""
    n = len(points)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges = np.full((n, degree), -1)
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    order = np.r_[entry, order[order != entry]]
    first = order[: min(n, 2 * degree)]
    edges[first] = prune(points, first, np.tile(first, (len(first), 1)), degree, slack)
    at = len(first)
    while at < n:
        mine = order[at : at + min(BATCH, max(at // 2, 16))]
        found, _ = beam_search(points, edges, entry, points[mine], beam)
        # those of one batch do not see each other in the graph yet, so some are proposed outright
        peers = mine[rng.integers(0, len(mine), (len(mine), 8))]
        edges[mine] = prune(points, mine, np.concatenate([found, peers], axis=1), degree, slack)
        source = np.repeat(mine, degree)
        target = edges[mine].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        names, start, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(start, count)
        for a in range(0, len(names), BATCH):
            some = names[a : a + BATCH]
            width = int(count[a : a + BATCH].max())
            new = np.full((len(some), width), -1)
            inside = slice(start[a], start[a + len(some) - 1] + count[a + len(some) - 1])
            new[np.repeat(np.arange(len(some)), count[a : a + BATCH]), place[inside]] = source[inside]
            held = np.concatenate([edges[some], new], axis=1)
            full = (held >= 0).sum(axis=1) > degree
            if full.any():
                edges[some[full]] = prune(points, some[full], held[full], degree, slack)
            if (~full).any():
                rest = np.sort(held[~full], axis=1)[:, ::-1][:, :degree]
                edges[some[~full]] = rest
        at += len(mine)
    return edges, entry


def distinct_vectors(rows, k):
    """Each distinct vector with its ``k`` + 1 smallest ids; merged within tasks first, so a common vector is a row per task."""

    def merge(batches):
        held = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, offsets = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
            for i, a, b in zip(batch.column(0).to_pylist(), offsets[:-1], offsets[1:]):
                ids = held.setdefault((flat[a:b] + 0.0).tobytes(), [])
                ids.append(i)
                if len(ids) > 4 * k + 8:
                    ids[:] = sorted(ids)[: k + 1]
        keys = list(held)
        for a in range(0, len(keys), 10_000):
            some = keys[a : a + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()), pa.array([sorted(held[x])[: k + 1] for x in some], pa.list_(pa.int64()))], names=["v", "ids"])

    parts = rows.mapInArrow(merge, "v binary, ids array<long>")
    return parts.groupBy("v").agg(F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))


def build_index(vectors, k, shard_rows=SHARD_ROWS, degree=DEGREE, beam=BEAM, slack=SLACK):
    """One row per shard: vectors, their ids, edges and entry. All vectors take part; their lengths' maximum is one number."""
    unique = settled(distinct_vectors(vectors, k), "vectors")
    size, longest = unique.select(F.count("*"), F.max(F.octet_length("v"))).first()
    n_shards = max(1, -(-size // shard_rows))
    dealt = unique.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(n_shards)).cast("int"))

    def build(table):
        raw = table.column("v").to_pylist()
        ids = table.column("ids").to_pylist()
        order = sorted(range(len(raw)), key=lambda i: ids[i][0])
        flat = np.frombuffer(b"".join(raw[i] for i in order)).reshape(len(raw), -1)
        length = (flat**2).sum(axis=1)
        points = np.concatenate([flat, np.sqrt(length.max() - length)[:, None]], axis=1).astype(np.float32)
        edges, entry = build_graph(points, degree, beam, slack)
        counts = np.array([len(ids[i]) for i in order], "<i4")
        flat_ids = np.array([x for i in order for x in ids[i]], "<i8")
        columns = [table.column("shard")[:1], [flat.tobytes()], [counts.tobytes()], [flat_ids.tobytes()], [edges.astype("<i4").tobytes()], [entry], [len(raw)]]
        return pa.table(dict(zip(["shard", "v", "counts", "ids", "edges", "entry", "n"], columns)))

    index = dealt.groupBy("shard").applyInArrow(build, "shard int, v binary, counts binary, ids binary, edges binary, entry long, n long")
    return settled(index, "graph"), n_shards


def search(queries, index, n_shards, k, degree=DEGREE, beam=BEAM):
    """``query_id``, ``rank``, ``vec_id`` and ``score``: for each query (vec_id, v) the ``k`` best finds, itself left out.

    Scores are inner products of the original vectors in doubles; ties go to the smaller id.
    """
    n_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    packed = queries.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block")).groupBy("block").agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    met = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))).join(index, "shard").select("queries", "v", "counts", "ids", "edges", "entry", "n")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                own = batch.column(0)[row].values
                query_id = own.field("vec_id").to_numpy()
                n = batch.column(6)[row].as_py()
                flat = np.frombuffer(batch.column(1)[row].as_py()).reshape(n, -1)
                vectors = own.field("v").flatten().to_numpy()
                widths = np.diff(own.field("v").offsets.to_numpy())
                if (widths != flat.shape[1]).any():
                    raise ValueError("queries and vectors differ in length")
                vectors = vectors.reshape(len(query_id), -1)
                counts, ids = np.frombuffer(batch.column(2)[row].as_py(), "<i4"), np.frombuffer(batch.column(3)[row].as_py(), "<i8")
                edges = np.frombuffer(batch.column(4)[row].as_py(), "<i4").reshape(n, degree)
                length = (flat**2).sum(axis=1)
                points = np.concatenate([flat, np.sqrt(length.max() - length)[:, None]], axis=1).astype(np.float32)
                asked = np.concatenate([vectors, np.zeros((len(vectors), 1))], axis=1).astype(np.float32)
                found, _ = beam_search(points, edges, batch.column(5)[row].as_py(), asked, beam)
                first = np.cumsum(counts) - counts
                out = ([], [], [])
                for q in range(len(query_id)):
                    at = found[q][found[q] >= 0]
                    score = flat[at] @ vectors[q]
                    keep = np.repeat(np.arange(len(at)), counts[at])
                    other = np.concatenate([ids[first[x] : first[x] + counts[x]] for x in at])
                    score = score[keep]
                    fits = other != query_id[q]
                    other, score = other[fits], score[fits]
                    best = np.lexsort((other, -score))[:k]
                    out[0].append(np.full(len(best), query_id[q]))
                    out[1].append(other[best])
                    out[2].append(score[best])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["query_id", "vec_id", "score"])

    finds = met.mapInArrow(run, "query_id long, vec_id long, score double")
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "score"))), 1, k)
    # each shard gives k finds a query at most
    ranked = finds.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("place", "hit"))
    return ranked.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def nearest(vectors, queries, k=20, shard_rows=SHARD_ROWS, degree=DEGREE, beam=BEAM, slack=SLACK):
    """The ``k`` nearest of ``vectors`` for each row of ``queries`` (both vec_id, embedding).

    Unusable vectors take no part on either side; an empty table gives no rows; with fewer candidates all are given.
    Repeated rows of one id count once as a query. Queries and vectors must be of one length.
    """
    ready(vectors.sparkSession)
    asked = settled(usable(queries).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    index, n_shards = build_index(usable(vectors), k, shard_rows, degree, beam, slack)
    return search(asked, index, n_shards, k, degree, beam)
