"""The prefix trie of conversations, with totals over every subtree by centroid decomposition.

A node is a distinct sequence of first turns; it is known by the exclusive or of hashes of its turns with their places,
a running sum over each conversation.  The nodes and their parents make a forest of edges, whose totals are found so:

* Cut: within bands of ``BAND`` turns, a subtree whose members have at most ``LIMIT`` turns left is one component.  The
  members' turns left are known from one aggregation and bound the number of its nodes.  The few nodes above are
  components of their own.  So each component is small, however many members, children or turns a node has.
* Within a component (one task holds it whole): it is split at its centroid, the totals of the parts below are added to
  the nodes on the path from the centroid to the top, and each part is split in turn; as parts halve, each node is seen a
  logarithmic number of times, on a chain as in a bush.
* Between components: those with nothing attached are summed into the one above; the others, by a constant factor fewer
  than the nodes, are the nodes of a smaller forest that is treated the same way.  Its totals are then added to the nodes
  that they hang from, and each component is decomposed.
"""

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelry.llm.common import ready, settled, unique_join

LIMIT, BAND = 128, 16
#: A forest of at most so many nodes is one component.
WHOLE = 4096
#: Ids that begin a shared conversation are the multiples of BLOCK, and up to SHARED - 1 of its turns are shared.
BLOCK, SHARED = 100, 6


def placed(conversations):
    """conv_id, pos (from 1), digest and code points of every turn, in order of the turn, missing ones first.

    A missing role or text is the empty one; equal turns go by role and digest; rows without a conv_id belong to no
    conversation and are left out; repeated rows are repeated turns.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.length(said("role")).cast("string"), F.lit(":"), said("role"), said("text")).cast("binary"), 256)
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", said("role").alias("role"), digest.alias("digest"), F.length(said("text")).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("pos"), "digest", "chars")


def rebuilt(turns):
    """Every conversation with its first turns replaced by those of the conversation that begins its block.

    ``turns`` as ``placed`` gives them, stored.  Returns conv_id, part, pos, digest, chars: part -1 is one row without a turn
    for each conversation, part 0 what it takes over, part 1 what is its own.  At most 199 conversations share a block.
    """
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    ids = turns.where("pos = 1").select("conv_id", shared.alias("shared"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("head"))
    heads = turns.where((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < SHARED)).withColumnRenamed("conv_id", "head")
    taken = ids.where("shared > 0").join(heads, "head").where("pos <= shared").select("conv_id", F.lit(0).alias("part"), "pos", "digest", "chars")
    own = turns.where(F.col("pos") > shared).select("conv_id", F.lit(1).alias("part"), "pos", "digest", "chars")
    none = ids.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("pos"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("chars"))
    return none.unionByName(taken).unionByName(own)


def alone(turns):
    """Every conversation as it is, in the form of ``rebuilt``."""
    none = turns.where("pos = 1").select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("pos"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("chars"))
    return none.unionByName(turns.select("conv_id", F.lit(1).alias("part"), "pos", "digest", "chars"))


def paths_of(sequences):
    """conv_id, depth, length, node, parent and chars: the nodes that each conversation passes, the root first."""
    order = Window.partitionBy("conv_id").orderBy("part", "pos")
    rows = sequences.withColumn("depth", (F.row_number().over(order) - 1).cast("long"))
    rows = rows.withColumn("length", F.count("*").over(Window.partitionBy("conv_id")) - 1)
    mark = lambda salt: F.when(F.col("part") < 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(salt), "depth", "digest"))
    key = lambda salt: F.lpad(F.hex(F.bit_xor(mark(salt)).over(order)), 16, "0")
    rows = rows.withColumn("node", F.concat(key(1), key(2)))
    return rows.select("conv_id", "depth", "length", "node", F.lag("node").over(order).alias("parent"), "chars")


def rest(band=BAND):
    """Turns that a conversation has left within the band of a node, the node's own included."""
    return F.least("length", F.floor(F.col("depth") / band) * band + (band - 1)) - F.col("depth") + 1


def centroid_totals(parents, values):
    """Sums of each of ``values`` over the subtree of every node; ``parents`` are indices, -1 at the tops of the forest."""
    n = len(parents)
    children, order = [[] for _ in range(n)], []
    for v, p in enumerate(parents):
        (children[p] if p >= 0 else order).append(v)
    for v in order:
        order.extend(children[v])
    if len(order) < n:
        raise ValueError("the edges have a cycle")
    sums = [[0] * n for _ in values]
    size, label = [0] * n, [0] * n
    # components as lists of nodes, parents first
    roots = {}
    for v in order:
        label[v] = v if parents[v] < 0 else label[parents[v]]
        roots.setdefault(label[v], []).append(v)
    waiting = list(roots.values())
    while waiting:
        nodes = waiting.pop()
        top, half = nodes[0], len(nodes) / 2
        for v in nodes:
            size[v] = 1
        centroid = top
        for v in reversed(nodes):
            if size[v] >= half:
                centroid = v
                break
            size[parents[v]] += size[v]
        # parts: 0 above the centroid, one for each child below it
        above, parts = [], {}
        for v in nodes:
            label[v] = v if v == top or v == centroid or parents[v] == centroid else label[parents[v]]
            if v == centroid:
                continue
            (above if label[v] == top and top != centroid else parts.setdefault(label[v], [])).append(v)
        below = [parts[k] for k in parts]
        for value, total in zip(values, sums):
            whole = value[centroid] + sum(value[v] for part in below for v in part)
            v = centroid
            while True:
                total[v] += whole
                if v == top:
                    break
                v = parents[v]
        waiting.extend(below)
        if above:
            waiting.append(above)
    return sums


TOTALS = "node string, leaves long, saved long"


def decomposed(batches):
    """Totals of the nodes of each piece; the rows of a piece follow each other."""
    names, held, out = ["node", "leaves", "saved"], [], [[], [], []]

    def close():
        _, nodes, parents, leaves, saved = zip(*held)
        index = {v: k for k, v in enumerate(nodes)}
        sums = centroid_totals([index.get(p, -1) for p in parents], [leaves, saved])
        for column, more in zip(out, [nodes, *sums]):
            column.extend(more)
        held.clear()

    def flushed():
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, [pa.string(), pa.int64(), pa.int64()])], names=names)
        out[:] = [[], [], []]
        return batch

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][0] != row[0]:
                close()
            held.append(row)
        if len(out[0]) >= 4000:
            yield flushed()
    if held:
        close()
    yield flushed()


PIECE = ["piece", "node", "parent", "leaves", "saved"]


def subtree_totals(paths, nodes, whole=WHOLE, limit=LIMIT, band=BAND):
    """node and the sums of ``leaves`` and ``saved`` over its subtree.

    ``nodes``: node, parent, owner (its smallest member), n_rows (members), weight, leaves, saved; ``paths``: conv_id,
    depth, length, node of at least the owners, from the root without gaps.  Both stored.
    """
    if nodes.count() <= whole:
        return nodes.coalesce(1).select(F.lit("").alias("piece"), *PIECE[1:]).mapInArrow(decomposed, TOTALS)
    walk = unique_join(paths.select("conv_id", "depth", "node"), nodes, "node", ["parent", "owner", "weight", "n_rows", "leaves", "saved"])
    along = Window.partitionBy("conv_id").orderBy("depth")
    light = F.col("weight") <= limit
    within = Window.partitionBy("conv_id", F.floor(F.col("depth") / band)).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    walk = walk.withColumn("piece", F.coalesce(F.first(F.when(light, F.col("node")), ignorenulls=True).over(within), "node"))
    own = walk.withColumn("above", F.lag("piece").over(along)).where("owner = conv_id")
    own = settled(own.select(*PIECE, "above", light.alias("light"), "owner", "depth", "n_rows"), "pieces")

    top = F.col("node") == F.col("piece")
    at_top = lambda c: F.max(F.when(top, F.col(c))).alias(c)
    pieces = own.groupBy("piece").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), *map(at_top, ("above", "parent", "owner", "depth", "n_rows", "light")))
    pieces = settled(pieces, "piece-totals")
    # what hangs from a piece with nothing attached to itself is final and summed at once
    carrying = settled(pieces.where("above is not null").groupBy(F.col("above").alias("piece")).agg(F.lit(True).alias("carries")), "carrying")
    marked = settled(pieces.join(carrying, "piece", "left"), "marked")
    final = marked.where("carries is null")
    hanging = final.groupBy(F.col("above").alias("piece")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    plus = lambda c: (F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))).alias(c)
    rest_of = marked.where("carries").join(hanging, "piece", "left")
    fewer = settled(rest_of.select(F.col("piece").alias("node"), F.col("above").alias("parent"), "owner", "n_rows", plus("leaves"), plus("saved")), "fewer")
    if fewer.count() <= whole:
        full = subtree_totals(None, fewer, whole, limit, band)
    else:
        full = subtree_totals(*shorter(own, walk, fewer, band), whole, limit, band)
    full = settled(full.withColumnRenamed("node", "piece"), "full")

    # what hangs from each node of a component that has something attached, at a band's end
    done = final.select("piece", "parent", "leaves", "saved").unionByName(full.join(marked.select("piece", "parent"), "piece").select("piece", "parent", "leaves", "saved"))
    attached = done.groupBy(F.col("parent").alias("node")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    inner = own.where("light").join(attached, "node", "left").select("piece", "node", "parent", plus("leaves"), plus("saved"))
    inner = inner.repartition("piece").sortWithinPartitions("piece").mapInArrow(decomposed, TOTALS)
    single = own.where("not light").select("node").join(done.withColumnRenamed("piece", "node").select("node", "leaves", "saved"), "node")
    return inner.unionByName(single)


def shorter(own, walk, fewer, band):
    """Paths over the pieces that are left, of the conversations that own one, and those pieces with their weights."""
    owners = fewer.select(F.col("owner").alias("conv_id")).distinct()
    tops = walk.where("node = piece").select("conv_id", "depth", "node").join(owners, "conv_id", "left_semi")
    met = settled(tops, "tops")
    counted = settled(fewer.drop("n_rows").join(met.groupBy("node").agg(F.count("*").alias("n_rows")), "node"), "counted")
    left = unique_join(met, counted, "node", ["leaves"]).where("leaves is not null")
    order = Window.partitionBy("conv_id").orderBy("depth")
    paths = left.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "node").withColumnRenamed("place", "depth")
    paths = settled(paths.withColumn("length", F.count("*").over(Window.partitionBy("conv_id")) - 1), "paths")
    weights = paths.groupBy("node").agg(F.sum(rest(band)).alias("weight"))
    return paths, settled(counted.join(weights, "node"), "weighted")


def ends_digests(paths):
    """node and the SHA-256 of the ids, ascending and comma-joined, of the conversations that end there.

    Ids are joined in blocks of 1024 possible ones, so no task gathers more at once; the blocks of a node then pass
    through one task as a sorted stream.
    """
    ends = paths.where("depth = length").select("node", "conv_id", F.shiftright("conv_id", 10).alias("block"))
    ids = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")))
    blocks = ends.groupBy("node", "block").agg(ids.alias("ids"))
    names = ["node", "ends_sha256"]

    def run(batches):
        node, hasher, out = None, None, []
        for batch in batches:
            for own, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if own != node:
                    if hasher:
                        out.append((node, hasher.hexdigest()))
                    node, hasher = own, sha256(ids.encode())
                else:
                    hasher.update(f",{ids}".encode())
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=names)
                out = []
        if hasher:
            out.append((node, hasher.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=names)

    return blocks.repartition("node").sortWithinPartitions("node", "block").select("node", "ids").mapInArrow(run, "node string, ends_sha256 string")


def prefix_trie(sequences, whole=WHOLE, limit=LIMIT, band=BAND):
    """One row for each node of the trie of ``sequences`` (as ``rebuilt`` or ``alone`` give them).

    conv_id is the smallest member, depth the number of turns, parent_conv_id the parent's conv_id (missing at the root),
    n_convs the members, n_children the children; n_leaves counts childless nodes and saved_tokens sums (n_convs - 1) times
    the code points of the last text, both over the subtree; ends_sha256 is the digest of the members that end here.
    An empty table has no root and gives an empty table.
    """
    ready(sequences.sparkSession)
    paths = settled(paths_of(sequences), "paths")
    first = lambda c: F.max(c).alias(c)
    nodes = paths.groupBy("node").agg(
        F.min("conv_id").alias("owner"), first("depth"), first("parent"), first("chars"), F.count("*").alias("n_rows"), F.sum(rest(band)).alias("weight")
    )
    nodes = settled(nodes, "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_rows") - 1) * F.col("chars")})
    nodes = settled(nodes, "nodes-with-children")
    totals = subtree_totals(paths, nodes, whole, limit, band).select("node", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    out = nodes.drop("leaves", "saved").join(totals, "node").join(ends_digests(paths), "node", "left")
    out = settled(out.select("node", "parent", "owner", "depth", "n_rows", "n_children", "n_leaves", "saved_tokens", "ends_sha256"), "trie")
    above = out.select(F.col("node").alias("parent"), F.col("owner").alias("parent_conv_id"), F.col("n_children").alias("n_rows"))
    out = unique_join(out.withColumnRenamed("n_rows", "n_convs"), settled(above, "above"), "parent", ["parent_conv_id"])
    return out.select(F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
