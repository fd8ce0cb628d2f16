"""Inner join of two growing tables whose ids may be hot on both sides.

Hot ids are found exactly in two aggregations: rows are counted per bucket of
the id's hash, then per id within the buckets that are full enough to hold a
hot one. The rows of a hot id are dealt over a grid of cells, left rows by the
grid's rows and right rows by its columns, so that every pair meets in one cell.
"""

import math

from pyspark.sql import functions as F, types as T

BUCKETS = 1 << 16
SHARE = 2048
FLOOR = 10_000
CELLS = 4096
CHUNK = 1000


def heavy_ids(df, on, share=None, floor=None):
    """``(rows, limit)``: the ids with more rows than ``limit``, with their counts ``n``, and no others.

    The limit is the ``share``-th part of all rows, ``floor`` at least, so there are fewer than ``share`` such ids. Ids with
    a null part match nothing and are not counted. A task sends one row per bucket, then one per id of the full buckets.
    """
    share, floor = share or SHARE, FLOOR if floor is None else floor
    keys = df.select(*on).dropna()
    bucket = F.pmod(F.xxhash64(*on), F.lit(BUCKETS))
    counts = keys.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
    limit = max(sum(row["n"] for row in counts) // share, floor, 1)
    full = [row["bucket"] for row in counts if row["n"] > limit]
    if not full:
        return [], limit
    heavy = keys.where(bucket.isin(full)).groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    return heavy.collect(), limit


def grid_of(left, left_limit, right, right_limit, cells=None):
    """Pieces of the left and of the right rows of an id: enough for both limits, but only about ``cells`` pairs of pieces."""
    a, b = math.ceil(left / left_limit), math.ceil(right / right_limit)
    shrink = min(1.0, math.sqrt((cells or CELLS) / (a * b)))
    return max(1, math.ceil(a * shrink)), max(1, math.ceil(b * shrink))


def _dealt(df, on, grid, mine, others, side):
    """Hot rows of one side as (id, place in the grid, row, repeats).

    Equal rows are counted first and dealt in chunks of at most ``CHUNK``, so that a row repeated without end does not fall into
    one cell. The place follows the content, so a task that runs again makes the same choice.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in on]
    rows = df.select(*on, (F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))).alias("row"))
    hot = rows.join(F.broadcast(grid), on).groupBy(*on, "row", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    chunks = hot.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))))
    piece = F.pmod(F.xxhash64(F.to_json(F.struct("row")), "chunk"), F.col(mine)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.col(others) - 1))
    repeats = F.least(F.lit(CHUNK), F.col("n") - F.col("chunk") * CHUNK).cast("int")
    places = {mine: piece, others: copies}
    return chunks.select(*on, places["a"].alias("i"), places["b"].alias("j"), F.col("row").alias(side), repeats.alias(f"{side}_n"))


def split_join(left, right, on, share=None, floor=None):
    """Inner join on ``on`` (a name or names): key columns, the other left ones, the other right ones, as Spark's join gives them.

    Ids hot on either side go over a grid of cells, all others to a plain join, so the largest task is bounded by the limits of
    both sides however hot an id is. Repeated rows multiply, ids with nulls match nothing, empty sides give no rows, and a name
    that both sides have beside the key comes twice. Maps cannot be grouped: tables with maps take the plain join.
    """
    on = [on] if isinstance(on, str) else list(on)
    plain = left.join(right, on, "inner")
    if any(isinstance(f.dataType, T.MapType) for side in (left, right) for f in side.schema.fields):
        return plain
    (left_hot, left_limit), (right_hot, right_limit) = heavy_ids(left, on, share, floor), heavy_ids(right, on, share, floor)
    if not left_hot and not right_hot:
        return plain
    spark, ids = left.sparkSession, left.select(*on).schema
    hot = spark.createDataFrame(list({tuple(row)[:-1] for row in [*left_hot, *right_hot]}), ids)
    sizes = []
    for side in (left, right):
        counted = side.select(*on).join(F.broadcast(hot), on).groupBy(*on).agg(F.count(F.lit(1)).alias("n")).collect()
        sizes.append({tuple(row)[:-1]: row["n"] for row in counted})
    cells = [(*key, *grid_of(n, left_limit, sizes[1][key], right_limit)) for key, n in sizes[0].items() if key in sizes[1]]
    cold = left.join(F.broadcast(hot), on, "left_anti").join(right, on, "inner")
    if not cells:
        return cold
    grid = spark.createDataFrame(cells, T.StructType([*ids.fields, T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))
    met = _dealt(left, on, grid, "a", "b", "lhs").join(_dealt(right, on, grid, "b", "a", "rhs").hint("shuffle_hash"), [*on, "i", "j"])
    for side in ("lhs", "rhs"):
        met = met.withColumn("again", F.explode(F.sequence(F.lit(1), F.col(f"{side}_n")))).drop("again")
    others = [F.col(f"{side}.`{c}`") for side, df in (("lhs", left), ("rhs", right)) for c in df.columns if c not in on]
    return cold.union(met.select(*on, *others))
