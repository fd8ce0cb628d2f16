"""Joining a big table with a table that holds one row per key.

The small side is broadcast only after its rows were counted and its bytes
summed. A bigger one is joined by shuffle, with the hot keys, and no others,
spread over salts.
"""

from pyspark.sql import functions as F, types as T

from parcelry.operators.skew import heavy_ids
from parcelry.session import written

MAX_ROWS = 50_000
MAX_BYTES = 32 * 1024 * 1024
SALTS = 16
LONG_TYPES = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def collect_bounded(table, max_rows=MAX_ROWS, max_bytes=MAX_BYTES):
    """Rows of ``table`` if it stays within both limits, else None.

    At most ``max_rows + 1`` rows reach the driver. Where cells can be long, Spark sums their bytes before any is collected;
    for that the rows are stored, so that the table is computed once.
    """
    first = table.limit(max_rows + 1)
    if any(isinstance(f.dataType, LONG_TYPES) for f in table.schema.fields):
        first = written(first, "bounded")
        size = first.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
        if size > max_bytes:
            return None
    rows = first.collect()
    return rows if len(rows) <= max_rows else None


def settle(table, label, max_rows=MAX_ROWS):
    """``table`` computed once: as local rows if it is small, else written to the shared folder."""
    rows = collect_bounded(table, max_rows)
    if rows is None:
        return written(table, label)
    return table.sparkSession.createDataFrame(rows, table.schema)


def lookup(df, table, on, how="left", max_rows=MAX_ROWS, salts=SALTS):
    """Join ``df`` with ``table``, which must be unique on ``on``.

    ``how`` is one of left, inner, left_semi, left_anti: each keeps or drops
    whole rows of ``df``, so salting the hot keys of ``df`` and copying their
    rows of ``table`` once per salt gives the same rows as the plain join.
    """
    if how not in {"left", "inner", "left_semi", "left_anti"}:
        raise ValueError(f"lookup does not support {how!r}")
    on = [on] if isinstance(on, str) else list(on)
    rows = collect_bounded(table, max_rows)
    if rows is not None:
        small = df.sparkSession.createDataFrame(rows, table.schema)
        return df.join(F.broadcast(small), on, how)
    return salted_join(df, table, on, how, salts)


def salted_join(df, table, on, how="left", salts=SALTS):
    """Shuffle join in which each hot key of ``df``, and a missing one, is spread over ``salts`` tasks.

    Hot keys are found first, in a pass over the keys of ``df``. Every other row of either side is sent once.
    """
    on = [on] if isinstance(on, str) else list(on)
    salt = "__salt"
    # by the row's own content: a task that runs again makes the same choice
    parts = [F.to_json(f"`{f.name}`") if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f"`{f.name}`") for f in df.schema.fields]
    spread = F.pmod(F.xxhash64(*parts), F.lit(salts)).cast("int")
    is_hot, right = F.lit(False), table.withColumn(salt, F.lit(0))
    hot = heavy_ids(df, on)[0]
    if hot:
        hot = F.broadcast(df.sparkSession.createDataFrame([tuple(row)[:-1] for row in hot], df.select(*on).schema)).withColumn("__hot", F.lit(True))
        is_hot = F.coalesce("__hot", F.lit(False))
        df = df.join(hot, on, "left")
        salts_of = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        right = table.join(hot, on, "left").withColumn(salt, F.explode(salts_of)).drop("__hot")
    for c in on:
        is_hot = is_hot | F.col(f"`{c}`").isNull()
    left = df.withColumn(salt, F.when(is_hot, spread).otherwise(F.lit(0))).drop("__hot")
    return left.join(right, [*on, salt], how).drop(salt)
