"""Exact quantiles with linear interpolation that never hold a group in memory.

``percentile`` keeps a map of all distinct values of a group in one task, which
does not survive a group of billions of rows. Here a first aggregation takes
approximate quantiles a little below and above each wanted one; a second
aggregation counts the values inside these brackets one by one and everything
between the brackets as a single cell. Each bracket is cut into CHUNKS steps of
its value range; the counts per step, a few hundred rows per group whatever its
size, tell which steps hold a wanted rank, and only their cells are put in
order, each step on its own. All aggregations combine on the map side.

Groups known to be small go to ``percentile`` instead, which needs one pass.
"""

import math

from pyspark.sql import Window, functions as F

from parcelry.operators.lookup import collect_bounded
from parcelry.session import written

ACCURACY = 10_000
# Groups of at most this many rows are small enough for the map ``percentile`` keeps.
DIRECT_ROWS = 5_000
# Half-width of a bracket, in units of the sketch's guaranteed rank error.
MARGIN = 3.0
# Steps of a bracket that are ordered apart from each other.
CHUNKS = 256


def clean_double(column):
    value = F.col(column) if isinstance(column, str) else column
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


def group_quantiles(df, keys, value, probs, accuracy=ACCURACY, direct_rows=DIRECT_ROWS):
    """One row per group: the keys, ``n`` and ``q``, an array in the order of ``probs``.

    Missing keys and missing values are left out, as in a pandas group-by.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    probs = [float(p) for p in probs]
    if not probs or any(not 0.0 <= p <= 1.0 for p in probs):
        raise ValueError("probabilities must lie in [0, 1]")
    rows = group_values(df, keys, value)
    if not keys:
        return _narrowed(rows, keys, probs, rows.agg(*_sketch(probs, accuracy)))
    # read by the sketch and by the passes that follow it
    return stored_quantiles(written(rows, "values"), keys, probs, accuracy, direct_rows)


def group_values(df, keys, value):
    """The keys and the value as ``__v``, without missing ones."""
    return df.select(*keys, clean_double(value).alias("__v")).dropna()


def stored_quantiles(rows, keys, probs, accuracy=ACCURACY, direct_rows=DIRECT_ROWS):
    """``group_quantiles`` of stored ``group_values``, for callers that read those again."""
    sketches = rows.groupBy(*keys).agg(*_sketch(probs, accuracy))
    known = collect_bounded(sketches)
    if known is None:
        return _narrowed(rows, keys, probs, written(sketches, "sketches"))
    spark, schema = rows.sparkSession, sketches.schema
    large = [r for r in known if r["__n"] > direct_rows]
    if not large:
        return _direct(rows, keys, probs)
    brackets = F.broadcast(spark.createDataFrame(large, schema))
    if len(large) == len(known):
        return _narrowed(rows, keys, probs, brackets)
    return _narrowed(rows, keys, probs, brackets).unionByName(_direct(rows.join(brackets.select(*keys), keys, "left_anti"), keys, probs))


def _inner(probs):
    return sorted({p for p in probs if 0.0 < p < 1.0})


def _sketch(probs, accuracy, value="__v"):
    """Count and brackets of a column: ``__n`` and ``__b``, values a little below and then a little above each quantile."""
    inner, width = _inner(probs), MARGIN / accuracy
    ends = [max(p - width, 0.0) for p in inner] + [min(p + width, 1.0) for p in inner]
    found = F.percentile_approx(value, ends, accuracy) if inner else F.lit(None).cast("array<double>")
    return [F.count(value).alias("__n"), found.alias("__b")]


def _direct(rows, keys, probs):
    q = F.percentile("__v", F.lit(probs))
    return rows.groupBy(*keys).agg(F.count("__v").alias("n"), q.alias("q"))


def _narrowed(rows, keys, probs, brackets):
    inner = _inner(probs)
    m = len(inner)
    v = F.col("__v")
    lows, highs = ([f"__{side}{i}" for i in range(m)] for side in ("l", "h"))
    ends = brackets.select(*keys, "__n", *[F.get("__b", F.lit(i)).alias(c) for i, c in enumerate(lows + highs)])
    if keys:
        marked = rows.join(ends, keys)
    else:
        marked = rows.crossJoin(ends)  # a single row of brackets

    def first_reached(values, rest):
        """The value of the first bracket that does not end below the row's; brackets are in order, so a row can lie in that one only."""
        for high, value in reversed([*zip(highs, values)]):
            rest = F.when(v <= F.col(high), value).otherwise(rest)
        return rest

    # each step names what the next one uses more than once: as one expression this is too long to be compiled
    none = F.lit(None).cast("double")
    low, high = F.col("__low"), F.col("__high")
    marked = marked.select(
        *keys, "__n", "__v", first_reached([F.lit(i) for i in range(m)], F.lit(m)).alias("__gap"),
        first_reached([F.col(c) for c in lows], none).alias("__low"), first_reached([F.col(c) for c in highs], none).alias("__high"),
    )
    marked = marked.select(*keys, "__n", "__v", "__gap", F.coalesce(v >= low, F.lit(False)).alias("__in"), ((v - low) / F.nullif(high - low, F.lit(0.0))).alias("__share"))
    share = F.col("__share")
    step = F.when(F.col("__in") & (share >= 0) & (share <= 1), F.least(F.floor(share * CHUNKS), F.lit(CHUNKS - 1))).otherwise(F.lit(0))
    chunk = (F.col("__gap") * 2 + F.col("__in").cast("int")).cast("long") * CHUNKS + step
    cells = (
        marked.select(*keys, "__n", "__v", chunk.alias("__chunk"), F.when(F.col("__in"), v).alias("__exact"))
        .groupBy(*keys, "__n", "__chunk", "__exact")
        .agg(F.count("__v").alias("__c"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    )
    # few rows, read twice below
    cells = written(cells, "bracket-cells")
    positions = [F.lit(p) * (F.col("__n") - 1) for p in probs]
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = cells.groupBy(*keys, "__n", "__chunk").agg(F.sum("__c").alias("__t")).withColumn("__start", F.coalesce(F.sum("__t").over(before), F.lit(0)))
    wanted = F.lit(False)
    for position in positions:
        for rank in (F.floor(position), F.ceil(position)):
            wanted = wanted | ((rank >= F.col("__start")) & (rank < F.col("__start") + F.col("__t")))
    chunks = totals.filter(wanted).select(*keys, "__chunk", "__start")
    order = Window.partitionBy(*keys, "__chunk").orderBy("__lo")
    running = cells.join(chunks, [*keys, "__chunk"]).withColumn("__end", F.col("__start") + F.sum("__c").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    start = F.col("__end") - F.col("__c")

    def element(rank):
        # A cell knows its first and its last value; anything deeper must be inside a bracket.
        found = (
            F.when(rank == start, F.col("__lo"))
            .when(rank == F.col("__end") - 1, F.col("__hi"))
            .when(F.col("__lo") == F.col("__hi"), F.col("__lo"))
            .otherwise(F.raise_error(F.lit("quantile bracket missed its rank")).cast("double"))
        )
        return F.max(F.when((rank >= start) & (rank < F.col("__end")), found))

    picks = []
    for i, p in enumerate(probs):
        position = F.lit(p) * (F.col("__n") - 1)
        below = F.floor(position)
        above = F.ceil(position)
        picks += [element(below).alias(f"__x{i}"), element(above).alias(f"__y{i}")]
    found = running.groupBy(*keys, "__n").agg(*picks)
    answers = []
    for i, p in enumerate(probs):
        position = F.lit(p) * (F.col("__n") - 1)
        part = position - F.floor(position)
        answers.append(F.col(f"__x{i}") + (F.col(f"__y{i}") - F.col(f"__x{i}")) * part)
    return found.select(*keys, F.col("__n").alias("n"), F.array(*answers).alias("q"))


def group_median(df, keys, value, name="median"):
    keys = [keys] if isinstance(keys, str) else list(keys)
    return group_quantiles(df, keys, value, [0.5]).select(*keys, F.col("q")[0].alias(name))


def long_form(df, columns, name="column", value="value"):
    """One row per (column, value), all values as doubles, missing ones left out."""
    cells = df.select(*[clean_double(F.col(f"`{c}`")).alias(c) for c in columns])
    return cells.unpivot([], [F.col(f"`{c}`") for c in columns], name, value).filter(F.col(value).isNotNull())


def column_quantiles(df, columns, probs, accuracy=ACCURACY):
    """{column: [quantile, ...]} for all columns: one pass for the brackets, one for the values inside; NaN where a column is empty."""
    probs = [float(p) for p in probs]
    if not probs or any(not 0.0 <= p <= 1.0 for p in probs):
        raise ValueError("probabilities must lie in [0, 1]")
    cells = long_form(df, columns).withColumnRenamed("value", "__v")
    sketches = cells.groupBy("column").agg(*_sketch(probs, accuracy))
    known = sketches.collect()  # a row of fixed size for each column
    found = {}
    if known:
        brackets = F.broadcast(df.sparkSession.createDataFrame(known, sketches.schema))
        found = {r["column"]: list(r["q"]) for r in _narrowed(cells, ["column"], probs, brackets).collect()}
    return {c: found.get(c, [math.nan] * len(probs)) for c in columns}
