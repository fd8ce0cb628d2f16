"""Descriptive statistics behind the charts: each function returns a DataFrame."""

import math
from functools import reduce

from numpy.polynomial.hermite_e import herme2poly
from pyspark.sql import functions as F

from parcelry.functions.scalar import cut
from parcelry.operators.gram import correlation_matrix
from parcelry.operators.lookup import lookup
from parcelry.operators.quantiles import clean_double, column_quantiles, group_median, group_values, stored_quantiles
from parcelry.operators.reshape import column_rows
from parcelry.schema import NON_MEASURES, numeric_columns
from parcelry.session import written

ROOM_EDGES = [0, 1, 2, 3, 4, 5, 10]
ROOM_LABELS = ["1", "2", "3", "4", "5", "6+"]


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def _present(df, keys):
    return df.dropna(subset=_keys(keys))


def group_range(df, keys, value):
    """min, max, mean and count of a value per group."""
    return _present(df, keys).groupBy(*_keys(keys)).agg(
        F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.count(value).alias("count")
    )


def group_summary(df, keys, price, area, ident):
    return _present(df, keys).groupBy(*_keys(keys)).agg(
        F.avg(price).alias("avg_price"), F.avg(area).alias("avg_area"), F.count(ident).alias("listings")
    )


def value_counts(df, keys):
    """Rows per value, most frequent first, ties by value. Missing values are not counted."""
    keys = _keys(keys)
    return _present(df, keys).groupBy(*keys).count().orderBy(F.desc("count"), *keys)


def shares(df, key):
    """Rows per value and their share of all counted rows."""
    counts = _present(df, key).groupBy(key).count()
    total = counts.agg(F.sum("count").alias("t"))
    return counts.withColumn("share", F.col("count") / total.scalar())


def monthly_series(df, date, value, keys=()):
    """Rows and median value per calendar month (``yyyy-MM``) and key."""
    keys = _keys(keys)
    rows = df.select(*keys, F.trunc(F.col(date).cast("date"), "month").alias("month"), F.col(value)).dropna(subset=[*keys, "month"])
    counts = rows.groupBy(*keys, "month").agg(F.count(F.lit(1)).alias("listings"))
    series = counts.join(group_median(rows, [*keys, "month"], value, "median_value"), [*keys, "month"], "left")
    return series.withColumn("month", F.date_format("month", "yyyy-MM"))


def count_by_month_start(df, year, month):
    """Rows per first day of the month, from year and month numbers."""
    return df.groupBy(F.make_date(F.col(year), F.col(month), F.lit(1)).alias("date")).agg(F.count(F.lit(1)).alias("listings"))


def describe(df, columns=None):
    """One row per numeric column: count, mean, sample deviation, extremes and exact quartiles.

    Three passes: moments, quantile brackets, and the values inside the brackets.
    """
    columns = columns or numeric_columns(df)
    probs = [0.25, 0.5, 0.75]
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    moments = [f(clean_double(F.col(f"`{c}`"))).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, f in measures.items()]
    row = df.agg(*moments).first()
    quartiles = column_quantiles(df, columns, probs)
    rows = [(c, *[row[f"{name}_{i}"] for name in measures], *[None if math.isnan(q) else float(q) for q in quartiles[c]]) for i, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "column string, count long, mean double, std double, min double, max double, q25 double, q50 double, q75 double")


def null_profile(df, name="missing"):
    """Missing cells per column."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return column_rows(counts, df.columns, "column", name)


def compare_null_profiles(left, right):
    return null_profile(left, "left_missing").join(null_profile(right, "right_missing"), "column", "full")


def compare_columns(left, right):
    """Column names of two tables side by side, by position."""
    spark = left.sparkSession
    a = spark.createDataFrame(list(enumerate(left.columns)), "position int, left_column string")
    b = spark.createDataFrame(list(enumerate(right.columns)), "position int, right_column string")
    return a.join(b, "position", "full")


def collapse_rate(counts, minimum, count="count"):
    """Share of the categories that occur fewer than ``minimum`` times."""
    return counts.agg((F.count_if(F.col(count) < minimum) / F.count(F.lit(1))).alias("collapse_rate"))


def sorted_values(df, column):
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def correlations(df, columns=None):
    """Pearson r of every ordered pair of columns, over the rows where both are present; missing where either does not vary."""
    columns = columns or numeric_columns(df, NON_MEASURES)
    r = correlation_matrix(df, columns)
    cells = [(a, b, None if math.isnan(r[i, j]) else float(r[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(cells, "col_a string, col_b string, r double")


def regression_line(df, x, y, keys=()):
    """Slope, intercept and R² of the least-squares line of y on x."""
    y, x = F.col(y).cast("double"), F.col(x).cast("double")
    return df.groupBy(*_keys(keys)).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n")
    )


def box_stats(df, keys, value):
    """Quartiles, whiskers within 1.5 interquartile ranges and the number of outliers per group."""
    keys = _keys(keys)
    # read by the quartiles and by the pass that follows them
    rows = written(group_values(df, keys, value), "values")
    quartiles = stored_quantiles(rows, keys, [0.25, 0.5, 0.75]).select(
        *keys, F.col("n"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    x, reach = F.col("__v"), 1.5 * (F.col("q3") - F.col("q1"))
    inside = (x >= F.col("q1") - reach) & (x <= F.col("q3") + reach)
    return lookup(rows, quartiles, keys, "inner").groupBy(*keys, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def histogram(df, column, bins):
    """Counts in ``bins`` equal-width bins over the value range; the last bin is closed."""
    v = F.col(column).cast("double")
    rows = df.select(F.when(~F.isnan(v), v).alias("x")).dropna()
    lo, hi = F.min("x"), F.max("x")
    # A constant column gets a unit-wide range around its value.
    ends = rows.agg(F.when(lo < hi, lo).otherwise(lo - 0.5).alias("lo"), F.when(lo < hi, hi).otherwise(hi + 0.5).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    index = F.least(F.floor((F.col("x") - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    counts = rows.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    step = (hi - lo) / bins
    return frame.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * step).alias("left_edge"),
        (lo + (F.col("bin") + 1) * step).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def quartile_histograms(df, column, bins=15):
    """A histogram inside each quarter of a non-negative column: (0, q1], (q1, q2], (q2, q3], (q3, max]."""
    rows = df.filter(F.col(column) >= 0).select(F.col(column).cast("double").alias("x"))
    q1, q2, q3 = column_quantiles(rows, ["x"], [0.25, 0.5, 0.75])["x"]
    part = F.when(F.col("x") <= 0, F.lit(None)).when(F.col("x") <= q1, 1).when(F.col("x") <= q2, 2).when(F.col("x") <= q3, 3).otherwise(4)
    rows = rows.select("x", part.alias("quarter")).dropna()
    ends = rows.groupBy("quarter").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n_quarter"))
    width = F.col("hi") - F.col("lo")
    ends = ends.withColumns({"lo": F.when(width > 0, F.col("lo")).otherwise(F.col("lo") - 0.5), "hi": F.when(width > 0, F.col("hi")).otherwise(F.col("hi") + 0.5)})
    ends = df.sparkSession.createDataFrame(ends.collect(), ends.schema)  # at most four rows
    index = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    counts = rows.join(F.broadcast(ends), "quarter").groupBy("quarter", index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = ends.select("quarter", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(counts, ["quarter", "bin"], "left").fillna(0, ["n"])


def binned_counts(df, column, edges=ROOM_EDGES, labels=ROOM_LABELS):
    """Rows per labelled interval, empty intervals included; values outside all intervals are left out."""
    counts = df.select(cut(column, edges, labels).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.createDataFrame(list(enumerate(labels)), "position int, label string")
    return frame.join(counts, "label", "left").select("position", "label", F.coalesce("n", F.lit(0)).alias("n"))


TERMS = 12
CELL = 0.25
KERNEL_REACH = 9.0
# e^(-u²/2) times the Hermite polynomial k is the k-th term of the kernel around a cell's middle; row k: its coefficients
HERMITE = [[float(c) for c in herme2poly([0] * k + [1])] for k in range(TERMS)]


def density(df, column, points=200, cut_widths=0.0):
    """Gaussian kernel density with Scott's bandwidth on an even grid over the value range: (i, x, density).

    Values are summed into cells a quarter of the bandwidth wide, each with the first ``TERMS`` moments about its middle, and
    the kernel is expanded about that middle: no value is off by more than 1e-15 of the kernel's peak, and values further than
    ``KERNEL_REACH`` bandwidths from a point (under 3e-18 of the peak) add nothing to it. A task sends one row per cell it
    meets, then at most ``points`` rows. Nulls and NaN are left out; infinite values and fewer than two different ones are an error.
    """
    v = F.col(column).cast("double")
    values = df.select(F.when(~F.isnan(v), v).alias("x")).dropna()
    stats = values.agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if not stats["n"] or not stats["sd"] or not math.isfinite(stats["sd"]):
        raise ValueError(f"{column} needs at least two different, finite values")
    width = stats["sd"] * stats["n"] ** -0.2
    lo, hi = stats["lo"] - cut_widths * width, stats["hi"] + cut_widths * width
    step = (hi - lo) / (points - 1) if points > 1 else 1.0
    cell = F.floor((F.col("x") - F.lit(stats["lo"])) / F.lit(CELL * width))
    middle = F.lit(stats["lo"]) + (F.col("cell") + 0.5) * F.lit(CELL * width)
    powers = [F.lit(1.0), F.col("y")]
    for k in range(2, TERMS):
        powers.append(powers[k // 2] * powers[k - k // 2])
    near = values.withColumn("cell", cell).select("cell", ((F.col("x") - middle) / F.lit(width)).alias("y"))
    cells = near.groupBy("cell").agg(*[F.sum(p).alias(f"m{k}") for k, p in enumerate(powers)])
    terms = [
        reduce(lambda a, b: a + b, [F.col(f"m{k}") * F.lit(HERMITE[k][i] / math.factorial(k)) for k in range(i, TERMS, 2)]).alias(f"c{i}")
        for i in range(TERMS)
    ]
    first = F.greatest(F.ceil((middle - F.lit(KERNEL_REACH * width + lo)) / F.lit(step)), F.lit(0)).cast("int")
    last = F.least(F.floor((middle + F.lit(KERNEL_REACH * width - lo)) / F.lit(step)), F.lit(points - 1)).cast("int")
    reached = cells.select(middle.alias("middle"), *terms, first.alias("first"), last.alias("last")).where("first <= last")
    met = reached.select("*", F.explode(F.sequence("first", "last")).alias("i"))
    met = met.withColumn("u", (F.lit(lo) + F.col("i") * F.lit(step) - F.col("middle")) / F.lit(width))
    bump = reduce(lambda total, i: total * F.col("u") + F.col(f"c{i}"), reversed(range(TERMS - 1)), F.col(f"c{TERMS - 1}"))
    sums = met.groupBy("i").agg(F.sum(F.exp(-0.5 * F.col("u") * F.col("u")) * bump).alias("s"))
    scale = 1.0 / (stats["n"] * width * math.sqrt(2 * math.pi))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i"))
    found = grid.join(sums, "i", "left").select("i", F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(0.0)).alias("s"))
    return found.select("i", (F.lit(lo) + F.col("i") * F.lit(step)).alias("x"), (F.col("s") * F.lit(scale)).alias("density"))


def area_members(labels, label="label"):
    """(province, ward) of every ``"ward | province"`` label, one row each."""
    parts = F.split(F.col(label), r"\|")
    return labels.select(F.trim(F.get(parts, F.lit(1))).alias("province"), F.trim(F.get(parts, F.lit(0))).alias("ward"))


def wards_by_province(labels, label="label"):
    """Province and its sorted wards, one list per province; ``area_members`` is the long form for any number of labels."""
    return area_members(labels, label).groupBy("province").agg(F.array_sort(F.collect_list("ward")).alias("wards"))


def binned_means(df, x, y, bins=30):
    """Mean of y over equal steps of x, for a trend line: (bin, x, mean, n) of the bins that have rows."""
    pairs = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    ends = pairs.agg(F.min("x").alias("low"), F.max("x").alias("high")).first()
    if ends["low"] is None:
        return pairs.select(F.lit(0).alias("bin"), "x", F.col("y").alias("mean"), F.lit(0).cast("long").alias("n"))
    width = (ends["high"] - ends["low"]) / bins or 1.0
    place = F.least(F.floor((F.col("x") - F.lit(ends["low"])) / F.lit(width)), F.lit(bins - 1)).cast("int")
    groups = pairs.groupBy(place.alias("bin")).agg(F.avg("y").alias("mean"), F.count(F.lit(1)).alias("n"))
    return groups.select("bin", (F.lit(ends["low"]) + (F.col("bin") + 0.5) * F.lit(width)).alias("x"), "mean", "n")


def error_metrics(df, actual, predicted, keys=()):
    """RMSE, MAE and R² of predictions, per group."""
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    return df.groupBy(*_keys(keys)).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y))).alias("r2"),
        F.count(error).alias("n"),
    )
