from pyspark.sql import functions as F

from catalogue.registry import register, table
from parcelry.operators import ranks, resample, reshape as R
from parcelry.operators.quantiles import group_median
from parcelry.operators.regression import bootstrap_line_band


@register("w1_top_k", "SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def w1(spark, folder):
    return R.top_k(table(spark, folder, "lineitem"), "l_partkey", 20)


@register("w2_sorted_medians", "SELECT p_brand, round(quantile_cont(l_extendedprice, 0.5), 6) AS median FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY 2 DESC, 1")
def w2(spark, folder):
    rows = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return group_median(rows, "p_brand", "l_extendedprice").withColumn("median", F.round("median", 6)).orderBy(F.desc("median"), "p_brand")


@register("w3_random_rest")
def w3(spark, folder):
    """20 nations' worth of parts drawn from those outside the 20 most frequent."""
    parts = table(spark, folder, "lineitem").select("l_partkey")
    counts = parts.groupBy("l_partkey").count()
    rest = counts.join(R.top_k(parts, "l_partkey", 20).select("l_partkey"), "l_partkey", "left_anti")
    return R.random_k(rest, "l_partkey", 20)


@register("w4_sample")
def w4(spark, folder):
    return R.sample_fraction(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 0.2)


UNIT = R.id_unit_sql("o_orderkey")


@register("w5_split", f"SELECT o_orderkey, o_totalprice, CASE WHEN {UNIT} < 0.2 THEN 'test' ELSE 'train' END AS part FROM orders")
def w5(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    train, test = R.train_test_split(rows, R.id_unit("o_orderkey"))
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@register("w6_folds", f"SELECT o_orderkey, CAST(floor({UNIT} * 5) AS INTEGER) AS fold FROM orders")
def w6(spark, folder):
    return R.with_fold(table(spark, folder, "orders").select("o_orderkey"), R.id_unit("o_orderkey"))


@register("w7_bootstrap_band")
def w7(spark, folder):
    """Band around the line of price on quantity from 100 resamples of the line items."""
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return bootstrap_line_band(rows, ["l_orderkey", "l_linenumber", "l_partkey"], "l_quantity", "l_extendedprice", [1, 10, 25, 50])


@register(
    "w8_melt",
    """SELECT l_returnflag, metric, round(score, 6) AS score FROM (UNPIVOT (SELECT l_returnflag, avg(l_quantity) AS quantity, avg(l_discount) AS discount, avg(l_tax) AS tax FROM lineitem GROUP BY 1)
 ON quantity, discount, tax INTO NAME metric VALUE score)""",
)
def w8(spark, folder):
    wide = table(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.avg("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"))
    return R.melt(wide, "l_returnflag", ["quantity", "discount", "tax"], "metric", "score").withColumn("score", F.round("score", 6))


@register(
    "w9_largest_column",
    """SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber >= greatest(l_quantity / 8, l_discount * 60) THEN 'a' WHEN l_quantity / 8 >= l_discount * 60 THEN 'b' ELSE 'c' END AS largest FROM lineitem""",
)
def w9(spark, folder):
    from parcelry.functions.scalar import largest_column

    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_linenumber").cast("double").alias("a"), (F.col("l_quantity") / 8).alias("b"), (F.col("l_discount") * 60).alias("c")
    )
    return rows.select("l_orderkey", "l_partkey", largest_column(["a", "b", "c"]).alias("largest"))


@register("w4_sample_by_id", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {UNIT} < 0.05")
def w4_by_id(spark, folder):
    """The sample by plain arithmetic on whole-number ids."""
    return table(spark, folder, "orders").select("o_orderkey", "o_totalprice").filter(R.id_unit("o_orderkey") < 0.05)


RANKED = f"r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY {UNIT}, o_orderkey) AS place, count(*) OVER () AS n FROM orders)"


@register("w4_exact_sample", f"WITH {RANKED} SELECT o_orderkey, o_totalprice FROM r WHERE place <= round_even(0.05 * n, 0)")
def w4_exact(spark, folder):
    """Exactly a twentieth of the orders."""
    return ranks.exact_sample(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), R.id_unit("o_orderkey"), "o_orderkey", 0.05)


@register("w5_exact_split", f"WITH {RANKED} SELECT o_orderkey, o_totalprice, CASE WHEN place <= ceil(n / 5) THEN 'test' ELSE 'train' END AS part FROM r")
def w5_exact(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    train, test = ranks.exact_split(rows, R.id_unit("o_orderkey"), "o_orderkey")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@register("w6_exact_folds", f"WITH {RANKED}, f AS (SELECT *, n // 5 AS size, n % 5 AS more FROM r) SELECT o_orderkey, CAST(CASE WHEN place <= more * (size + 1) THEN (place - 1) // (size + 1) ELSE more + (place - 1 - more * (size + 1)) // size END AS INTEGER) AS fold FROM f")
def w6_exact(spark, folder):
    """Five folds whose sizes differ by one row at most."""
    return ranks.exact_folds(table(spark, folder, "orders").select("o_orderkey"), R.id_unit("o_orderkey"), "o_orderkey")


@register("w7_resample_sizes", "SELECT CAST(r AS INTEGER) AS replicate, n FROM (SELECT unnest(range(20)) AS r), (SELECT count(*) AS n FROM orders)")
def w7_sizes(spark, folder):
    """Draws of each of 20 resamples of the orders: as many as there are orders."""
    drawn = resample.resample(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), 20)
    return drawn.groupBy("replicate").agg(F.sum("weight").alias("n"))
