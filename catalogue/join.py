from pyspark.sql import functions as F

from catalogue.registry import HOMES, homes, places, register, table
from parcelry.operators import joins
from parcelry.operators.prep import OneHotEncoding
from parcelry.operators.reshape import top_k
from parcelry.plans.scoring import SENSITIVITY


@register(
    "j1_join_views",
    "SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def j1(spark, folder):
    price = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_extendedprice")
    place = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), "o_orderpriority")
    return joins.join_views(price, place).withColumnRenamed("id", "l_orderkey")


@register(
    "j1_hot_id",
    """WITH t AS (SELECT l_returnflag, l_linestatus, count(*) AS n_lines, min(l_shipdate) AS first_shipped FROM lineitem GROUP BY ALL)
 SELECT l_returnflag, l_orderkey, l_linenumber, l.l_linestatus AS l_linestatus, t.l_linestatus AS other_status, n_lines, first_shipped
 FROM lineitem l JOIN t USING (l_returnflag)""",
)
def j1_hot(spark, folder):
    """Lines with the totals of their return flag, three ids that hold all rows; a grid of cells shares them out."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate")
    totals = lines.groupBy("l_returnflag", F.col("l_linestatus").alias("other_status")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("l_shipdate").alias("first_shipped")
    )
    return joins.join_views(lines.drop("l_shipdate"), totals, "l_returnflag")


TOP = "top AS (SELECT s_nationkey AS n FROM supplier JOIN lineitem ON s_suppkey = l_suppkey GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)"


def busy_nations(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    rows = rows.join(table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select("l_orderkey", "l_extendedprice", "s_nationkey")


@register(
    "j2_keep_top_wards",
    f"WITH {TOP} SELECT l_orderkey, l_extendedprice, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey IN (SELECT n FROM top)",
)
def j2(spark, folder):
    rows = busy_nations(spark, folder)
    return joins.keep_matching(rows, top_k(rows, "s_nationkey", 10), "s_nationkey").select("l_orderkey", "l_extendedprice", "s_nationkey")


@register(
    "j3_drop_top_wards",
    f"WITH {TOP} SELECT l_orderkey, l_extendedprice, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey NOT IN (SELECT n FROM top)",
)
def j3(spark, folder):
    rows = busy_nations(spark, folder)
    return joins.drop_matching(rows, top_k(rows, "s_nationkey", 10), "s_nationkey").select("l_orderkey", "l_extendedprice", "s_nationkey")


@register(
    "j4_translate",
    f"""{HOMES} SELECT id, CASE WHEN key % 4 = 0 OR province IN ('AFRICA', 'MIDDLE EAST') THEN 'Other' WHEN province IN ('AMERICA', 'ASIA') THEN 'Pacific' ELSE 'Atlantic' END AS merged FROM homes""",
)
def j4(spark, folder):
    """Regions renamed by a dictionary; case and outer spaces do not matter, every fourth order has no region."""
    names = joins.renaming_table(spark, {"Pacific": ["America", "Asia"], "Atlantic": ["Europe", "Asia"]})
    rows = homes(spark, folder).select("id", "key", F.lower(F.split("location", ", ")[1]).alias("region"))
    region = F.when(F.col("key") % 4 != 0, F.concat(F.lit(" "), "region"))
    return joins.translate(rows.select("id", region.alias("region")), "region", names, "merged").select("id", "merged")


@register(
    "j5_grid",
    """SELECT n_name AS ward, r_name AS province, CAST(month AS INTEGER) AS month, CAST(floors AS INTEGER) AS floors FROM
 (SELECT DISTINCT n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
 (SELECT unnest(range(1, 13)) AS month), (SELECT unnest(range(1, 8)) AS floors)""",
)
def j5(spark, folder):
    wards = places(spark, folder).select(F.col("n_name").alias("ward"), F.col("r_name").alias("province")).distinct()
    months = spark.range(1, 13).select(F.col("id").cast("int").alias("month"))
    floors = spark.createDataFrame([(v,) for v in SENSITIVITY["floors"]], "floors int")
    return joins.grid(wards, months, floors)


@register(
    "j6_stack_frames",
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
 UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def j6(spark, folder):
    a = table(spark, folder, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    b = table(spark, folder, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS key")
    return joins.stack_frames(a, b)


@register(
    "j7_append_columns",
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS "o_orderstatus_F", CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O",
 CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders""",
)
def j7(spark, folder):
    return OneHotEncoding("o_orderstatus").fit_transform(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"))
