"""The named queries, and the listing-shaped inputs they derive from the given tables."""

from pyspark.sql import functions as F

QUERIES = {}
CHECKS = {}


def register(name, sql=None):
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return keep


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hollow(condition, value):
    """``value``, missing where the condition holds."""
    return F.when(~condition, value)


def places(spark, folder):
    """Supplier with its nation (as the ward) and region (as the province)."""
    supplier, nation, region = (table(spark, folder, t) for t in ("supplier", "nation", "region"))
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("s_suppkey", "n_name", "r_name")


def title_of():
    n, kind = F.col("l_linenumber").cast("string"), F.col("l_orderkey") % 5
    return (
        F.when(kind == 0, F.concat(F.lit("Bán nhà "), n, F.lit(" tầng mặt tiền")))
        .when(kind == 1, F.concat(F.lit("Nhà "), n, F.lit(" lầu 1 trệt")))
        .when(kind == 2, F.concat(F.lit("Căn hộ tầng "), n))
        .when(kind == 3, F.lit("Nhà MẶT  PHỐ đẹp"))
        .otherwise(F.lit("Đất nền giá tốt"))
    )


def homes(spark, folder, located=True):
    """Line items as listings: measures with gaps, a title, an age and, if wanted, a location."""
    rows = table(spark, folder, "lineitem")
    if located:
        rows = rows.join(places(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))
    days = F.datediff(F.lit("2025-09-21").cast("date"), F.col("l_shipdate").cast("date"))
    columns = [
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string").alias("id"),
        F.concat(F.lit("/p/"), F.col("l_orderkey").cast("string")).alias("detail_url"),
        title_of().alias("title"),
        (days * 24).alias("timeline_hours"),
        hollow(F.col("l_orderkey") % 11 == 0, F.col("l_quantity").cast("int") * 8).alias("area_m2"),
        hollow(F.col("l_partkey") % 7 == 0, F.col("l_linenumber")).alias("bedrooms"),
        hollow(F.col("l_suppkey") % 5 == 0, F.round(F.col("l_discount") * 100).cast("int")).alias("bathrooms"),
        hollow(F.col("l_orderkey") % 6 == 0, F.round(F.col("l_tax") * 100).cast("int") + 1).alias("floors"),
        hollow(F.col("l_orderkey") % 13 == 0, F.col("l_returnflag") == "R").alias("frontage"),
        hollow(F.col("l_partkey") % 17 == 0, F.col("l_extendedprice") / 10).alias("price_million_vnd"),
        F.col("l_orderkey").alias("key"),
    ]
    if located:
        columns.insert(3, F.concat("n_name", F.lit(", "), "r_name").alias("location"))
    return rows.select(*columns)


HOMES = """WITH homes AS (
SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS id,
  '/p/' || CAST(l_orderkey AS VARCHAR) AS detail_url,
  CASE l_orderkey % 5 WHEN 0 THEN 'Bán nhà ' || CAST(l_linenumber AS VARCHAR) || ' tầng mặt tiền'
    WHEN 1 THEN 'Nhà ' || CAST(l_linenumber AS VARCHAR) || ' lầu 1 trệt'
    WHEN 2 THEN 'Căn hộ tầng ' || CAST(l_linenumber AS VARCHAR)
    WHEN 3 THEN 'Nhà MẶT  PHỐ đẹp' ELSE 'Đất nền giá tốt' END AS title,
  n_name || ', ' || r_name AS location, n_name AS ward, r_name AS province,
  CAST(date_diff('day', CAST(l_shipdate AS DATE), DATE '2025-09-21') * 24 AS INTEGER) AS timeline_hours,
  CASE WHEN l_orderkey % 11 <> 0 THEN CAST(l_quantity AS INTEGER) * 8 END AS area_m2,
  CASE WHEN l_partkey % 7 <> 0 THEN l_linenumber END AS bedrooms,
  CASE WHEN l_suppkey % 5 <> 0 THEN CAST(round(l_discount * 100) AS INTEGER) END AS bathrooms,
  CASE WHEN l_orderkey % 6 <> 0 THEN CAST(round(l_tax * 100) AS INTEGER) + 1 END AS floors,
  CASE WHEN l_orderkey % 13 <> 0 THEN l_returnflag = 'R' END AS frontage,
  CASE WHEN l_partkey % 17 <> 0 THEN l_extendedprice / 10 END AS price_million_vnd,
  l_orderkey AS key, l_shipdate
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""
