from pyspark.sql import functions as F

from catalogue.registry import HOMES, homes, register, table
from parcelry.functions import scalar as S
from parcelry.operators.prep import RobustScaling
from parcelry.operators.prep.encoders import collapse_rare
from parcelry.plans import features as plan


@register(
    "e1_collapse_rare",
    f"""{HOMES}, c AS (SELECT ward || ' | ' || province || ' ' || CAST(floors AS VARCHAR) AS combo, * FROM homes), n AS (SELECT combo, count(*) AS n FROM c GROUP BY combo)
 SELECT id, CASE WHEN n < 260 THEN 'OtherWard | ' || province ELSE combo END AS clean FROM c LEFT JOIN n USING (combo)""",
)
def e1(spark, folder):
    ward, province = S.ward_and_province("location")
    combo = F.concat(S.area_key(ward, province), F.lit(" "), F.col("floors").cast("string"))
    rows = homes(spark, folder).select("id", province.alias("province"), combo.alias("combo"))
    return collapse_rare(rows, "combo", 260, F.concat(F.lit("OtherWard | "), "province"), "clean").select("id", "clean")


@register("e2_area_key", f"{HOMES} SELECT id, CASE WHEN key % 3 = 0 THEN 'Unknown' ELSE ward END || ' | ' || CASE WHEN key % 4 = 0 THEN 'Unknown' ELSE province END AS area FROM homes")
def e2(spark, folder):
    ward, province = S.ward_and_province("location")
    key = F.col("key")
    return homes(spark, folder).select("id", S.area_key(F.when(key % 3 != 0, ward), F.when(key % 4 != 0, province)).alias("area"))


@register("e3_listed_at", f"{HOMES} SELECT id, CASE WHEN key % 5 <> 0 THEN TIMESTAMP '2025-09-21 00:00:00' - to_hours(timeline_hours + 7) END AS date FROM homes")
def e3(spark, folder):
    hours = F.when(F.col("key") % 5 != 0, F.col("timeline_hours") + 7)
    return homes(spark, folder, located=False).select("id", S.listed_at(hours).alias("date"))


@register(
    "e4_date_parts",
    "SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS day, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
)
def e4(spark, folder):
    day, month, year = S.date_parts("o_orderdate")
    return table(spark, folder, "orders").select("o_orderkey", day.alias("day"), month.alias("month"), year.alias("year"))


@register("e5_month_start", "SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start FROM orders")
def e5(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", S.month_start(F.year("o_orderdate"), F.month("o_orderdate")).alias("month_start"))


ANGLE = "2 * pi() * day(d) / day(last_day(d))"


@register(
    "e6_cyclic_dates",
    f"""SELECT o_orderkey, round(sin({ANGLE}), 9) AS day_sin, round(cos({ANGLE}), 9) AS day_cos, round(sin(2 * pi() * month(d) / 12), 9) AS month_sin,
 round(cos(2 * pi() * month(d) / 12), 9) AS month_cos FROM (SELECT o_orderkey, o_orderdate AS d FROM orders)""",
)
def e6(spark, folder):
    d = F.col("o_orderdate")
    rows = table(spark, folder, "orders").select("o_orderkey", F.dayofmonth(d).alias("day"), F.month(d).alias("month"), F.year(d).alias("year"))
    names = ["day_sin", "day_cos", "month_sin", "month_cos"]
    # Adding zero turns a rounded -0.0 into 0.0.
    return plan.cyclic_dates(rows).select("o_orderkey", *[(F.round(c, 9) + F.lit(0.0)).alias(c) for c in names])


@register("e7_log_price", f"{HOMES} SELECT id, round(ln(1 + price_million_vnd), 9) AS log_price, round(price_million_vnd, 6) AS back FROM homes")
def e7(spark, folder):
    rows = homes(spark, folder, located=False).withColumn("l", F.log1p("price_million_vnd"))
    return rows.select("id", F.round("l", 9).alias("log_price"), F.round(F.expm1("l"), 6).alias("back"))


@register("e8_unscale", "SELECT o_orderkey, CAST(year(o_orderdate) AS DOUBLE) AS year FROM orders")
def e8(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    step = RobustScaling(["year"]).fit(rows)
    return step.inverse_transform(step.transform(rows)).withColumn("year", F.round("year", 6))


@register("e9_unit_price", f"{HOMES} SELECT id, price_million_vnd / nullif(area_m2 - 80, 0) AS unit_price FROM homes")
def e9(spark, folder):
    return homes(spark, folder, located=False).select("id", S.ratio("price_million_vnd", F.col("area_m2") - 80).alias("unit_price"))


@register(
    "e10_price_segment",
    f"""{HOMES}, q AS (SELECT quantile_cont(price_million_vnd, 0.25) q1, quantile_cont(price_million_vnd, 0.75) q3 FROM homes)
 SELECT id, CASE WHEN price_million_vnd <= q1 THEN 'Low' WHEN price_million_vnd <= q3 THEN 'Mid' ELSE 'High' END AS price_segment FROM homes, q""",
)
def e10(spark, folder):
    from parcelry.plans.views import exploration_table

    return exploration_table(homes(spark, folder)).select("id", "price_segment")


@register("e11_flag", f"{HOMES} SELECT id, CAST(coalesce(frontage, false) AS INTEGER) AS frontage FROM homes")
def e11(spark, folder):
    return homes(spark, folder, located=False).select("id", S.flag("frontage").alias("frontage"))


@register("e12_floor_at", "SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN greatest(c_acctbal, 1.0) END AS balance FROM customer")
def e12(spark, folder):
    value = F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal"))
    return table(spark, folder, "customer").select("c_custkey", S.at_least(value, 1.0).alias("balance"))


@register("e13_residual", "SELECT l_orderkey, l_partkey, l_extendedprice - l_quantity * 1500 AS residual FROM lineitem")
def e13(spark, folder):
    return table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", (F.col("l_extendedprice") - F.col("l_quantity") * 1500).alias("residual"))


@register("e14_strip_prefix", "SELECT DISTINCT 'ward_province_clean_' || p_brand AS key, p_brand AS label FROM part")
def e14(spark, folder):
    from parcelry.operators.prep import OneHotEncoding

    brands = table(spark, folder, "part").select(F.col("p_brand").alias("ward_province_clean"))
    return plan.area_labels(OneHotEncoding("ward_province_clean").fit_transform(brands))
