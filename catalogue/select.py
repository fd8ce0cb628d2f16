from pyspark.sql import functions as F

from catalogue.registry import HOMES, homes, register, table
from parcelry.functions import scalar as S
from parcelry.operators import clean, explore
from parcelry.plans import views
from parcelry.plans.features import CAPS
from parcelry.schema import ROOM_COLUMNS


@register("p1_drop_columns", f"{HOMES} SELECT id, area_m2, bedrooms, bathrooms, floors FROM homes")
def p1(spark, folder):
    return views.topic(homes(spark, folder, located=False).drop("title", "detail_url"), views.SIZE)


@register(
    "p2_split_column",
    "SELECT p_partkey, split_part(p_name, ' ', 1) AS color, nullif(split_part(p_name, ' ', 2), '') AS thing, CAST(NULL AS VARCHAR) AS rest FROM part",
)
def p2(spark, folder):
    return clean.split_column(table(spark, folder, "part").select("p_partkey", "p_name"), "p_name", ["color", "thing", "rest"], " ").drop("p_name")


@register("p3_ward_province", f"{HOMES} SELECT id, CASE WHEN key % 3 = 0 THEN 'x' ELSE ward END AS ward, CASE WHEN key % 3 <> 0 THEN province || ', VN' END AS province FROM homes")
def p3(spark, folder):
    rows = homes(spark, folder)
    location = F.when(F.col("key") % 3 == 0, F.lit(" x ")).otherwise(F.concat(F.col("location"), F.lit(", VN")))
    ward, province = S.ward_and_province(location)
    return rows.select("id", ward.alias("ward"), province.alias("province"))


@register("p4_strip_strings", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def p4(spark, folder):
    pad = F.lit(" \t \n")
    rows = table(spark, folder, "customer").select(
        "c_custkey", F.concat(pad, "c_name", pad).alias("c_name"), F.concat(F.col("c_mktsegment"), pad).alias("c_mktsegment")
    )
    return clean.strip_strings(rows)


@register("p5_mask_negatives", "SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer")
def p5(spark, folder):
    return clean.mask_negatives(table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal"))


@register("p6_drop_all_missing", f"{HOMES} SELECT id, bedrooms, bathrooms, floors FROM homes WHERE NOT (bedrooms IS NULL AND bathrooms IS NULL AND floors IS NULL)")
def p6(spark, folder):
    return clean.drop_all_missing(homes(spark, folder, located=False).select("id", *ROOM_COLUMNS), ROOM_COLUMNS)


GAPS = "(CASE WHEN bedrooms IS NULL THEN 1 ELSE 0 END + CASE WHEN bathrooms IS NULL THEN 1 ELSE 0 END + CASE WHEN floors IS NULL THEN 1 ELSE 0 END)"


@register(
    "p7_drop_sparse",
    f"{HOMES} SELECT id, area_m2, price_million_vnd FROM homes WHERE NOT (area_m2 IS NULL AND {GAPS} >= 2) AND NOT (price_million_vnd IS NULL AND {GAPS} >= 2)",
)
def p7(spark, folder):
    rows = homes(spark, folder, located=False)
    for lead in ("area_m2", "price_million_vnd"):
        rows = clean.drop_sparse_where_missing(rows, lead, ROOM_COLUMNS)
    return rows.select("id", "area_m2", "price_million_vnd")


@register("p8_positive_price", f"{HOMES} SELECT id, price_million_vnd FROM homes WHERE price_million_vnd > 0")
def p8(spark, folder):
    return homes(spark, folder, located=False).filter("price_million_vnd > 0").select("id", "price_million_vnd")


@register(
    "p9_quantile_caps",
    f"""{HOMES}, q AS (SELECT quantile_cont(CAST(floors AS DOUBLE), 0.995) f, quantile_cont(CAST(area_m2 AS DOUBLE), 0.98) a,
 quantile_cont(CAST(bedrooms AS DOUBLE), 0.99) b, quantile_cont(CAST(bathrooms AS DOUBLE), 0.99) w FROM homes)
SELECT id, area_m2, bedrooms, bathrooms, floors FROM homes, q WHERE (floors <= f OR floors IS NULL) AND (area_m2 <= a OR area_m2 IS NULL)
 AND (bedrooms <= b OR bedrooms IS NULL) AND (bathrooms <= w OR bathrooms IS NULL)""",
)
def p9(spark, folder):
    rows = homes(spark, folder, located=False).select(*views.SIZE)
    return clean.cap_at_quantiles(rows, CAPS)


@register("p10_membership", f"{HOMES} SELECT id, province FROM homes WHERE province IN ('ASIA', 'EUROPE') AND year(l_shipdate) = 1998")
def p10(spark, folder):
    rows = homes(spark, folder)
    ward, province = S.ward_and_province("location")
    year = S.date_parts(S.listed_at("timeline_hours"))[2]
    rows = rows.select("id", province.alias("province"), year.alias("year"))
    return views.regional(rows.filter("year = 1998"), ["ASIA", "EUROPE"]).select("id", "province")


@register("p11_open_interval", f"{HOMES} SELECT id, area_m2 FROM homes WHERE area_m2 > 0 AND area_m2 < 400")
def p11(spark, folder):
    return homes(spark, folder, located=False).filter("area_m2 > 0 AND area_m2 < 400").select("id", "area_m2")


@register(
    "p12_compare_columns",
    """SELECT CAST(coalesce(a.column_index, b.column_index) AS INTEGER) AS position, a.column_name AS left_column, b.column_name AS right_column FROM
 (SELECT row_number() OVER () - 1 AS column_index, column_name FROM (DESCRIBE orders)) a FULL JOIN
 (SELECT row_number() OVER () - 1 AS column_index, column_name FROM (DESCRIBE customer)) b ON a.column_index = b.column_index""",
)
def p12(spark, folder):
    return explore.compare_columns(table(spark, folder, "orders"), table(spark, folder, "customer"))


@register("p13_preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def p13(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(5)
