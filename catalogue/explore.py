from pyspark.sql import functions as F

from catalogue.registry import HOMES, homes, places, register, table
from parcelry.functions import scalar as S
from parcelry.operators import explore as X
from parcelry.operators.quantiles import group_median
from parcelry.plans import views


def located(spark, folder):
    """Listings with ward, province and unit price."""
    rows = homes(spark, folder)
    ward, province = S.ward_and_province("location")
    return rows.withColumns({"ward": ward, "province": province, "price_per_m2": S.ratio("price_million_vnd", "area_m2")})


def rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@register(
    "a1_group_range",
    f"""{HOMES} SELECT province, round(min(price_million_vnd), 6) AS min, round(max(price_million_vnd), 6) AS max, round(avg(price_million_vnd), 6) AS mean,
 count(price_million_vnd) AS count FROM homes GROUP BY province""",
)
def a1(spark, folder):
    return rounded(X.group_range(located(spark, folder), "province", "price_million_vnd"))


@register(
    "a2_group_summary",
    f"""{HOMES} SELECT province, round(avg(price_million_vnd), 6) AS avg_price, round(avg(area_m2), 6) AS avg_area, count(id) AS listings FROM homes GROUP BY province""",
)
def a2(spark, folder):
    return rounded(X.group_summary(located(spark, folder), "province", "price_million_vnd", "area_m2", "id"))


@register(
    "a3_group_median",
    f"{HOMES} SELECT ward, round(quantile_cont(price_million_vnd / area_m2, 0.5), 6) AS median FROM homes WHERE price_million_vnd / area_m2 IS NOT NULL GROUP BY ward",
)
def a3(spark, folder):
    return rounded(group_median(located(spark, folder), "ward", "price_per_m2"))


@register("a3_merged_median", "SELECT CASE WHEN r_name IN ('AFRICA', 'ASIA') THEN 'South' ELSE 'North' END AS province, round(quantile_cont(l_extendedprice, 0.5), 6) AS median FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def a3_merged(spark, folder):
    rows = table(spark, folder, "lineitem").join(places(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))
    merged = F.when(F.col("r_name").isin("AFRICA", "ASIA"), "South").otherwise("North")
    return rounded(group_median(rows.select(merged.alias("province"), "l_extendedprice"), "province", "l_extendedprice"))


@register("a4_value_counts", f"{HOMES} SELECT ward, count(*) AS count FROM homes GROUP BY ward")
def a4(spark, folder):
    return X.value_counts(located(spark, folder), "ward")


@register(
    "a5_shares",
    f"""{HOMES}, q AS (SELECT quantile_cont(price_million_vnd, 0.25) q1, quantile_cont(price_million_vnd, 0.75) q3 FROM homes),
 s AS (SELECT CASE WHEN price_million_vnd <= q1 THEN 'Low' WHEN price_million_vnd <= q3 THEN 'Mid' ELSE 'High' END AS price_segment FROM homes, q)
 SELECT price_segment, count(*) AS count, count(*) / (SELECT count(*) FROM s) AS share FROM s GROUP BY price_segment""",
)
def a5(spark, folder):
    return X.shares(views.exploration_table(homes(spark, folder)), "price_segment")


@register(
    "a6_monthly_series",
    f"""{HOMES} SELECT province, strftime(l_shipdate, '%Y-%m') AS month, count(*) AS listings, round(quantile_cont(price_million_vnd / area_m2, 0.5), 6) AS median_value
 FROM homes WHERE province IN ('ASIA', 'EUROPE') AND year(l_shipdate) = 1997 GROUP BY 1, 2""",
)
def a6(spark, folder):
    rows = located(spark, folder).withColumn("date", S.listed_at("timeline_hours"))
    rows = rows.filter(F.col("province").isin("ASIA", "EUROPE") & (F.year("date") == 1997))
    return rounded(X.monthly_series(rows, "date", "price_per_m2", "province"))


@register("a6_unit_price_by_nation", """SELECT n_name, strftime(l_shipdate, '%Y-%m') AS month, count(*) AS listings, round(quantile_cont(l_extendedprice / l_quantity, 0.5), 6) AS median_value
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2""")
def unit_price_by_nation(spark, folder):
    """Monthly line count and median unit price by nation."""
    rows = table(spark, folder, "lineitem").join(places(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.select("n_name", "l_shipdate", S.ratio("l_extendedprice", "l_quantity").alias("unit_price"))
    return rounded(X.monthly_series(rows, "l_shipdate", "unit_price", "n_name"))


@register("a7_month_counts", f"{HOMES} SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, count(*) AS listings FROM homes WHERE province = 'ASIA' GROUP BY 1")
def a7(spark, folder):
    rows = located(spark, folder).filter("province = 'ASIA'")
    day, month, year = S.date_parts(S.listed_at("timeline_hours"))
    return X.count_by_month_start(rows.select(month.alias("month"), year.alias("year")), "year", "month")


DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max,
 round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75
 FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM homes)"""
    for c in ["area_m2", "bedrooms", "bathrooms", "floors", "price_million_vnd", "timeline_hours"]
)


@register("a8_describe", f"{HOMES} {DESCRIBE}")
def a8(spark, folder):
    return rounded(X.describe(homes(spark, folder, located=False).drop("key")))


@register(
    "a9_null_profile",
    f"""{HOMES}, a AS (UNPIVOT (SELECT count(*) - count(id) AS id, count(*) - count(area_m2) AS area_m2, count(*) - count(floors) AS floors FROM homes) ON COLUMNS(*) INTO NAME "column" VALUE left_missing),
 b AS (UNPIVOT (SELECT count(*) - count(id) AS id, count(*) - count(area_m2) AS area_m2, count(*) - count(bedrooms) AS bedrooms FROM homes WHERE key % 2 = 0) ON COLUMNS(*) INTO NAME "column" VALUE right_missing)
 SELECT coalesce(a."column", b."column") AS "column", left_missing, right_missing FROM a FULL JOIN b ON b."column" = a."column" """,
)
def a9(spark, folder):
    rows = homes(spark, folder, located=False)
    return X.compare_null_profiles(rows.select("id", "area_m2", "floors"), rows.filter("key % 2 = 0").select("id", "area_m2", "bedrooms"))


@register("a10_duplicate_rows", "SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)) AS duplicates")
def a10(spark, folder):
    from parcelry.operators.clean import duplicate_rows

    return duplicate_rows(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@register("a11_drop_duplicates", f"{HOMES} SELECT DISTINCT key, bedrooms, frontage FROM homes")
def a11(spark, folder):
    from parcelry.operators.clean import drop_duplicate_rows

    return drop_duplicate_rows(homes(spark, folder, located=False).select("key", "bedrooms", "frontage"))


@register("a12_collapse_rate", "SELECT count(CASE WHEN c < 4 THEN 1 END) / count(*) AS collapse_rate FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey)")
def a12(spark, folder):
    return X.collapse_rate(table(spark, folder, "lineitem").groupBy("l_orderkey").count(), 4)


@register("a13_sorted_values", "SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS month FROM lineitem")
def a13(spark, folder):
    return X.sorted_values(table(spark, folder, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month")), "month")


PAIRS = ["area_m2", "bedrooms", "bathrooms", "floors", "price_million_vnd"]


@register(
    "a14_correlations",
    HOMES + " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM homes" for a in PAIRS for b in PAIRS),
)
def a14(spark, folder):
    return rounded(X.correlations(homes(spark, folder, located=False).drop("key")))


@register(
    "a15_regression_line",
    f"""{HOMES} SELECT round(regr_slope(price_million_vnd, area_m2), 6) AS slope, round(regr_intercept(price_million_vnd, area_m2), 4) AS intercept,
 round(regr_r2(price_million_vnd, area_m2), 6) AS r2, CAST(regr_count(price_million_vnd, area_m2) AS BIGINT) AS n FROM homes""",
)
def a15(spark, folder):
    line = X.regression_line(homes(spark, folder, located=False), "area_m2", "price_million_vnd")
    return line.select(F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 6).alias("r2"), "n")


def box_sql(source, key, value):
    return f""", b AS (SELECT {key}, CAST({value} AS DOUBLE) AS v FROM {source} WHERE {value} IS NOT NULL AND {key} IS NOT NULL),
 q AS (SELECT {key}, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM b GROUP BY {key})
 SELECT {key}, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
 round(min(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END), 6) AS whisker_low,
 round(max(CASE WHEN v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN v END), 6) AS whisker_high,
 count(CASE WHEN NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
 FROM b JOIN q USING ({key}) GROUP BY {key}, n, q1, median, q3"""


@register("a16_box_stats", HOMES + box_sql("homes", "floors", "price_million_vnd"))
def a16(spark, folder):
    return rounded(X.box_stats(homes(spark, folder, located=False), "floors", "price_million_vnd"))


@register("a16_event_boxes", "WITH src AS (SELECT event_type, value FROM events)" + box_sql("src", "event_type", "value"))
def a16_events(spark, folder):
    return rounded(X.box_stats(table(spark, folder, "events"), "event_type", "value"))


def histogram_sql(source, value, bins):
    return f"""WITH v AS (SELECT CAST({value} AS DOUBLE) AS x FROM {source}), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
 c AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin, count(*) AS n FROM v, e GROUP BY 1)
 SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / {bins}), 6) AS left_edge, round(lo + (i + 1) * ((hi - lo) / {bins}), 6) AS right_edge, coalesce(n, 0) AS n
 FROM (SELECT unnest(range({bins})) AS i), e LEFT JOIN c ON bin = i"""


@register("a17_histogram", histogram_sql("lineitem", "l_extendedprice", 50))
def a17(spark, folder):
    return rounded(X.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 50))


@register("a17_log_histogram", histogram_sql("orders", "ln(1 + o_totalprice)", 30))
def a17_log(spark, folder):
    return rounded(X.histogram(table(spark, folder, "orders").select(F.log1p("o_totalprice").alias("x")), "x", 30))


@register(
    "a18_quartile_histograms",
    """WITH q AS (SELECT quantile_cont(value, 0.25) q1, quantile_cont(value, 0.5) q2, quantile_cont(value, 0.75) q3 FROM events WHERE value >= 0),
 v AS (SELECT value AS x, CASE WHEN value <= q1 THEN 1 WHEN value <= q2 THEN 2 WHEN value <= q3 THEN 3 ELSE 4 END AS quarter FROM events, q WHERE value > 0),
 e AS (SELECT quarter, min(x) lo, max(x) hi, count(*) AS n_quarter FROM v GROUP BY quarter),
 c AS (SELECT quarter, least(floor((x - lo) / (hi - lo) * 15), 14) AS bin, count(*) AS n FROM v JOIN e USING (quarter) GROUP BY 1, 2)
 SELECT e.quarter AS quarter, CAST(i AS INTEGER) AS bin, coalesce(c.n, 0) AS n FROM e CROSS JOIN (SELECT unnest(range(15)) AS i)
 LEFT JOIN c ON c.quarter = e.quarter AND c.bin = i""",
)
def a18(spark, folder):
    return X.quartile_histograms(table(spark, folder, "events"), "value").select("quarter", "bin", "n")


@register(
    "a19_fixed_bins",
    f"""{HOMES} SELECT CAST(p AS INTEGER) AS position, l AS label, count(floors) AS n FROM
 (VALUES (0, '1', 0, 1), (1, '2', 1, 2), (2, '3', 2, 3), (3, '4', 3, 4), (4, '5', 4, 5), (5, '6+', 5, 10)) t(p, l, lo, hi)
 LEFT JOIN homes ON floors > lo AND floors <= hi GROUP BY p, l""",
)
def a19(spark, folder):
    return X.binned_counts(homes(spark, folder, located=False), "floors")


@register(
    "a20_density",
    """WITH w AS (SELECT p_retailprice AS x, count(*) AS w FROM part GROUP BY 1),
 s AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi, stddev_samp(p_retailprice) * pow(count(*), -0.2) AS h, count(*) AS n FROM part),
 g AS (SELECT CAST(i AS INTEGER) AS i, lo + i * ((hi - lo) / 49) AS x FROM (SELECT unnest(range(50)) AS i), s)
 SELECT g.i, round(g.x, 6) AS x, round(sum(w.w * exp(-0.5 * pow((g.x - w.x) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi())), 9) AS density FROM g, w, s GROUP BY g.i, g.x""",
)
def a20(spark, folder):
    found = X.density(table(spark, folder, "part"), "p_retailprice", points=50)
    return found.select("i", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@register(
    "a20_density_events",
    """WITH w AS (SELECT value AS x, count(*) AS w FROM events GROUP BY 1),
 s AS (SELECT min(value) AS lo, max(value) AS hi, stddev_samp(value) * pow(count(*), -0.2) AS h, count(*) AS n FROM events),
 g AS (SELECT CAST(i AS INTEGER) AS i, lo - 3 * h + i * ((hi - lo + 6 * h) / 199) AS x FROM (SELECT unnest(range(200)) AS i), s)
 SELECT g.i, round(g.x, 6) AS x, round(sum(w.w * exp(-0.5 * pow((g.x - w.x) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi())), 9) AS density FROM g, w, s GROUP BY g.i, g.x""",
)
def a20_events(spark, folder):
    """The default 200 points, three bandwidths beyond both ends, over values of which nearly every one is different."""
    found = X.density(table(spark, folder, "events"), "value", cut_widths=3.0)
    return found.select("i", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@register("a21_inverted_dictionary", "SELECT r_name AS province, list_sort(list(n_name)) AS wards FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def a21(spark, folder):
    area = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return X.wards_by_province(area.select(S.area_key("n_name", "r_name").alias("label")))


@register("a21_area_members", "SELECT r_name AS province, n_name AS ward FROM nation JOIN region ON n_regionkey = r_regionkey")
def a21_long(spark, folder):
    area = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return X.area_members(area.select(S.area_key("n_name", "r_name").alias("label")))


METRICS = """round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
 round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2, count(*) AS n"""


@register(
    "a22_error_metrics",
    f"SELECT l_returnflag, {METRICS} FROM (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem) GROUP BY l_returnflag",
)
def a22(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    return metric_row(X.error_metrics(rows, "y", "p", "l_returnflag"))


def metric_row(df):
    digits = {"rmse": 4, "mae": 4, "r2": 6}
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


@register(
    "a15_binned_means",
    """WITH ends AS (SELECT min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem)
SELECT CAST(least(floor((l_quantity - low) / ((high - low) / 12)), 11) AS INTEGER) AS bin, round(any_value(low) + (least(floor((l_quantity - low) / ((high - low) / 12)), 11) + 0.5) * any_value((high - low) / 12), 6) AS x,
 round(avg(l_extendedprice), 4) AS mean, count(*) AS n FROM lineitem, ends GROUP BY 1, least(floor((l_quantity - low) / ((high - low) / 12)), 11)""",
)
def a15_bins(spark, folder):
    """Trend of price over quantity in twelve steps."""
    found = X.binned_means(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", 12)
    return found.select("bin", F.round("x", 6).alias("x"), F.round("mean", 4).alias("mean"), "n")
