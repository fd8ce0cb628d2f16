from pyspark.sql import functions as F

from catalogue.explore import rounded
from catalogue.registry import HOMES, homes, register, table
from parcelry.operators import clean, prep

MEASURES = ["area_m2", "bedrooms", "bathrooms", "floors"]


def fences(column):
    return f"""BETWEEN (SELECT quantile_cont(CAST({column} AS DOUBLE), 0.25) - 1.5 * (quantile_cont(CAST({column} AS DOUBLE), 0.75) - quantile_cont(CAST({column} AS DOUBLE), 0.25)) FROM homes)
 AND (SELECT quantile_cont(CAST({column} AS DOUBLE), 0.75) + 1.5 * (quantile_cont(CAST({column} AS DOUBLE), 0.75) - quantile_cont(CAST({column} AS DOUBLE), 0.25)) FROM homes)"""


@register(
    "f1_chained_steps",
    f"""{HOMES}, k AS (SELECT id, price_million_vnd AS p, bedrooms AS b FROM homes WHERE price_million_vnd {fences('price_million_vnd')}),
 z AS (SELECT id, p, b FROM k WHERE abs((b - (SELECT avg(b) FROM k)) / (SELECT stddev_samp(b) FROM k)) < 2)
 SELECT id, round((p - (SELECT avg(p) FROM z)) / (SELECT stddev_pop(p) FROM z), 6) AS price_million_vnd,
 round((b - (SELECT min(b) FROM z)) / (SELECT max(b) - min(b) FROM z), 6) AS bedrooms FROM z""",
)
def f1(spark, folder):
    steps = prep.PreprocessingPipeline(
        [
            prep.IQRMethod(["price_million_vnd"]),
            prep.ZScoreMethod(["bedrooms"]),
            prep.StandardScaling(["price_million_vnd"]),
            prep.MinMaxScaling(["bedrooms"]),
        ]
    )
    return rounded(steps.fit_transform(homes(spark, folder, located=False).select("id", "price_million_vnd", "bedrooms")))


@register("f2_iqr_filter", f"{HOMES} SELECT id, area_m2, price_million_vnd FROM homes WHERE area_m2 {fences('area_m2')} AND price_million_vnd {fences('price_million_vnd')}")
def f2(spark, folder):
    return prep.IQRMethod(["area_m2", "price_million_vnd"]).fit_transform(homes(spark, folder, located=False).select("id", "area_m2", "price_million_vnd"))


@register(
    "f3_zscore_filter",
    "SELECT event_id, value FROM events WHERE abs((value - (SELECT avg(value) FROM events)) / (SELECT stddev_samp(value) FROM events)) < 2",
)
def f3(spark, folder):
    return prep.ZScoreMethod("value", threshold=2).fit_transform(table(spark, folder, "events").select("event_id", "value"))


@register("f4_label_codes", "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS o_orderpriority FROM orders")
def f4(spark, folder):
    return prep.LabelEncoding("o_orderpriority").fit_transform(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"))


MANY = "(l_orderkey * 8 + l_linenumber) * 100003 + l_partkey"


@register("f4_label_codes_many", f"SELECT {MANY} AS id, dense_rank() OVER (ORDER BY 'L' || CAST({MANY} AS VARCHAR)) - 1 AS label FROM lineitem")
def f4_many(spark, folder):
    """Nearly one label per row: from 0.01 on too many for local rows, so codes come from a range sort and join by shuffle."""
    rows = table(spark, folder, "lineitem").select(F.expr(MANY).alias("id"))
    return prep.LabelEncoding("label").fit_transform(rows.withColumn("label", F.concat(F.lit("L"), F.col("id").cast("string"))))


@register(
    "f5_one_hot",
    """SELECT o_orderkey, CAST(s = 'F' AS INTEGER) AS "s_F", CAST(s = 'O' AS INTEGER) AS "s_O", CAST(s = 'nan' AS INTEGER) AS s_nan
 FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'nan' ELSE o_orderstatus END AS s FROM orders)""",
)
def f5(spark, folder):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("s")
    return prep.OneHotEncoding("s").fit_transform(table(spark, folder, "orders").select("o_orderkey", status))


@register(
    "f5b_one_hot_zero",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS "s_F", CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS "s_O" FROM orders""",
)
def f5b(spark, folder):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("s")
    return prep.OneHotEncoding("s", missing="zero").fit_transform(table(spark, folder, "orders").select("o_orderkey", status))


@register("f5_one_hot_vector", "SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS hot, 1.0::DOUBLE AS total FROM part")
def f5_vector(spark, folder):
    from pyspark.ml.functions import vector_to_array

    rows = prep.OneHotEncoding("p_brand", output="vector").fit_transform(table(spark, folder, "part").select("p_partkey", "p_brand"))
    cells = rows.select("p_partkey", vector_to_array("p_brand_vector").alias("v"))
    return cells.select("p_partkey", (F.array_position("v", F.lit(1.0)) - 1).alias("hot"), F.aggregate("v", F.lit(0.0), lambda a, b: a + b).alias("total"))


def target_sql(smoothing, leaf):
    return f"""WITH s AS (SELECT p_brand, count(*) AS n, avg(p_retailprice) AS m FROM part WHERE p_partkey % 6 <> 0 GROUP BY 1), p AS (SELECT avg(p_retailprice) AS prior FROM part)
 SELECT p_partkey, round(CASE WHEN p_partkey % 6 = 0 THEN prior ELSE prior * (1 - 1 / (1 + exp(-(n - {leaf}) / {smoothing}))) + m / (1 + exp(-(n - {leaf}) / {smoothing})) END, 6) AS p_brand,
 p_retailprice FROM part LEFT JOIN s USING (p_brand), p"""


def branded(spark, folder):
    return table(spark, folder, "part").select("p_partkey", F.when(F.col("p_partkey") % 6 != 0, F.col("p_brand")).alias("p_brand"), "p_retailprice")


@register("f6_target_codes", target_sql("1.0", 1))
def f6(spark, folder):
    rows = prep.TargetEncoding("p_brand", "p_retailprice").fit_transform(branded(spark, folder))
    return rows.select("p_partkey", F.round("p_brand", 6).alias("p_brand"), "p_retailprice")


@register("f6b_target_codes_smoothed", target_sql("10.0", 20))
def f6b(spark, folder):
    rows = prep.TargetEncoding("p_brand", "p_retailprice", smoothing=10.0, min_samples_leaf=20).fit_transform(branded(spark, folder))
    return rows.select("p_partkey", F.round("p_brand", 6).alias("p_brand"), "p_retailprice")


def scaled_sql(center, scale):
    sources = ", ".join(f"{center.format(c=c)} AS m_{c}, {scale.format(c=c)} AS s_{c}" for c in ["area_m2", "floors"])
    cells = ", ".join(f"round((c.{c} - m_{c}) / s_{c}, 6) AS {c}" for c in ["area_m2", "floors"])
    return f"""{HOMES}, c AS (SELECT id, CAST(area_m2 AS DOUBLE) AS area_m2, CAST(floors AS DOUBLE) AS floors FROM homes), s AS (SELECT {sources} FROM c) SELECT id, {cells} FROM c, s"""


def scaled(step, spark, folder):
    return rounded(step.fit_transform(homes(spark, folder, located=False).select("id", "area_m2", "floors")))


@register("f7_standard_scale", scaled_sql("avg({c})", "stddev_pop({c})"))
def f7(spark, folder):
    return scaled(prep.StandardScaling(["area_m2", "floors"]), spark, folder)


@register("f8_min_max_scale", scaled_sql("min({c})", "(max({c}) - min({c}))"))
def f8(spark, folder):
    return scaled(prep.MinMaxScaling(["area_m2", "floors"]), spark, folder)


@register("f9_robust_scale", scaled_sql("quantile_cont({c}, 0.5)", "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"))
def f9(spark, folder):
    return scaled(prep.RobustScaling(["area_m2", "floors"]), spark, folder)


@register(
    "f10_row_norm",
    "SELECT l_orderkey, l_partkey, round(l_quantity / n, 9) AS l_quantity, round(l_linenumber / n, 9) AS l_linenumber FROM (SELECT *, sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber) AS n FROM lineitem)",
)
def f10(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    return rounded(prep.Normalizing(["l_quantity", "l_linenumber"]).fit_transform(rows), 9)


@register(
    "f11_box_cox_half",
    "WITH t AS (SELECT o_orderkey, (sqrt(o_totalprice) - 1) / 0.5 AS t FROM orders) SELECT o_orderkey, round((t - (SELECT avg(t) FROM t)) / (SELECT stddev_pop(t) FROM t), 6) AS o_totalprice FROM t",
)
def f11(spark, folder):
    """The transform at a given exponent."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return rounded(prep.BoxCoxTransformer("o_totalprice", power=0.5).fit_transform(rows))


def power_sql(source, column, bend, slope):
    """Exponent of greatest likelihood: the best of a grid, then the top of the parabola through three close points, to three digits."""
    score = f"-0.5 * count(*) * ln(var_pop({bend})) + (p - 1) * sum({slope})"
    return f"""WITH x AS (SELECT CAST({column} AS DOUBLE) AS x FROM {source}), g AS (SELECT i / 50.0 + 0.001 AS p FROM (SELECT unnest(range(-75, 126)) AS i)),
 l AS (SELECT p, {score} AS l FROM x, g GROUP BY p), b AS (SELECT arg_max(p, l) AS b FROM l),
 n AS (SELECT b + i * 0.001 AS p FROM b, (SELECT unnest(range(-25, 26)) AS i)), m AS (SELECT p, {score} AS l FROM x, n GROUP BY p), c AS (SELECT arg_max(p, l) AS c FROM m),
 t AS (SELECT i, c + i * 0.005 AS p FROM c, (SELECT unnest([-1, 0, 1]) AS i)), o AS (SELECT i, p, {score} AS l FROM x, t GROUP BY i, p),
 f AS (SELECT max(CASE WHEN i = -1 THEN l END) AS l1, max(CASE WHEN i = 0 THEN l END) AS l2, max(CASE WHEN i = 1 THEN l END) AS l3, max(CASE WHEN i = 0 THEN p END) AS p FROM o)
 SELECT round(p + 0.0025 * (l1 - l3) / (l1 - 2 * l2 + l3), 3)::DOUBLE AS power FROM f"""


@register("f11_box_cox_fit", power_sql("orders", "o_totalprice", "(pow(x, p) - 1) / p", "ln(x)"))
def f11_fit(spark, folder):
    step = prep.BoxCoxTransformer("o_totalprice").fit(table(spark, folder, "orders"))
    return fitted_power(spark, step)


def fitted_power(spark, step):
    return spark.createDataFrame([(step.state["power"],)], "power double").select(F.round("power", 3).alias("power"))


YJ = "CASE WHEN x >= 0 THEN (pow(x + 1, p) - 1) / p ELSE -(pow(1 - x, 2 - p) - 1) / (2 - p) END"


@register("f12_yeo_johnson_fit", power_sql("customer", "c_acctbal / 1000", YJ, "sign(x) * ln(1 + abs(x))"))
def f12_fit(spark, folder):
    rows = table(spark, folder, "customer").select((F.col("c_acctbal") / 1000).alias("x"))
    return fitted_power(spark, prep.YeoJohnsonTransformer("x").fit(rows))


@register(
    "f12_yeo_johnson_given",
    f"""WITH t AS (SELECT c_custkey, {YJ} AS t FROM (SELECT c_custkey, c_acctbal AS x, 1.25::DOUBLE AS p FROM customer))
 SELECT c_custkey, round((t - (SELECT avg(t) FROM t)) / (SELECT stddev_pop(t) FROM t), 6) AS c_acctbal FROM t""",
)
def f12(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return rounded(prep.YeoJohnsonTransformer("c_acctbal", power=1.25).fit_transform(rows))


@register("f13_mice")
def f13(spark, folder):
    """Imputed measures; the check is a brute-force comparison in the tests."""
    rows = homes(spark, folder, located=False).select("id", *MEASURES)
    return prep.MICEImputation(MEASURES, max_iter=5, random_state=42, n_nearest_features=5).fit_transform(rows)


def bayes_sql(name, x, y, where):
    """CTEs that fit y on x by Bayesian ridge: ``name``_w has slope and intercept."""
    return f""" {name}_m AS (SELECT count(*)::DOUBLE AS n, avg({x}) AS mx, avg({y}) AS my, var_pop({x}) * count(*) AS xx, covar_pop({x}, {y}) * count(*) AS xy, var_pop({y}) * count(*) AS yy {where}),
 {name}_b AS (SELECT 0 AS step, NULL::DOUBLE AS c, 1 / (yy / n + 2.220446049250313e-16) AS noise, 1.0::DOUBLE AS weight, false AS done FROM {name}_m
  UNION ALL SELECT step + 1, c1, (n - eff + 2e-6) / (err + 2e-6), (eff + 2e-6) / (c1 * c1 + 2e-6), coalesce(abs(c - c1) < 1e-3, false) FROM (
   SELECT *, greatest(yy - 2 * c1 * xy + c1 * c1 * xx, 0) AS err, noise * xx / (weight + noise * xx) AS eff FROM (SELECT *, xy / (xx + weight / noise) AS c1 FROM {name}_b, {name}_m WHERE NOT done AND step < 300))),
 {name}_w AS (SELECT xy / (xx + weight / noise) AS w, my - mx * xy / (xx + weight / noise) AS b FROM {name}_m, (SELECT * FROM {name}_b ORDER BY step DESC LIMIT 1))"""


@register(
    "f13_mice_pair",
    HOMES.replace("WITH homes", "WITH RECURSIVE homes")
    + f""", a AS (SELECT id, area_m2, bedrooms, avg(area_m2) OVER () AS ma, avg(bedrooms) OVER () AS mb FROM homes),
 z0 AS (SELECT *, coalesce(area_m2 - ma, 0) AS za, coalesce(bedrooms - mb, 0) AS zb FROM a),{bayes_sql("p", "zb", "za", "FROM z0 WHERE area_m2 IS NOT NULL")},
 z1 AS (SELECT id, area_m2, bedrooms, ma, mb, zb, CASE WHEN area_m2 IS NULL THEN b + w * zb ELSE za END AS za FROM z0, p_w),{bayes_sql("q", "za", "zb", "FROM z1 WHERE bedrooms IS NOT NULL")}
 SELECT id, round(coalesce(area_m2, za + ma), 6) AS area_m2, round(CASE WHEN bedrooms IS NULL THEN b + w * za + mb ELSE bedrooms END, 6) AS bedrooms FROM z1, q_w""",
)
def f13_pair(spark, folder):
    """Two columns, one round: the one with fewer gaps is completed first."""
    rows = homes(spark, folder, located=False).select("id", "area_m2", "bedrooms")
    filled = prep.MICEImputation(["area_m2", "bedrooms"], max_iter=1).fit_transform(rows)
    return filled.select("id", F.round("area_m2", 6).alias("area_m2"), F.round("bedrooms", 6).alias("bedrooms"))


@register(
    "f14_fill_mean",
    f"{HOMES} SELECT id, round(coalesce(CAST(area_m2 AS DOUBLE), (SELECT avg(area_m2) FROM homes)), 6) AS area_m2 FROM homes",
)
def f14_mean(spark, folder):
    return rounded(clean.fill_missing(homes(spark, folder, located=False).select("id", "area_m2"), "mean", ["area_m2"]))


@register("f14_fill_median", f"{HOMES} SELECT id, coalesce(CAST(floors AS DOUBLE), (SELECT quantile_cont(CAST(floors AS DOUBLE), 0.5) FROM homes)) AS floors FROM homes")
def f14_median(spark, folder):
    return clean.fill_missing(homes(spark, folder, located=False).select("id", "floors"), "median", ["floors"])


@register(
    "f14_fill_mode",
    f"{HOMES} SELECT id, coalesce(bedrooms, (SELECT bedrooms FROM homes WHERE bedrooms IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS bedrooms FROM homes",
)
def f14_mode(spark, folder):
    return clean.fill_missing(homes(spark, folder, located=False).select("id", "bedrooms"), "mode", ["bedrooms"])


@register("f14_fill_zero", f"{HOMES} SELECT id, coalesce(bathrooms, 0) AS bathrooms FROM homes")
def f14_zero(spark, folder):
    return clean.fill_missing(homes(spark, folder, located=False).select("id", "bathrooms"), "zero", ["bathrooms"])


@register("f15_parse_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS day FROM orders")
def f15(spark, folder):
    text = F.when(F.col("o_orderkey") % 3 == 0, F.lit("invalid")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return clean.parse_dates(table(spark, folder, "orders").select("o_orderkey", text.alias("day")), "day")


@register("f16_missing_flags", f"{HOMES} SELECT id, " + ", ".join(f"{c}, CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in MEASURES) + " FROM homes")
def f16(spark, folder):
    return clean.add_missing_flags(homes(spark, folder, located=False).select("id", *MEASURES), MEASURES)


WRITTEN = "CASE o_orderkey % 5 WHEN 0 THEN 'soon' WHEN 1 THEN strftime(o_orderdate::TIMESTAMP, '%-d/%-m/%Y 07:05') ELSE strftime(o_orderdate::TIMESTAMP, '%d/%m/%Y 23:59') END"


@register("f15_percent_format", f"SELECT o_orderkey, try_strptime({WRITTEN}, '%d/%m/%Y %H:%M') AS moment FROM orders")
def f15_percent(spark, folder):
    """Dates written day first, some with single digits, some no dates."""
    rows, day = table(spark, folder, "orders"), F.col("o_orderdate").cast("date")
    kind = F.col("o_orderkey") % 5
    text = F.when(kind == 0, "soon").when(kind == 1, F.concat(F.date_format(day, "d/M/yyyy"), F.lit(" 07:05"))).otherwise(F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit(" 23:59")))
    return clean.parse_dates(rows.select("o_orderkey", text.alias("moment")), "moment", "%d/%m/%Y %H:%M")


@register("a11_dropped_rows", "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_discount, l_tax FROM lineitem)) AS dropped FROM lineitem")
def a11_dropped(spark, folder):
    """How many rows the cleaner drops as repeated."""
    return clean.DataCleaner(table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_tax")).drop_duplicates().dropped
