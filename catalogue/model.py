from pyspark.sql import functions as F

from catalogue.explore import METRICS, box_sql, metric_row, rounded
from catalogue.registry import HOMES, homes, places, register, table
from parcelry.functions import scalar as S
from parcelry.operators import explore as X, regression as M
from parcelry.operators.prep import OneHotEncoding
from parcelry.operators.reshape import id_unit, id_unit_sql, train_test_split, with_fold
from parcelry.plans import features as feature_plan, scoring
from parcelry.session import written

FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
UNIT = id_unit_sql("l_orderkey")


def lines(spark, folder):
    """Line items with the label in thousands and a fold per order."""
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", *FEATURES, (F.col("l_extendedprice") / 1000).alias("y"))
    return with_fold(rows, id_unit("l_orderkey"))


def vectors(spark, folder):
    return M.assemble(lines(spark, folder), FEATURES)


def one_feature(spark, folder, estimator):
    model = estimator.fit(M.assemble(lines(spark, folder), ["l_quantity"]), "y")
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double").select(
        F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept")
    )


SUMS = """WITH d AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem),
 s AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS sxy, var_pop(x) AS sxx FROM d)"""


@register("m1_least_squares", f"{SUMS} SELECT round(sxy / sxx, 6) AS slope, round(my - mx * sxy / sxx, 6) AS intercept FROM s")
def m1(spark, folder):
    return one_feature(spark, folder, M.LeastSquares())


@register("m2_ridge", f"{SUMS}, w AS (SELECT sxy / (sxx + 5000.0 / n) AS w, * FROM s) SELECT round(w, 6) AS slope, round(my - mx * w, 6) AS intercept FROM w")
def m2(spark, folder):
    return one_feature(spark, folder, M.RidgeRegression(alpha=5000))


@register("m3_lasso", f"{SUMS}, w AS (SELECT sign(sxy) * greatest(abs(sxy) - 20, 0) / sxx AS w, * FROM s) SELECT round(w, 6) AS slope, round(my - mx * w, 6) AS intercept FROM w")
def m3(spark, folder):
    return one_feature(spark, folder, M.LassoRegression(alpha=20.0))


@register(
    "m4_elastic_net_search",
    f"""WITH d AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y, floor({UNIT} * 5) AS fold FROM lineitem), k AS (SELECT unnest(range(5)) AS k),
 t AS (SELECT k, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS sxy, var_pop(x) AS sxx FROM d, k WHERE fold <> k GROUP BY k),
 g AS (SELECT r, pow(10, -3 + 4 * i / 19.0) AS a FROM (SELECT unnest([0.1, 0.3, 0.5, 0.7, 0.9]) AS r), (SELECT unnest(range(20)) AS i)),
 w AS (SELECT k, r, a, mx, my, sign(sxy) * greatest(abs(sxy) - a * r, 0) / (sxx + a * (1 - r)) AS w FROM t, g),
 e AS (SELECT r, a, k, avg(pow(y - (my - mx * w) - w * x, 2)) AS e FROM w JOIN d ON fold = k GROUP BY r, a, k)
 SELECT r::DOUBLE AS l1_ratio, round(a, 9) AS alpha, round(avg(e), 6) AS error FROM e GROUP BY r, a""",
)
def m4(spark, folder):
    """Held-out error of every penalty, all from one pass over the rows."""
    scores, _ = M.elastic_net_path(lines(spark, folder), ["l_quantity"], "y")
    found = spark.createDataFrame(scores, "l1_ratio double, alpha double, error double")
    return found.select("l1_ratio", F.round("alpha", 9).alias("alpha"), F.round("error", 6).alias("error"))


def scored(spark, folder, estimator, name):
    train, test = train_test_split(vectors(spark, folder), id_unit("l_orderkey", 7))
    return M.evaluate(estimator.fit(train, "y"), test, "y", name)


@register("m5_decision_tree")
def m5(spark, folder):
    return scored(spark, folder, M.TreeRegression(), "decision tree")


@register("m6_random_forest")
def m6(spark, folder):
    return scored(spark, folder, M.ForestRegression(numTrees=10, maxDepth=6), "random forest")


@register("m7_boosted_trees")
def m7(spark, folder):
    return scored(spark, folder, M.BoostedRegression(maxIter=10, maxDepth=4), "boosted trees")


@register("m8_stacking")
def m8(spark, folder):
    """Ridge and a tree, out of fold, under a final ridge."""
    train, test = train_test_split(vectors(spark, folder), id_unit("l_orderkey", 7))
    stack = M.Stacking({"ridge": M.RidgeRegression(5.0), "tree": M.TreeRegression(maxDepth=5)}, M.RidgeRegression(1.0), passthrough=True)
    return M.evaluate(stack.fit(train, "y"), test, "y", "stack")


@register(
    "m9_fold_scores",
    f"""SELECT fold, {METRICS.replace(', count(*) AS n', '')}, count(*) AS n FROM (SELECT CAST(floor({UNIT} * 5) AS INTEGER) AS fold, l_extendedprice / 1000 AS y, l_quantity * 1.5 AS p FROM lineitem) GROUP BY fold""",
)
def m9(spark, folder):
    rows = lines(spark, folder).select("fold", "y", (F.col("l_quantity") * 1.5).alias("p"))
    return metric_row(X.error_metrics(rows, "y", "p", "fold"))


@register(
    "m9_cross_validated_line",
    f"""WITH d AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y, CAST(floor({UNIT} * 5) AS INTEGER) AS fold FROM lineitem), k AS (SELECT unnest(range(5)) AS k),
 t AS (SELECT k, regr_slope(y, x) AS w, regr_intercept(y, x) AS b FROM d, k WHERE fold <> k GROUP BY k),
 e AS (SELECT fold, sqrt(avg(pow(y - b - w * x, 2))) AS rmse FROM d JOIN t ON fold = k GROUP BY fold)
 SELECT round(avg(rmse), 6) AS mean, round(stddev_pop(rmse), 6) AS std FROM e""",
)
def m9_cv(spark, folder):
    rows = M.assemble(lines(spark, folder), ["l_quantity"])
    return rounded(M.spread(M.cross_validate(M.LeastSquares, rows, "y")))


def price_model(spark, folder):
    """The listing features, fitted steps and a linear price model, all from the given tables."""
    train, _, steps = feature_plan.train_and_test(homes(spark, folder).drop("key"))
    inputs = [c for c in train.columns if c not in ("id", "log_price")]
    renamed = train.toDF(*[c if c in ("id", "log_price") else f"f{inputs.index(c)}" for c in train.columns])
    model = M.RidgeRegression(10.0).fit(M.assemble(renamed, [f"f{i}" for i in range(len(inputs))]), "log_price")

    def score(df):
        order = {c: f"f{i}" for i, c in enumerate(inputs)}
        kept = [c for c in df.columns if c not in order]
        named = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(n) for c, n in order.items()])
        return M.predict(model, M.assemble(named, list(order.values())))

    return steps, score, feature_plan.area_labels(train)


@register("m10_batch_scoring")
def m10(spark, folder):
    """A price for every listing that has what the model needs."""
    steps, score, known = price_model(spark, folder)
    rows = feature_plan.with_location_and_date(homes(spark, folder).drop("title", "detail_url", "price_million_vnd"))
    return scoring.predict_prices(rows, steps, score, known).select("id", "predicted_price")


@register("m11_ward_comparison")
def m11_wards(spark, folder):
    steps, score, known = price_model(spark, folder)
    return scoring.predict_prices(scoring.ward_grid(wards(spark, folder), 1999, 6), steps, score, known)


def wards(spark, folder):
    return places(spark, folder).select(F.col("n_name").alias("ward"), F.col("r_name").alias("province")).distinct()


@register("m11_monthly_trend")
def m11_months(spark, folder):
    steps, score, known = price_model(spark, folder)
    return scoring.predict_prices(scoring.monthly_grid(wards(spark, folder), 1999), steps, score, known)


@register("m11_sensitivity")
def m11_sensitivity(spark, folder):
    steps, score, known = price_model(spark, folder)
    return scoring.predict_prices(scoring.sensitivity_grid("NATION_1", "AMERICA", 1999, 6, spark), steps, score, known)


@register(
    "m11_scenario_deltas",
    """WITH h AS (SELECT o_orderkey, CAST(o_custkey % 5 AS INTEGER) AS bedrooms, CAST(o_custkey % 4 AS INTEGER) AS bathrooms, CAST(o_custkey % 3 AS INTEGER) AS floors,
 CAST(o_custkey % 100 AS INTEGER) AS area_m2, o_orderstatus = 'F' AS frontage FROM orders),
 s AS (SELECT unnest(['Base Case', '+1 Bedroom', '+1 Bathroom', '+1 Floor', 'No Frontage', 'With Frontage', 'Renovated (+10m²)', 'Major Renovation (+30m²)']) AS scenario)
 SELECT o_orderkey, scenario, CASE scenario WHEN '+1 Bedroom' THEN 3.0 WHEN '+1 Bathroom' THEN 2.0 WHEN '+1 Floor' THEN 4.0
 WHEN 'No Frontage' THEN CASE WHEN frontage THEN -7.0 ELSE 0.0 END WHEN 'With Frontage' THEN CASE WHEN frontage THEN 0.0 ELSE 7.0 END
 WHEN 'Renovated (+10m²)' THEN 5.0 WHEN 'Major Renovation (+30m²)' THEN 15.0 ELSE 0.0 END::DOUBLE AS price_delta FROM h, s""",
)
def m11_scenarios(spark, folder):
    """Eight variants of every order as a house, priced by a fixed linear rule."""
    key = F.col("o_custkey")
    houses = table(spark, folder, "orders").select(
        "o_orderkey", (key % 5).cast("int").alias("bedrooms"), (key % 4).cast("int").alias("bathrooms"), (key % 3).cast("int").alias("floors"),
        (key % 100).cast("int").alias("area_m2"), (F.col("o_orderstatus") == "F").alias("frontage"),
    )
    priced = scoring.scenarios(houses).withColumn(
        "predicted_price", F.expr("3.0D * bedrooms + 2.0D * bathrooms + 4.0D * floors + 0.5D * area_m2 + 7.0D * CAST(frontage AS INT)")
    )
    return scoring.scenario_deltas(priced, ["o_orderkey"]).select("o_orderkey", "scenario", "price_delta")


@register("m12_residual_boxes", "WITH src AS (SELECT l_linenumber, l_extendedprice - l_quantity * 1500 AS r FROM lineitem)" + box_sql("src", "l_linenumber", "r"))
def m12(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_linenumber", (F.col("l_extendedprice") - F.col("l_quantity") * 1500).alias("r"))
    return rounded(X.box_stats(rows, "l_linenumber", "r"))


@register("m13_bootstrap_interval")
def m13(spark, folder):
    """Spread of the predicted price of one line over 100 refits on resampled rows."""
    fits = M.bootstrap_linear(lines(spark, folder), ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_discount"], "y")
    return M.prediction_interval(fits, [20.0, 0.05])


# --- linear fits on all columns of the listing table, with its one-hot columns ---

MEASURED = ["area_m2", "bedrooms", "bathrooms", "floors"]
PENALTY = 25.0


def all_columns(spark, folder):
    """Priced listings as numbers: measures with gaps as zero, their flags, the frontage, and a column for each region and nation."""
    ward, province = S.ward_and_province("location")
    rows = homes(spark, folder).where("price_million_vnd is not null").withColumns({"ward": ward, "province": province})
    rows = rows.select(
        id_unit("key").alias("unit"),
        F.log1p("price_million_vnd").alias("y"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in MEASURED],
        *[F.col(c).isNull().cast("double").alias(f"{c}_missing") for c in MEASURED],
        F.coalesce(F.col("frontage"), F.lit(False)).cast("double").alias("frontage"),
        "province",
        "ward",
    )
    rows = with_fold(OneHotEncoding(["province", "ward"]).fit_transform(rows), F.col("unit")).drop("unit")
    return rows, [c for c in rows.columns if c not in ("y", "fold")]


SOLVED = f"""{HOMES.replace("WITH homes", "WITH RECURSIVE homes")}, t AS (SELECT *, CAST(floor({id_unit_sql('key')} * 5) AS INTEGER) AS fold FROM homes WHERE price_million_vnd IS NOT NULL),
 c AS (SELECT list(DISTINCT ward ORDER BY ward) AS w, list(DISTINCT province ORDER BY province) AS p FROM t),
 d AS (SELECT fold, list_concat([1.0::DOUBLE, {", ".join(f"coalesce({m}, 0)::DOUBLE" for m in MEASURED)}, {", ".join(f"({m} IS NULL)::INT::DOUBLE" for m in MEASURED)}, coalesce(frontage, false)::INT::DOUBLE],
  list_transform(c.p, lambda v: (v = province)::INT::DOUBLE), list_transform(c.w, lambda v: (v = ward)::INT::DOUBLE), [ln(1 + price_million_vnd)]) AS z FROM t, c),
 n AS (SELECT max(len(z)) AS n FROM d), a AS (SELECT unnest(range(1, n + 1)) AS i FROM n),
 g AS (SELECT fold, a.i AS i, b.i AS j, sum(z[a.i] * z[b.i]) AS s FROM d, a, a AS b GROUP BY ALL),
 {{groups}},
 m AS (SELECT k, list(r ORDER BY i) AS m FROM (SELECT k, i, list(s + CASE WHEN i = j AND i > 1 AND i < n THEN {PENALTY} ELSE 0 END ORDER BY j) AS r FROM h, n GROUP BY k, i) GROUP BY k),
 e AS (SELECT 1 AS step, k, m FROM m UNION ALL SELECT step + 1, k, list_transform(range(1, len(m) + 1), lambda i: CASE WHEN i = step THEN list_transform(m[step], lambda v: v / m[step][step])
  ELSE list_transform(range(1, len(m) + 1), lambda j: m[i][j] - m[i][step] * m[step][j] / m[step][step]) END) FROM e WHERE step < len(m)),
 f AS (SELECT k, list_transform(m, lambda r: r[len(m)]) AS w FROM e WHERE step = len(m))"""


@register(
    "m2_ridge_all_columns",
    SOLVED.format(groups="h AS (SELECT 0 AS k, i, j, sum(s) AS s FROM g GROUP BY i, j)")
    + f"""SELECT unnest(list_concat({MEASURED + [f"{m}_missing" for m in MEASURED] + ["frontage"]}, list_transform(p, lambda v: 'province_' || v), list_transform(w1, lambda v: 'ward_' || v))) AS feature,
 round(unnest(f.w[2:len(f.w) - 1]), 6) AS coefficient FROM f, (SELECT p, w AS w1 FROM c)""",
)
def m2_all(spark, folder):
    """Closed-form ridge of the log price on all columns, from one pass of matrix products."""
    rows, features = all_columns(spark, folder)
    model = M.ClosedRidge(PENALTY).fit(rows, features, "y")
    found = spark.createDataFrame(list(model.coefficients.items()), "feature string, coefficient double")
    return found.select("feature", F.round("coefficient", 6).alias("coefficient"))


@register(
    "m9_cross_validated_ridge",
    SOLVED.format(groups="h AS (SELECT k, i, j, sum(s) AS s FROM g, (SELECT DISTINCT fold AS k FROM g) WHERE fold <> k GROUP BY k, i, j)")
    + """SELECT fold, max(s) FILTER (i = 1 AND j = 1)::BIGINT AS n, round(sqrt(sum(s * CASE WHEN i = n.n THEN 1 ELSE -w[i] END * CASE WHEN j = n.n THEN 1 ELSE -w[j] END) / max(s) FILTER (i = 1 AND j = 1)), 6) AS rmse
 FROM g JOIN f ON fold = k, n GROUP BY fold""",
)
def m9_ridge(spark, folder):
    """Held-out error of the same ridge for each of five folds: all fits and errors come from one pass."""
    rows, features = all_columns(spark, folder)
    return rounded(M.cross_validate_linear(rows, features, "y", PENALTY, on_sum=True))


@register(
    "m12_ridge_residual_boxes",
    SOLVED.format(groups="h AS (SELECT 0 AS k, i, j, sum(s) AS s FROM g GROUP BY i, j)")
    + """, res AS (SELECT 'province_' || p[list_position(z[11:10 + len(p)], 1.0)] AS region, z[len(z)] - list_dot_product(z[1:len(z) - 1], f.w[1:len(z) - 1]) AS r FROM d, f, (SELECT p FROM c))"""
    + box_sql("res", "region", "r"),
)
def m12_ridge(spark, folder):
    """Boxes of the ridge's residuals by the one-hot region column that each row is dominated by."""
    rows, features = all_columns(spark, folder)
    rows = written(rows, "columns")
    model = M.ClosedRidge(PENALTY).fit(rows, features, "y")
    regions = [c for c in features if c.startswith("province_")]
    left = model.transform(rows).select(S.largest_column(regions).alias("region"), (F.col("y") - F.col("prediction")).alias("r"))
    return rounded(X.box_stats(left, "region", "r"))
