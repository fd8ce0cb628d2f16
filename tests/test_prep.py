import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelry.operators import prep
from parcelry.operators.prep.base import load_fitted, save_fitted
from parcelry.operators.prep.encoders import collapse_rare, sorted_codes
from parcelry.operators.prep.impute import bayesian_ridge


def column(df, c):
    return [r[c] for r in df.collect()]


def frame(spark, c, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"{c} {kind}").coalesce(1)


def test_label_codes(spark):
    df = frame(spark, "color", ["red", "blue", "green", "red"], "string")
    step = prep.LabelEncoding("color").fit(df)
    assert sorted(column(step.transform(df), "color")) == [0, 1, 2, 2]
    with pytest.raises(Exception, match="unknown label"):
        step.transform(frame(spark, "color", ["pink"], "string")).collect()


def test_big_code_sets_are_numbered_by_range(spark):
    values = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"))
    codes = {r["v"]: r["code"] for r in sorted_codes(values, "v", max_rows=10).collect()}
    assert [codes[v] for v in sorted(codes)] == list(range(5000))


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "NY"), (2, "LA"), (3, None)], "i int, city string")
    out = prep.OneHotEncoding("city").fit(df).transform(df).orderBy("i")
    assert out.columns == ["i", "city_LA", "city_NY", "city_nan"]
    assert [tuple(r) for r in out.collect()] == [(1, 0, 1, 0), (2, 1, 0, 0), (3, 0, 0, 1)]
    zero = prep.OneHotEncoding("city", missing="zero").fit_transform(df).orderBy("i")
    assert [tuple(r) for r in zero.collect()] == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]
    with pytest.raises(ValueError):
        prep.OneHotEncoding("city", max_categories=1).fit(df)
    vectors = prep.OneHotEncoding("city", output="vector").fit(df).transform(spark.createDataFrame([(1, "LA"), (2, "SF")], "i int, city string"))
    assert [r["city_vector"].toArray().tolist() for r in vectors.orderBy("i").collect()] == [[1, 0, 0], [0, 0, 0]]


def test_target_codes(spark):
    df = spark.createDataFrame([("A", 10), ("B", 20), ("A", 15), ("C", 5)], "category string, target int")
    step = prep.TargetEncoding("category", "target").fit(df)
    new = spark.createDataFrame([("A", 0), ("B", 0), ("C", 0), ("Z", 0), (None, 0)], "category string, target int").coalesce(1)
    got = {r["category"]: r["encoded"] for r in step.tables["category"].collect()}
    assert got["A"] == pytest.approx(12.5) and got["B"] == pytest.approx(16.25) and got["C"] == pytest.approx(8.75)
    assert sorted(column(step.transform(new), "category")) == pytest.approx([8.75, 12.5, 12.5, 12.5, 16.25])


def test_scalers(spark):
    x = frame(spark, "x", [10, 20, 30, 40], "int")
    assert column(prep.StandardScaling(["x"]).fit_transform(x), "x") == pytest.approx([-1.3416, -0.4472, 0.4472, 1.3416], abs=1e-4)
    assert column(prep.MinMaxScaling(["x"]).fit_transform(x), "x") == pytest.approx([0, 1 / 3, 2 / 3, 1])
    step = prep.RobustScaling(["x"]).fit(x)
    assert column(step.transform(x), "x") == pytest.approx([-1, -1 / 3, 1 / 3, 1])
    assert column(step.inverse_transform(step.transform(x)), "x") == pytest.approx([10, 20, 30, 40])
    assert column(prep.Normalizing(["x"]).fit_transform(x), "x") == [1, 1, 1, 1]
    constant = frame(spark, "x", [3.0, 3.0, None])
    for kind in (prep.StandardScaling, prep.MinMaxScaling, prep.RobustScaling):
        assert column(kind(["x"]).fit_transform(constant), "x") == [0.0, 0.0, None]


def test_outliers(spark):
    df = frame(spark, "v", [10, 12, 14, 1000], "int")
    assert column(prep.IQRMethod("v").fit_transform(df), "v") == [10, 12, 14]
    assert prep.ZScoreMethod("v", threshold=2).fit_transform(df).count() == 4
    assert prep.ZScoreMethod("v", threshold=1).fit_transform(df).count() == 3
    assert prep.ZScoreMethod("v").fit_transform(frame(spark, "v", [5, 5], "int")).count() == 0
    assert prep.IQRMethod("v").fit_transform(frame(spark, "v", [1, 2, None], "int")).count() == 2


def likelihood(x, power, kind):
    if kind == "box-cox":
        t = np.log(x) if power == 0 else (x**power - 1) / power
        return -len(x) / 2 * np.log(t.var()) + (power - 1) * np.log(x).sum()
    up, down = x[x >= 0], x[x < 0]
    t = np.concatenate([((up + 1) ** power - 1) / power, -((1 - down) ** (2 - power) - 1) / (2 - power)])
    return -len(x) / 2 * np.log(t.var()) + (power - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()


@pytest.mark.parametrize("kind, values", [("box-cox", [1, 2, 3, 4]), ("box-cox", [1, 1, 2, 9, 60, 400]), ("yeo-johnson", [-2, -1, 0, 1, 2]), ("yeo-johnson", [-5, 0, 1, 4, 50])])
def test_power_is_most_likely(spark, kind, values):
    step = {"box-cox": prep.BoxCoxTransformer, "yeo-johnson": prep.YeoJohnsonTransformer}[kind]("f")
    out = np.array(column(step.fit_transform(frame(spark, "f", values, "int")), "f"))
    assert out.mean() == pytest.approx(0, abs=1e-9) and out.std() == pytest.approx(1)
    x, p = np.array(values, float), step.state["power"]
    best = likelihood(x, p, kind)
    for shift in (1e-3, 0.1, 0.9):
        assert best >= likelihood(x, p + shift, kind) and best >= likelihood(x, p - shift, kind)
    assert likelihood(x, p + 1e-3, kind) == pytest.approx(likelihood(x, p - 1e-3, kind), abs=1e-6)


def test_box_cox_needs_positive_values(spark):
    with pytest.raises(ValueError):
        prep.BoxCoxTransformer("f").fit(frame(spark, "f", [0.0, 1.0]))


def brute_mice(x, rounds, tol):
    """Row by row: impute in place, refit each column on the current cells of the others."""
    x, gaps = x.copy(), np.isnan(x)
    limit = tol * np.nanmax(np.abs(x))
    x = np.where(gaps, np.nanmean(x, axis=0), x)
    for _ in range(rounds):
        before = x.copy()
        for j in np.argsort(gaps.sum(axis=0), kind="stable"):
            others = [i for i in range(x.shape[1]) if i != j]
            rows = ~gaps[:, j]
            a, y = x[np.ix_(rows, others)], x[rows, j]
            ac, yc = a - a.mean(0), y - y.mean()
            w = bayesian_ridge(ac.T @ ac, ac.T @ yc, yc @ yc, len(y))
            x[~rows, j] = y.mean() + (x[np.ix_(~rows, others)] - a.mean(0)) @ w
        if np.abs(x - before).sum(axis=1).max() < limit:
            break
    return x


@pytest.mark.parametrize("rounds, tol, k", [(5, 1e-3, 4), (1, 1e-3, 4), (12, 1e-9, 3), (3, 0.0, 8)])
def test_imputation_matches_row_by_row_refits(spark, rounds, tol, k):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 2))
    x = base @ rng.normal(size=(2, k)) * 10 + rng.normal(size=(300, k)) + 100
    x[rng.random(x.shape) < 0.2] = np.nan
    names = [f"c{i}" for i in range(k)]
    pdf = pd.DataFrame(x, columns=names).assign(i=range(300))
    df = spark.createDataFrame(pdf).repartition(4)
    step = prep.MICEImputation(names, max_iter=rounds, tol=tol).fit(df)
    got = step.transform(df).toPandas().sort_values("i")[names].to_numpy()
    assert np.allclose(got, brute_mice(x, rounds, tol), rtol=1e-7)
    observed = ~np.isnan(x)
    assert (got[observed] == x[observed]).all()


def test_pipeline_fits_each_step_on_the_one_before(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 500]], "v double")
    steps = prep.PreprocessingPipeline([prep.IQRMethod("v"), prep.StandardScaling("v")])
    assert sorted(column(steps.fit_transform(df), "v")) == pytest.approx([-1.3416, -0.4472, 0.4472, 1.3416], abs=1e-4)


def test_unfitted_steps_refuse_to_transform(spark):
    with pytest.raises(RuntimeError):
        prep.StandardScaling("v").transform(frame(spark, "v", [1.0]))
    with pytest.raises(KeyError):
        prep.StandardScaling("w").fit(frame(spark, "v", [1.0]))


def test_saved_steps_give_the_same_result(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.0, None), (2, "b", 2.0, 5.0), (3, "a", 4.0, 3.0)], "i int, c string, v double, w double")
    steps = prep.PreprocessingPipeline(
        [prep.MICEImputation(["v", "w"], max_iter=2), prep.TargetEncoding("c", "v"), prep.RobustScaling(["v"]), prep.YeoJohnsonTransformer("w")]
    ).fit(df)
    loaded = load_fitted(spark, save_fitted(spark, steps, str(tmp_path / "steps")))
    assert loaded.transform(df).orderBy("i").collect() == steps.transform(df).orderBy("i").collect()


def test_rare_categories_collapse(spark):
    df = spark.createDataFrame([("a", "P")] * 5 + [("b", "P")] * 2 + [(None, "Q")], "ward string, province string")
    out = collapse_rare(df, "ward", 3, F.concat(F.lit("Other "), "province"), "clean")
    assert sorted(str(r["clean"]) for r in out.collect()) == ["None", "Other P", "Other P", "a", "a", "a", "a", "a"]


def test_results_do_not_depend_on_partitions(spark):
    df = spark.range(2000).select("id", F.sin("id").alias("v"), (F.col("id") % 7).cast("string").alias("c"))
    def run(n):
        rows = prep.PreprocessingPipeline([prep.IQRMethod("v"), prep.RobustScaling("v"), prep.TargetEncoding("c", "v")]).fit_transform(df.repartition(n))
        return [(r["id"], round(r["v"], 9), round(r["c"], 9)) for r in rows.orderBy("id").collect()]
    assert run(1) == run(8)
