import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelry.operators import reshape as R, regression as M
from parcelry.plans import features, scoring, views
from parcelry.schema import LISTING

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)) * [1, 5, 20] + [0, 3, -7]
    y = x @ [3, -2, 0.5] + 11 + rng.normal(size=400)
    pdf = pd.DataFrame(x, columns=FEATURES).assign(y=y, i=range(400))
    df = R.with_fold(spark.createDataFrame(pdf).repartition(3), R.hash_unit("i")).persist()
    return x, y, df


def vectors(df):
    return M.assemble(df, FEATURES)


def test_ridge_is_the_closed_form(data):
    x, y, df = data
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha in (0.0, 10.0, 500.0):
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        model = M.RidgeRegression(alpha).fit(vectors(df), "y") if alpha else M.LeastSquares().fit(vectors(df), "y")
        assert model.coefficients.toArray() == pytest.approx(want, rel=1e-8)
        b, w = M.linear_from_sums(M.product_sums(df, FEATURES, "y")[None], alpha / 400)
        assert w == pytest.approx(want, rel=1e-8) and b == pytest.approx(y.mean() - x.mean(0) @ want)


@pytest.mark.parametrize("alpha, ratio", [(0.5, 1.0), (0.3, 0.5), (5.0, 0.9), (1.0, 0.1)])
def test_elastic_net_is_optimal(data, alpha, ratio):
    x, y, df = data
    xc, yc = x - x.mean(0), y - y.mean()

    def slack(w):
        g = -xc.T @ (yc - xc @ w) / len(y) + alpha * (1 - ratio) * w
        return np.where(w != 0, np.abs(g + alpha * ratio * np.sign(w)), np.maximum(np.abs(g) - alpha * ratio, 0)).max()

    _, w = M.linear_from_sums(M.product_sums(df, FEATURES, "y")[None], alpha, ratio)
    assert slack(w) < 1e-8
    fitted = M.ElasticNet(alpha, ratio).fit(vectors(df), "y")
    assert slack(fitted.coefficients.toArray()) < 1e-3


def test_elastic_net_search_picks_the_least_error(data):
    x, y, df = data
    search = M.ElasticNetSearch([0.2, 0.8], [0.001, 1.0, 50.0]).fit(df, FEATURES, "y")
    assert search.alpha == 0.001
    got = search.transform(df).select(F.avg(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0]
    assert got < 1.2


def test_stacking_uses_out_of_fold_predictions(data):
    _, _, df = data
    stack = M.Stacking({"r": M.RidgeRegression(1.0), "t": M.TreeRegression(maxDepth=3)}, M.RidgeRegression(1.0))
    scores = M.evaluate(stack.fit(vectors(df), "y"), vectors(df), "y", "s").first()
    assert scores["r2"] > 0.95
    passed = M.Stacking({"r": M.RidgeRegression(1.0)}, M.RidgeRegression(1.0), passthrough=True).fit(vectors(df), "y")
    assert M.evaluate(passed, vectors(df), "y", "s").first()["r2"] > 0.99


def test_cross_validation_scores_each_fold(data):
    _, _, df = data
    scores = M.cross_validate(M.LeastSquares, vectors(df), "y")
    assert scores.count() == 5 and M.spread(scores).first()["mean"] == pytest.approx(1.0, abs=0.15)


def test_bootstrap_spread_matches_theory(data):
    x, y, df = data
    fits = M.bootstrap_linear(df, "i", FEATURES, "y", replicates=200)
    assert fits.count() == 200
    w = np.array([r["coefficients"] for r in fits.collect()])
    xc = x - x.mean(0)
    assert w.std(0) == pytest.approx(np.sqrt(np.diag(np.linalg.inv(xc.T @ xc))), rel=0.3)
    row = M.prediction_interval(fits, [0, 3, -7]).first()
    assert row["low"] < row["mean"] < row["high"]


def test_poisson_weights(spark):
    rows = R.bootstrap_weights(spark.range(2000), "id", 20)
    total, square = rows.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("weight"))).first()
    assert total / 40_000 == pytest.approx(1, abs=0.03) and square / 40_000 == pytest.approx(2, abs=0.08)


def test_samples_and_splits_are_reproducible(spark):
    df = spark.range(5000)
    a = {r[0] for r in R.sample_fraction(df, "id", 0.2).collect()}
    assert a == {r[0] for r in R.sample_fraction(df.repartition(9), "id", 0.2).collect()}
    assert len(a) / 5000 == pytest.approx(0.2, abs=0.03)
    assert R.random_k(df, "id", 20).collect() == R.random_k(df.repartition(5), "id", 20).collect()
    train, test = R.train_test_split(df, R.id_unit("id"))
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    folds = R.with_fold(df, R.id_unit("id")).groupBy("fold").count().collect()
    assert len(folds) == 5 and min(r["count"] for r in folds) > 800


@pytest.fixture(scope="module")
def listings(spark):
    rng = np.random.default_rng(2)
    places = [("Quận 1", "Hồ Chí Minh"), ("Ba Đình", "Hà Nội"), ("Hải Châu", "Đà Nẵng")]
    rows = []
    for i in range(600):
        ward, province = places[i % 3] if i % 40 else (f"Ward {i}", "Hà Nội")
        area, beds = int(rng.integers(20, 200)), int(rng.integers(1, 6))
        price = float(20 * area + 100 * beds + rng.normal() * 50)
        gap = lambda v, k: None if i % k == 0 else v
        rows.append((str(i), "/u", "t", f"{ward}, {province}", int(rng.integers(0, 6000)), gap(area, 11), gap(beds, 7), gap(beds, 9), gap(2, 13), bool(i % 2), gap(price, 50)))
    return spark.createDataFrame(rows, LISTING).persist()


def test_feature_plan(spark, listings):
    train, test, steps = features.train_and_test(listings)
    assert train.columns == test.columns
    assert 0.1 < test.count() / (train.count() + test.count()) < 0.3
    assert "ward_province_clean_OtherWard | Hà Nội" in train.columns and "province_Đà Nẵng" in train.columns
    checked = ["area_m2", "bedrooms", "bathrooms", "floors", "log_price", "day_sin", "month_cos"]
    assert train.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in checked]).first().asDict() == dict.fromkeys(checked, 0)
    labels = {r["label"] for r in features.area_labels(train).collect()}
    assert {"Quận 1 | Hồ Chí Minh", "OtherWard | Hà Nội"} <= labels


def test_scoring_and_grids(spark, listings):
    train, _, steps = features.train_and_test(listings)
    names = ["area_m2", "bedrooms", "frontage", "ward_province_clean_Ba Đình | Hà Nội"]
    rows = train.select(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(names)], "log_price")
    model = M.RidgeRegression(1.0).fit(M.assemble(rows, ["f0", "f1", "f2", "f3"]), "log_price")
    score = lambda df: M.predict(model, M.assemble(df.withColumns({f"f{i}": F.col(f"`{c}`") for i, c in enumerate(names)}), ["f0", "f1", "f2", "f3"]))
    known = features.area_labels(train)
    wards = spark.createDataFrame([("Ba Đình", "Hà Nội"), ("Nowhere", "Hà Nội")], "ward string, province string")
    grid = scoring.ward_grid(wards, 2026, 6)
    out = scoring.predict_prices(grid, steps, score, known)
    assert out.columns == [*grid.columns, "predicted_price"] and out.count() == 6
    price = {(r["house_type"], r["ward"]): r["predicted_price"] for r in out.collect()}
    assert price["Small", "Ba Đình"] < price["Large", "Ba Đình"]
    assert scoring.predict_prices(scoring.monthly_grid(wards, 2026), steps, score, known).count() == 72
    assert scoring.sensitivity_grid("Ba Đình", "Hà Nội", 2026, 6, spark).count() == 3 * (6 + 6 + 5 + 7)
    variants = scoring.scenarios(scoring.ward_grid(wards.limit(1), 2026, 6))
    deltas = scoring.scenario_deltas(scoring.predict_prices(variants, steps, score, known), ["house_type", "ward"])
    assert deltas.count() == 24
    assert {r["price_delta"] for r in deltas.filter("scenario = 'Base Case'").collect()} == {0.0}
    assert deltas.filter("scenario = 'Major Renovation (+30m²)'").agg(F.min("price_delta")).first()[0] > 0


def test_exploration_views(listings):
    table = views.exploration_table(listings).persist()
    assert views.regional(table).select("province").distinct().count() == 3
    assert table.filter("price_million_vnd IS NULL").select("price_segment").distinct().collect()[0][0] == "High"
    for columns in (views.LOCATION, views.PRICE, views.SIZE, views.TIMELINE):
        assert views.topic(table, columns).columns == columns


def test_saved_models_give_the_same_rows(spark, data, tmp_path):
    _, _, df = data
    rows = vectors(df)
    tree = M.TreeRegression(maxDepth=3).fit(rows, "y")
    stack = M.Stacking({"ridge": M.RidgeRegression(1.0), "tree": M.TreeRegression(maxDepth=3)}, M.RidgeRegression(1.0), passthrough=True).fit(rows, "y")
    search = M.ElasticNetSearch().fit(df, FEATURES, "y")
    for name, model in (("tree", tree), ("stack", stack), ("search", search)):
        loaded = M.load_model(spark, M.save_model(spark, model, f"{tmp_path}/{name}"))
        before, after = ({r["i"]: r["prediction"] for r in M.predict(m, rows if name != "search" else df).select("i", "prediction").collect()} for m in (model, loaded)) if name != "search" else (
            {r["i"]: r["prediction"] for r in m.transform(df).select("i", "prediction").collect()} for m in (model, loaded)
        )
        assert before == after
    importances = M.feature_importances(spark, tree, FEATURES).collect()
    assert sum(r["importance"] for r in importances) == pytest.approx(1) and importances[0]["importance"] >= importances[-1]["importance"]
    gap = M.train_test_gap(tree, rows.filter("fold > 0"), rows.filter("fold = 0"), "y", "tree").first()
    assert gap["rmse_gap"] == pytest.approx(gap["test_rmse"] - gap["train_rmse"])


def test_many_terms_add_up_as_few_do(spark):
    from parcelry.operators.regression import NARROW, linear_expression

    weights = {f"c{i}": 0.5 * i - 2 for i in range(3 * NARROW)}
    rows = [tuple(float(r * i % 7) for i in range(len(weights))) for r in range(5)]
    rows.append((None, *rows[0][1:]))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in weights))
    found = [r[0] for r in df.select(linear_expression(1.5, weights)).collect()]
    assert found == pytest.approx([1.5 + sum(x * w for x, w in zip(row, weights.values())) for row in rows[:-1]] + [None])
