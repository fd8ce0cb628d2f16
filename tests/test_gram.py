"""Matrix products over the rows, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelry.operators import explore, gram, regression as M
from parcelry.plans import features as plan

P = 30


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, P)) + np.arange(P) * 100
    x[:, 3] = 7.0
    holes = rng.random((700, P)) < 0.05
    rows = [[None if holes[i, j] and j % 2 else float("nan") if holes[i, j] else float(x[i, j]) for j in range(P)] + [i % 4, i % 3] for i in range(700)]
    return spark.createDataFrame(rows, ", ".join([*(f"`c {j}` double" for j in range(P)), "fold int", "w int"])).repartition(5), np.where(holes, np.nan, x)


COLUMNS = [f"c {j}" for j in range(P)]


def test_products_by_group_and_weight(table):
    df, x = table
    got = gram.product_matrices(df, COLUMNS, "fold", "w", groups=4)
    for k in range(4):
        rows = [i for i in range(700) if i % 4 == k and not np.isnan(x[i]).any()]
        z = np.column_stack([np.ones(len(rows)), x[rows]])
        np.testing.assert_allclose(got[k], (z * np.array([[i % 3] for i in rows])).T @ z, rtol=1e-10)
    with pytest.raises(Exception, match="groups"):
        gram.product_matrices(df, COLUMNS, "fold", groups=2)
    with pytest.raises(ValueError):
        gram.product_matrices(df, [f"c {j}" for j in range(5000)])


def test_narrow_and_wide_sums_agree(table, monkeypatch):
    df, _ = table
    df = df.select(*[F.when(~F.isnan(f"c {j}"), F.col(f"c {j}")).alias(f"d{j}") for j in range(4)], "fold")
    narrow = M.product_sums(df, ["d0", "d1", "d2"], "d3", ["fold"])
    monkeypatch.setattr(M, "NARROW", 1)
    wide = M.product_sums(df, ["d0", "d1", "d2"], "d3", ["fold"])
    assert narrow.keys() == wide.keys()
    for k in narrow:
        np.testing.assert_allclose(narrow[k], wide[k], rtol=1e-12)


def test_pairwise_complete_correlations(table):
    df, x = table
    got = {(r.col_a, r.col_b): r.r for r in explore.correlations(df, COLUMNS).collect()}
    for a in range(P):
        for b in range(P):
            both = ~np.isnan(x[:, a]) & ~np.isnan(x[:, b])
            if 3 in (a, b):
                assert got[f"c {a}", f"c {b}"] is None
            else:
                assert got[f"c {a}", f"c {b}"] == pytest.approx(np.corrcoef(x[both, a], x[both, b])[0, 1], abs=1e-9)


def test_empty_table(table):
    df, _ = table
    assert gram.product_matrices(df.limit(0), COLUMNS) == {}
    assert {r.r for r in explore.correlations(df.limit(0), COLUMNS).collect()} == {None}


def test_ridge_and_search_on_every_column_of_the_feature_table(spark):
    from catalogue.registry import homes

    train, _, _ = plan.train_and_test(homes(spark, "/root/testdata/sf0.001").drop("key"))
    inputs = [c for c in train.columns if c not in ("id", "log_price")]
    assert len(inputs) > 25
    model = M.ClosedRidge(10.0).fit(train, inputs, "log_price")
    data = np.array([[float(v) for v in r] for r in train.select(*[F.col(f"`{c}`").cast("double") for c in [*inputs, "log_price"]]).collect()])
    x, y = data[:, :-1] - data[:, :-1].mean(axis=0), data[:, -1] - data[:, -1].mean()
    want = np.linalg.solve(x.T @ x + 10.0 * np.eye(len(inputs)), x.T @ y)
    np.testing.assert_allclose([model.coefficients[c] for c in inputs], want, atol=1e-8)
    error = M.evaluate(model, train, "log_price", "ridge").first()["rmse"]
    assert error == pytest.approx(np.sqrt(np.mean((y - x @ want) ** 2)), abs=1e-8)
    # the lasso's optimality conditions on all columns
    m = M.product_sums(train, inputs, "log_price")[None]
    _, w = M.linear_from_sums(m, 0.02, 1.0)
    pull = x.T @ (y - x @ w) / len(y)
    assert np.all(np.abs(pull) <= 0.02 + 1e-8) and np.allclose(pull[w != 0], 0.02 * np.sign(w[w != 0]), atol=1e-8)
