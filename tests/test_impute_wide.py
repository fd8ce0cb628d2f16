"""Imputation of many columns, one pass for each step."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelry.operators.prep import MICEImputation, impute


def table(spark, k, n=400, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 3))
    x = base @ rng.normal(size=(3, k)) + 0.1 * rng.normal(size=(n, k)) + 5 * np.arange(k)
    holes = rng.random((n, k)) < 0.15
    holes[:, 0] = False
    rows = [[int(i), *[None if holes[i, j] and j % 2 else float("nan") if holes[i, j] else float(x[i, j]) for j in range(k)]] for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(["id long", *(f"c{j} double" for j in range(k))])).repartition(4), x, holes


@pytest.mark.parametrize("nearest", [None, 2])
def test_passes_give_what_the_patterns_give(spark, monkeypatch, nearest):
    df, _, holes = table(spark, 5)
    columns = [f"c{j}" for j in range(5)]
    step = MICEImputation(columns, max_iter=4, n_nearest_features=nearest)
    flat = step.fit_transform(df).orderBy("id").collect()
    monkeypatch.setattr(impute, "FLAT_LIMIT", 2)
    wide_step = MICEImputation(columns, max_iter=4, n_nearest_features=nearest)
    wide = wide_step.fit_transform(df).orderBy("id").collect()
    assert len(wide_step.state["chain"]) == len(step.state["chain"])
    np.testing.assert_allclose([r[1:] for r in wide], [r[1:] for r in flat], rtol=1e-8)


def test_forty_columns(spark):
    df, x, holes = table(spark, 40)
    columns = [f"c{j}" for j in range(40)]
    step = MICEImputation(columns, max_iter=2).fit(df)
    got = np.array([r[1:] for r in step.transform(df).orderBy("id").collect()])
    np.testing.assert_allclose(got[~holes], x[~holes])
    # the rows have far more patterns than the driver could hold matrices for 2^40 of them; gaps are filled well
    assert np.abs(got[holes] - x[holes]).mean() < 0.25 * x.std(axis=0).mean()
    assert step.transform(df.limit(0)).count() == 0
    assert step.transform(df.select("id", *columns, F.lit("t").alias("other"))).columns[-1] == "other"
