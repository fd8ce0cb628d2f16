"""Exact resampling: n draws, the same under any partitioning, and binomial in distribution."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelry.operators import regression as M, resample


@pytest.fixture(autouse=True)
def small_cells(monkeypatch):
    monkeypatch.setattr(resample, "CELL_ROWS", 16)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    data = [(int(k), float(k % 17), float(rng.normal() + 2 * (k % 17)), "t") for k in range(600)] + [(7, 7.0, 7.0, "hot")] * 300 + [(None, None, 1.0, None)]
    return spark.createDataFrame(data, "key long, x double, y double, t string")


def drawn(df, n=40):
    return {(r.key, r.x, r.y, r.t, r.replicate): r.weight for r in resample.resample(df, n).collect()}


def test_every_replicate_has_as_many_draws_as_rows(rows):
    sums = resample.resample(rows.repartition(3), 40).groupBy("replicate").agg(F.sum("weight").alias("n"), F.count("*").alias("rows")).collect()
    assert len(sums) == 40 and {r.n for r in sums} == {901}
    assert all(350 < r.rows < 420 for r in sums)


def test_same_draws_under_any_partitioning(rows):
    assert drawn(rows.repartition(1)) == drawn(rows.repartition(9)) != {}
    other = {(r.key, r.replicate): r.weight for r in resample.resample(rows, 40, seed=7).collect()}
    assert other != {(k[0], k[4]): w for k, w in drawn(rows).items()}


def test_draws_follow_the_multinomial(rows):
    got = drawn(rows, 200)
    hot = np.array([w for k, w in got.items() if k[3] == "hot"])
    assert len(hot) == 200 and abs(hot.mean() - 300) < 4 and abs(hot.std() - np.sqrt(300 * 601 / 901)) < 3
    single = np.zeros(200)
    for k, w in got.items():
        if k[0] == 11:
            single[k[4]] = w
    assert 0.7 < single.mean() < 1.3 and 0.6 < single.var() < 1.5
    by_key = np.zeros(600)
    for k, w in got.items():
        if k[3] == "t":
            by_key[k[0]] += w
    assert abs(by_key.mean() / 200 - 1) < 0.05 and 0.5 < by_key.var() / 200 < 1.5


def test_products_are_those_of_the_drawn_rows(rows):
    pairs = rows.select("x", "y").dropna()
    sums = resample.resampled_products(rows, ["x", "y"], 5)
    for r in range(5):
        part = [(a.x, a.y, a.weight) for a in resample.resample(pairs.toDF("x0", "x1").select(F.col("x0").alias("x"), F.col("x1").alias("y")), 5).where(F.col("replicate") == r).collect()]
        z = np.array([[1, x, y] for x, y, _ in part]) * np.sqrt([[w] for *_, w in part])
        assert sums[r][0, 0] == 900
        np.testing.assert_allclose(sums[r][0, 0], (z.T @ z)[0, 0])
        np.testing.assert_allclose(sums[r], z.T @ z)


def test_interval_of_refits(rows):
    fits = M.bootstrap_linear(rows.where("t = 't'"), "key", ["x"], "y", replicates=60)
    got = M.prediction_interval(fits, [5.0]).first()
    assert got["low"] < 10.0 + 0.2 and got["high"] > 10.0 - 0.2 and 0.01 < got["std"] < 0.2


def test_empty_and_single(spark, rows):
    assert resample.resample(rows.limit(0), 5).count() == 0 and resample.resampled_products(rows.limit(0), ["x", "y"], 3).keys() <= {0, 1, 2}
    one = resample.resample(rows.where("key = 3"), 4).collect()
    assert [r.weight for r in one] == [1] * 4
