"""Power transforms against a fine search, at values that strain the numbers."""

import numpy as np
import pytest

from parcelry.operators import prep
from parcelry.operators.prep import power

STEPS = {"box-cox": prep.BoxCoxTransformer, "yeo-johnson": prep.YeoJohnsonTransformer}


def likelihood(x, p, kind):
    if kind == "box-cox":
        t = np.log(x) if abs(p) < 1e-9 else np.expm1(p * np.log(x)) / p
        return -len(x) / 2 * np.log(t.var()) + (p - 1) * np.log(x).sum()
    up, down = x[x >= 0], x[x < 0]
    t = np.concatenate([np.expm1(p * np.log1p(up)) / p if p else np.log1p(up), -np.expm1((2 - p) * np.log1p(-down)) / (2 - p) if p != 2 else -np.log1p(-down)])
    return -len(x) / 2 * np.log(t.var()) + (p - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()


def golden(x, kind, low=-40.0, high=40.0):
    ratio = (5**0.5 - 1) / 2
    while high - low > 1e-9:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (a, high) if likelihood(x, a, kind) < likelihood(x, b, kind) else (low, b)
    return (low + high) / 2


rng = np.random.default_rng(4)
SETS = {
    "log-normal": ("box-cox", np.exp(rng.normal(size=4000))),
    "prices": ("box-cox", np.round(rng.gamma(3, 5e4, size=5000), 2) + 1),
    "sorted": ("box-cox", np.sort(rng.uniform(1, 3, size=3000)) ** 5),
    "one apart": ("box-cox", np.array([1.0] * 6 + [2.0])),
    "signed": ("yeo-johnson", rng.standard_t(4, size=4000) * 3 - 1),
    "negative": ("yeo-johnson", -np.exp(rng.normal(size=3000))),
    "balances": ("yeo-johnson", rng.uniform(-999, 9999, size=5000) / 1000),
}


@pytest.mark.parametrize("name", SETS)
def test_exponent_is_that_of_a_fine_search(spark, name):
    kind, x = SETS[name]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "f double").repartition(4)
    step = STEPS[kind]("f").fit(df)
    best = golden(x, kind)
    assert likelihood(x, step.state["power"], kind) >= likelihood(x, best, kind) - 1e-6
    assert step.state["power"] == pytest.approx(best, abs=2e-4)
    out = np.array([r[0] for r in step.transform(df).collect() if r[0] is not None and r[0] == r[0]])
    assert len(out) == len(x) and out.mean() == pytest.approx(0, abs=1e-6) and out.std() == pytest.approx(1, abs=1e-6)


def test_few_aggregations(spark, monkeypatch):
    seen = []
    plain = prep.BoxCoxTransformer._bent
    monkeypatch.setattr(prep.BoxCoxTransformer, "_bent", lambda self, values, p: seen.append(p) or plain(self, values, p))
    prep.BoxCoxTransformer("f").fit(spark.createDataFrame([(float(v),) for v in SETS["prices"][1]], "f double"))
    assert len(seen) <= 5


def test_derivatives_near_zero_and_far():
    z = np.array([-3.0, -0.1001, -0.0999, -1e-9, 0.0, 1e-9, 0.0999, 0.1001, 2.0])
    f = lambda z: np.where(z == 0, 1.0, np.expm1(z) / np.where(z == 0, 1, z))
    e0, e1, e2 = power._bends(z, np.exp, np.where)
    d = 1e-4
    assert np.allclose(e0, f(z), rtol=1e-12)
    assert np.allclose(e1, (power._bends(z + d, np.exp, np.where)[0] - power._bends(z - d, np.exp, np.where)[0]) / (2 * d), rtol=1e-6)
    assert np.allclose(e2, (power._bends(z + d, np.exp, np.where)[1] - power._bends(z - d, np.exp, np.where)[1]) / (2 * d), rtol=1e-6)


def test_edge_inputs(spark):
    one = spark.createDataFrame([(3.0,), (3.0,), (None,)], "f double")
    for step in STEPS.values():
        assert step("f").fit(one).state["power"] == 1.0
        assert [r[0] for r in step("f").fit_transform(one).collect()] == [0.0, 0.0, None]
        for bad in ([], [float("inf"), 1.0], [None]):
            with pytest.raises(ValueError):
                step("f").fit(spark.createDataFrame([(v,) for v in bad], "f double"))


def test_a_peak_beyond_the_reach_ends_there(spark):
    step = prep.BoxCoxTransformer("f").fit(spark.createDataFrame([(1.0,)] * 500 + [(2.0,)], "f double"))
    assert step.state["power"] == pytest.approx(-power.REACH, abs=1e-6)
