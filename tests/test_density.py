"""Kernel density against the plain sum over all values."""

import numpy as np
import pytest

from parcelry.operators import explore


def plain(x, points, cut):
    width = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - cut * width, x.max() + cut * width, points)
    z = (grid[:, None] - x[None, :]) / width
    return grid, np.exp(-0.5 * z * z).sum(axis=1) / (len(x) * width * np.sqrt(2 * np.pi))


rng = np.random.default_rng(9)
SETS = {
    "normal": rng.normal(size=3000) * 40 - 7,
    "two": np.array([1.0, 2.0]),
    "tied": rng.integers(0, 4, size=2000).astype(float),
    "far": np.append(rng.normal(size=2000), [1e5]),
    "tiny": rng.normal(size=1000) * 1e-9 + 1e-7,
}


@pytest.mark.parametrize("name", SETS)
@pytest.mark.parametrize("points, cut", [(200, 0.0), (31, 3.0)])
def test_density_equals_plain_sum(spark, name, points, cut):
    x = SETS[name]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "v double").repartition(5)
    rows = explore.density(df, "v", points=points, cut_widths=cut).orderBy("i").collect()
    grid, want = plain(x, points, cut)
    assert [r["i"] for r in rows] == list(range(points))
    assert np.allclose([r["x"] for r in rows], grid, rtol=1e-12, atol=1e-12 * np.abs(grid).max())
    assert np.allclose([r["density"] for r in rows], want, rtol=1e-9, atol=1e-12 * want.max())


def test_density_needs_two_finite_values(spark):
    for bad in ([], [1.0, 1.0], [None], [1.0, float("inf")]):
        with pytest.raises(ValueError):
            explore.density(spark.createDataFrame([(v,) for v in bad], "v double"), "v")
