"""Box-Cox and Yeo-Johnson: the exponent of greatest likelihood, then standardised.

With v = log x (Box-Cox) or v = sign(x) log(1 + |x|) (Yeo-Johnson) both bends are v e(z), where e(z) = (exp(z) - 1) / z,
z = v p, and z = v (p - 2) for negative values of Yeo-Johnson. Their derivatives by p are v² e'(z) and v³ e''(z), so the slope
and the curvature of the log likelihood follow from seven moments, one aggregation for each Newton step. The log likelihood of
both is concave in p, so a bracket on the sign of its slope keeps every step safe.
"""

import math

import numpy as np
from pyspark.sql import functions as F

from parcelry.operators.prep.base import PreprocessingStrategy
from parcelry.session import written

TOLERANCE = 1e-7
REACH = 64.0
QUANTILES = 200
NEAR_ZERO = 0.1
SERIES = 9


def box_cox(x, power):
    return F.when(power == 0, F.log(x)).otherwise((F.pow(x, power) - 1) / F.nullif(power, F.lit(0.0)))


def yeo_johnson(x, power):
    rest = F.lit(2.0) - power
    up = F.when(power == 0, F.log1p(x)).otherwise((F.pow(x + 1, power) - 1) / F.nullif(power, F.lit(0.0)))
    down = F.when(rest == 0, -F.log1p(-x)).otherwise(-(F.pow(1 - x, rest) - 1) / F.nullif(rest, F.lit(0.0)))
    return F.when(x >= 0, up).otherwise(down)


def _series(z, order):
    """Taylor series of the ``order``-th derivative of (exp(z) - 1) / z."""
    total = 0.0
    for k in reversed(range(SERIES)):
        total = total * z + math.prod(range(k + 1, k + order + 1)) / math.factorial(k + order + 1)
    return total


def _bends(z, exp, choose):
    """(exp(z) - 1) / z and its first two derivatives, from arrays or from columns."""
    near = abs(z) < NEAR_ZERO if isinstance(z, np.ndarray) else F.abs(z) < NEAR_ZERO
    far = choose(near, 1.0 + 0.0 * z, z)
    e = exp(far)
    closed = (e - 1) / far, (e * (far - 1) + 1) / (far * far), (e * (far * far - 2 * far + 2) - 2) / (far * far * far)
    return [choose(near, _series(z, order), c) for order, c in enumerate(closed)]


def _slope(n, log_slope, mean, vt, ct1, v1, ct2):
    """Slope and curvature of -n/2 log var(t) + (p - 1) log_slope; None where the moments are no numbers."""
    if not all(m is not None and math.isfinite(m) for m in (mean, vt, ct1, v1, ct2)) or vt <= 0:
        return None
    first, second = 2 * ct1 / vt, 2 * (v1 + ct2) / vt
    return log_slope - n / 2 * first, -n / 2 * (second - first * first)


def _climb(start, moments, n, log_slope):
    """Root of the slope: ``(p, moments at p)``. Newton steps within a bracket, halved where a step leaves it."""
    low, high, p, good = -REACH, REACH, start, None
    for _ in range(80):
        found = moments(p)
        at = _slope(n, log_slope, *found)
        if at is None:
            # numbers overflow here: towards the last usable exponent, or towards no bend at all
            target = 1.0 if good is None else good
            if abs(p - target) < TOLERANCE:
                break
            low, high, p = (low, p, (p + target) / 2) if p > target else (p, high, (p + target) / 2)
            continue
        slope, curve = at
        good = p
        low, high = (p, high) if slope > 0 else (low, p)
        step = -slope / curve if curve < 0 else math.copysign(1.0, slope)
        step = max(-4.0, min(4.0, step))
        if abs(step) < TOLERANCE or high - low < TOLERANCE:
            return p, found
        p = p + step if low < p + step < high else (low + high) / 2
    return p, moments(p)


class _PowerTransform(PreprocessingStrategy):
    """Null and NaN cells are left out of the fit and stay as they are; infinite ones are an error.

    The fit stores the one column, takes counts, sums and quantiles in one aggregation, starts from the exponent of the
    quantiles and needs one more aggregation for each Newton step, mostly three or four. The start has no effect on the result
    beyond the tolerance. A constant column keeps its exponent 1. Exponents are sought within ``REACH`` of zero.
    """

    def __init__(self, column, power=None):
        super().__init__(column=column, power=power)

    def fit(self, df, y=None):
        self._check(df)
        x = F.col(self.params["column"]).cast("double")
        values = df.select(F.when(~F.isnan(x), x).alias("x")).dropna()
        power = self.params["power"]
        if power is not None:
            self._admit(values.agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first())
            bent = values.agg(F.avg(self._bend(F.col("x"), F.lit(float(power)))).alias("m"), F.stddev_pop(self._bend(F.col("x"), F.lit(float(power)))).alias("s")).first()
            self.state = {"power": power, "mean": bent["m"], "std": bent["s"] or 1.0}
            return self
        values = written(values.select("x", self._log(F.col("x")).alias("v")), "power")
        shares = [(i + 0.5) / QUANTILES for i in range(QUANTILES)]
        stats = values.agg(
            F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("v").alias("slope"),
            F.percentile_approx("v", shares, 10_000).alias("q"),
        ).first()
        self._admit(stats)
        if stats["lo"] == stats["hi"]:
            self.state = {"power": 1.0, "mean": values.agg(F.min(self._bend(F.col("x"), F.lit(1.0)))).first()[0], "std": 1.0}
            return self
        rough = np.array(stats["q"], float)
        start = 1.0
        if rough[0] < rough[-1]:
            start = _climb(1.0, lambda p: self._rough(rough, p), len(rough), float(rough.sum()))[0]
        power, found = _climb(start, lambda p: self._bent(values, p), stats["n"], stats["slope"])
        self.state = {"power": power, "mean": found[0], "std": math.sqrt(found[1]) or 1.0}
        return self

    def _rough(self, v, p):
        """The moments of a small array."""
        with np.errstate(all="ignore"):
            e0, e1, e2 = _bends(np.where((v < 0) & self._two_sided, v * (p - 2), v * p), np.exp, np.where)
            t, t1, t2 = (d - d.mean() for d in (v * e0, v * v * e1, v * v * v * e2))
            return float((v * e0).mean()), *(float((a * b).mean()) for a, b in ((t, t), (t, t1), (t1, t1), (t, t2)))

    def _bent(self, values, p):
        """Mean and variance of the bent column, and the moments of its derivatives by ``p``, in one aggregation."""
        v = F.col("v")
        z = v * F.lit(float(p))
        if self._two_sided:
            z = F.when(v < 0, v * F.lit(float(p) - 2)).otherwise(z)
        e0, e1, e2 = _bends(F.col("z"), F.exp, lambda c, a, b: F.when(c, a).otherwise(b))
        bent = values.select("v", z.alias("z")).select((v * e0).alias("t"), (v * v * e1).alias("t1"), (v * v * v * e2).alias("t2"))
        return tuple(bent.agg(F.avg("t"), F.var_pop("t"), F.covar_pop("t", "t1"), F.var_pop("t1"), F.covar_pop("t", "t2")).first())

    def transform(self, df):
        self._require_fit()
        c = self.params["column"]
        bent = self._bend(F.col(c).cast("double"), F.lit(float(self.state["power"])))
        return df.withColumn(c, (bent - F.lit(self.state["mean"])) / F.lit(self.state["std"]))

    def _admit(self, stats):
        if not stats["n"]:
            raise ValueError("no values to fit on")
        if math.isinf(stats["lo"]) or math.isinf(stats["hi"]):
            raise ValueError("power transforms need finite values")


class BoxCoxTransformer(_PowerTransform):
    """For positive values only."""

    _bend, _two_sided = staticmethod(box_cox), False

    def _log(self, x):
        return F.when(x > 0, F.log(x))

    def _admit(self, stats):
        if not stats["n"] or stats["lo"] <= 0:
            raise ValueError("Box-Cox needs positive values")
        super()._admit(stats)


class YeoJohnsonTransformer(_PowerTransform):
    """For values of any sign."""

    _bend, _two_sided = staticmethod(yeo_johnson), True

    def _log(self, x):
        return F.signum(x) * F.log1p(F.abs(x))
