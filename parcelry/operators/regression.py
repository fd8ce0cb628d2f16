"""Regression on tables: estimators, evaluation, stacking, cross-validation, bootstrap.

Tree models and the plain linear ones are MLlib's. Where many linear fits of
the same rows are wanted (penalty grids, bootstrap replicates), all of them are
solved from sums of products taken in one aggregation.
"""

import json
import math

import numpy as np
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import functions as F

from parcelry.operators.explore import error_metrics
from parcelry.operators.gram import product_matrices
from parcelry.operators.resample import resampled_products
from parcelry.session import written

FEATURES = "features"


def assemble(df, columns, output=FEATURES):
    """One vector of the feature columns; rows with a missing one are an error, as in the fit."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


# --- estimators --------------------------------------------------------------


class LeastSquares:
    """Ordinary least squares."""

    def fit(self, df, label, features=FEATURES):
        return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0).fit(df)


class _Penalised:
    """Linear fit with the penalty stated on the scale of the original target."""

    def fit(self, df, label, features=FEATURES):
        stats = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("sd")).first()
        strength, mix = self.penalty(stats["n"], stats["sd"] or 1.0)
        estimator = LinearRegression(
            featuresCol=features, labelCol=label, standardization=False, regParam=strength, elasticNetParam=mix, maxIter=500, tol=1e-10
        )
        return estimator.fit(df)


class RidgeRegression(_Penalised):
    """Squared error sum plus alpha times the squared coefficients."""

    def __init__(self, alpha=1.0):
        self.alpha = alpha

    def penalty(self, n, sd):
        # The solver divides the target by its deviation before the penalty applies.
        return self.alpha * sd / n, 0.0


class ElasticNet(_Penalised):
    """Half the mean squared error plus alpha (ratio |w| + (1 - ratio)/2 w²)."""

    def __init__(self, alpha=1.0, l1_ratio=0.5):
        self.alpha, self.l1_ratio = alpha, l1_ratio

    def penalty(self, n, sd):
        l1, l2 = self.alpha * self.l1_ratio, self.alpha * (1 - self.l1_ratio) * sd
        return (l1 + l2, l1 / (l1 + l2)) if l1 + l2 else (0.0, 0.0)


class LassoRegression(ElasticNet):
    def __init__(self, alpha=1.0):
        super().__init__(alpha, 1.0)


class _Tree:
    def __init__(self, **params):
        self.params = {**self.defaults, **params}

    def fit(self, df, label, features=FEATURES):
        return self.kind(featuresCol=features, labelCol=label, **self.params).fit(df)


class TreeRegression(_Tree):
    kind, defaults = DecisionTreeRegressor, {"maxDepth": 10, "minInstancesPerNode": 10, "seed": 42}


class ForestRegression(_Tree):
    """The reference sizes (500 trees of depth 22) are passed as parameters when wanted."""

    kind = RandomForestRegressor
    defaults = {"numTrees": 20, "maxDepth": 8, "minInstancesPerNode": 5, "featureSubsetStrategy": "0.7", "seed": 42}


class BoostedRegression(_Tree):
    kind = GBTRegressor
    defaults = {"maxIter": 20, "stepSize": 0.1, "maxDepth": 5, "minInstancesPerNode": 15, "subsamplingRate": 0.8, "seed": 42}


def predict(model, df, name="prediction"):
    """``df`` with the model's prediction under ``name``."""
    if isinstance(model, Model):
        model = model.copy()
        model.setPredictionCol(name)
    return model.transform(df) if not isinstance(model, StackedModel) else model.transform(df, name)


# --- stacking ----------------------------------------------------------------


class StackedModel:
    def __init__(self, bases, meta, passthrough):
        self.bases, self.meta, self.passthrough = bases, meta, passthrough

    def transform(self, df, name="prediction"):
        columns = df.columns
        for key, model in self.bases.items():
            df = predict(model, df, f"__base_{key}")
        out = predict(self.meta, _meta_features(df, self.bases, self.passthrough), name)
        return out.select(*columns, name)


def _meta_features(df, bases, passthrough):
    inputs = [f"__base_{key}" for key in bases] + ([FEATURES] if passthrough else [])
    return assemble(df, inputs, "__meta")


class Stacking:
    """Base predictions made out of fold feed a final estimator; the bases are then refitted on all rows."""

    def __init__(self, bases, final, passthrough=False):
        self.bases, self.final, self.passthrough = dict(bases), final, passthrough

    def fit(self, df, label, fold="fold", folds=5):
        """``df`` holds the feature vector, the label and a fold number per row. It is read once for each base and fold, so it is stored first."""
        df = df.persist()
        try:
            return self._fit(df, label, fold, folds)
        finally:
            df.unpersist()

    def _fit(self, df, label, fold, folds):
        parts = []
        for k in range(folds):
            seen, held = df.filter(F.col(fold) != k), df.filter(F.col(fold) == k)
            for key, estimator in self.bases.items():
                held = predict(estimator.fit(seen, label), held, f"__base_{key}")
            parts.append(held)
        scored = parts[0]
        for part in parts[1:]:
            scored = scored.unionByName(part)
        # Read again by every pass of the final fit.
        inputs = _meta_features(scored, self.bases, self.passthrough).select("__meta", label).persist()
        try:
            meta = self.final.fit(inputs, label, "__meta")
        finally:
            inputs.unpersist()
        return StackedModel({key: e.fit(df, label) for key, e in self.bases.items()}, meta, self.passthrough)


# --- evaluation --------------------------------------------------------------


def evaluate(model, df, label, name):
    """One row: model, RMSE, MAE, R²."""
    scores = error_metrics(predict(model, df), label, "prediction")
    return scores.select(F.lit(name).alias("model"), "rmse", "mae", "r2")


def cross_validate(make, df, label, fold="fold", folds=5):
    """RMSE, MAE and R² per held-out fold. Every fit reads the rows again, so they are stored first."""
    df = written(df, "folds")
    parts = []
    for k in range(folds):
        model = make().fit(df.filter(F.col(fold) != k), label)
        parts.append(predict(model, df.filter(F.col(fold) == k)).select(fold, label, "prediction"))
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.union(part)
    return error_metrics(scored, label, "prediction", fold)


def cross_validate_linear(df, features, label, alpha=0.0, l1_ratio=0.0, fold="fold", on_sum=False):
    """(fold, n, rmse) of linear fits on the other folds: one pass for all folds, errors from the same sums.

    ``on_sum``: the penalty is stated against the sum of squared errors, as for ``ClosedRidge``, not against their mean.
    """
    sums = product_sums(df, features, label, [fold])
    total = sum(sums.values())
    rows = []
    for k, m in sorted(sums.items()):
        rest = total - m
        error = squared_error(m, *linear_from_sums(rest, alpha / rest[0, 0] if on_sum else alpha, l1_ratio))
        rows.append((int(k), int(round(m[0, 0])), math.sqrt(max(error, 0.0))))
    return df.sparkSession.createDataFrame(rows, "fold int, n long, rmse double")


def spread(scores, metric="rmse"):
    """Mean and population deviation of a metric over the folds."""
    return scores.agg(F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"))


def train_test_gap(model, train, test, label, name):
    """One row: the model's RMSE and R² on both parts, and by how much the test part is worse."""
    parts = evaluate(model, train, label, name).select("model", F.col("rmse").alias("train_rmse"), F.col("r2").alias("train_r2"))
    both = parts.join(evaluate(model, test, label, name).select("model", F.col("rmse").alias("test_rmse"), F.col("r2").alias("test_r2")), "model")
    return both.withColumns({"rmse_gap": F.col("test_rmse") - F.col("train_rmse"), "r2_gap": F.col("train_r2") - F.col("test_r2")})


def feature_importances(spark, model, columns):
    """(feature, importance) of a tree model whose vector was assembled from ``columns``, the largest first."""
    pairs = zip(columns, map(float, model.featureImportances.toArray()))
    return spark.createDataFrame(sorted(pairs, key=lambda p: (-p[1], p[0])), "feature string, importance double")


# --- saving ------------------------------------------------------------------


def save_model(spark, model, path):
    """Store a fitted model: MLlib models in their own format, stacks with all their parts, searches as numbers."""
    if isinstance(model, StackedModel):
        about = {"kind": "stack", "bases": list(model.bases), "passthrough": model.passthrough}
        for key, base in model.bases.items():
            save_model(spark, base, f"{path}/base-{key}")
        save_model(spark, model.meta, f"{path}/meta")
    elif isinstance(model, ElasticNetSearch):
        about = {"kind": "search", **{k: getattr(model, k) for k in ("l1_ratio", "alpha", "error", "coefficients")}, "intercept": float(model.intercept)}
    else:
        about = {"kind": type(model).__name__}
        model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(about, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
    return path


MODELS = {m.__name__: m for m in (LinearRegressionModel, DecisionTreeRegressionModel, RandomForestRegressionModel, GBTRegressionModel)}


def load_model(spark, path):
    about = json.loads(spark.read.text(f"{path}/about").first()[0])
    if about["kind"] == "stack":
        return StackedModel({key: load_model(spark, f"{path}/base-{key}") for key in about["bases"]}, load_model(spark, f"{path}/meta"), about["passthrough"])
    if about["kind"] == "search":
        model = ElasticNetSearch()
        for name in ("l1_ratio", "alpha", "error", "coefficients", "intercept"):
            setattr(model, name, about[name])
        return model
    return MODELS[about["kind"]].load(f"{path}/model")


# --- many linear fits from one aggregation -----------------------------------


#: Up to so many columns their products are plain expressions; more go to matrix products. The sums are the same.
NARROW = 8


def product_sums(df, features, label, by=(), weight=None, groups=128):
    """{group: matrix of sums of products of (1, features, label)}, one aggregation over the rows without a missing cell.

    The groups are folds or replicates: a parameter of the caller, not data.
    """
    columns = [*features, label]
    if len(columns) > NARROW:
        return product_matrices(df, columns, by[0] if by else None, weight, groups)
    df = df.dropna(subset=[f"`{c}`" for c in columns])
    z = [F.lit(1.0), *[F.col(f"`{c}`").cast("double") for c in columns]]
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    size = len(z)
    sums = [F.sum(w * z[a] * z[b]).alias(f"s{a}_{b}") for a in range(size) for b in range(a, size)]
    found = {}
    for row in df.groupBy(*by).agg(*sums).collect():
        matrix = np.array([[row[f"s{min(a, b)}_{max(a, b)}"] for b in range(size)] for a in range(size)])
        found[row[by[0]] if by else None] = matrix
    return found


class ClosedRidge:
    """Ridge on any number of columns, solved from their sums of products in one pass over the rows.

    Squared error sum plus alpha times the squared coefficients; the intercept is free.
    """

    def __init__(self, alpha=1.0):
        self.alpha = alpha

    def fit(self, df, features, label):
        m = product_sums(df, features, label)[None]
        self.intercept, weights = linear_from_sums(m, self.alpha / m[0, 0])
        self.coefficients = dict(zip(features, map(float, weights)))
        return self

    def transform(self, df, name="prediction"):
        return df.withColumn(name, linear_expression(float(self.intercept), self.coefficients))


def _centred(m):
    n = m[0, 0]
    mean = m[0, 1:] / n
    return n, mean, m[1:, 1:] / n - np.outer(mean, mean)


def linear_from_sums(m, alpha=0.0, l1_ratio=0.0, rounds=10_000, tolerance=1e-12, start=None):
    """(intercept, coefficients) of the elastic net with penalty alpha on the mean squared error."""
    n, mean, c = _centred(m)
    xx, xy = c[:-1, :-1], c[:-1, -1]
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    if l1 == 0 and l2 > 0:
        w = np.linalg.solve(xx + l2 * np.eye(len(xy)), xy)
    elif l1 == 0:
        w = np.linalg.lstsq(xx + l2 * np.eye(len(xy)), xy, rcond=None)[0]
    else:
        w = np.zeros(len(xy)) if start is None else start.copy()
        for _ in range(rounds):
            largest = 0.0
            for j in range(len(w)):
                if xx[j, j] + l2 == 0:
                    continue
                pull = xy[j] - xx[j] @ w + xx[j, j] * w[j]
                new = math.copysign(max(abs(pull) - l1, 0.0), pull) / (xx[j, j] + l2)
                largest, w[j] = max(largest, abs(new - w[j])), new
            if largest < tolerance * max(1.0, np.abs(w).max()):
                break
    return mean[-1] - mean[:-1] @ w, w


def squared_error(m, intercept, w):
    """Mean squared error of a linear model on the rows behind ``m``."""
    v = np.concatenate([[-intercept], -w, [1.0]])
    return float(v @ m @ v / m[0, 0])


# The penalty grid.
L1_RATIOS = [0.1, 0.3, 0.5, 0.7, 0.9]
ALPHAS = [10 ** (-3 + 4 * i / 19) for i in range(20)]


def elastic_net_path(df, features, label, fold="fold", l1_ratios=L1_RATIOS, alphas=ALPHAS):
    """Mean held-out error of every (ratio, alpha), best first, from one pass over the rows."""
    sums = product_sums(df, features, label, [fold])
    total = sum(sums.values())
    scores = []
    for ratio in l1_ratios:
        # from the strongest penalty on, each fit starts where the one before ended
        last = dict.fromkeys(sums)
        for alpha in sorted(alphas, reverse=True):
            errors = []
            for fold, m in sums.items():
                intercept, last[fold] = linear_from_sums(total - m, alpha, ratio, start=last[fold])
                errors.append(squared_error(m, intercept, last[fold]))
            scores.append((float(ratio), float(alpha), float(np.mean(errors))))
    scores.sort(key=lambda s: s[2])
    return scores, total


class ElasticNetSearch:
    """Elastic net with the penalty chosen by cross-validation."""

    def __init__(self, l1_ratios=L1_RATIOS, alphas=ALPHAS):
        self.l1_ratios, self.alphas = l1_ratios, alphas

    def fit(self, df, features, label, fold="fold"):
        scores, total = elastic_net_path(df, features, label, fold, self.l1_ratios, self.alphas)
        self.l1_ratio, self.alpha, self.error = scores[0]
        self.intercept, weights = linear_from_sums(total, self.alpha, self.l1_ratio)
        self.coefficients = dict(zip(features, map(float, weights)))
        return self

    def transform(self, df, name="prediction"):
        return df.withColumn(name, linear_expression(float(self.intercept), self.coefficients))


def linear_expression(intercept, coefficients):
    """Terms are added in pairs, so that the expression stays shallow; more than ``NARROW`` are added up as a list, since one expression of them is too long to be compiled."""
    if len(coefficients) > NARROW:
        cells = F.array(*[F.col(f"`{c}`").cast("double") for c in coefficients])
        products = F.zip_with(cells, F.lit([float(w) for w in coefficients.values()]), lambda x, w: x * w)
        return F.aggregate(products, F.lit(float(intercept)), lambda a, b: a + b)
    terms = [F.lit(intercept), *[F.col(f"`{c}`").cast("double") * F.lit(w) for c, w in coefficients.items()]]
    while len(terms) > 1:
        terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) // 2 * 2 :]
    return terms[0]


def bootstrap_linear(df, ident, features, label, replicates=100, seed=42, alpha=0.0, l1_ratio=0.0):
    """(replicate, intercept, coefficients) of a linear fit on each resample of n draws from the n rows without a missing cell.

    ``ident`` is accepted for compatibility: rows of equal features and label stand for each other.
    """
    sums = resampled_products(df, [*features, label], replicates, seed)
    fits = [(r, *linear_from_sums(m, alpha, l1_ratio)) for r, m in sorted(sums.items())]
    rows = [(int(r), float(b), [float(x) for x in w]) for r, b, w in fits]
    return df.sparkSession.createDataFrame(rows, "replicate int, intercept double, coefficients array<double>")


def prediction_interval(fits, point, level=0.95):
    """Mean, deviation and percentile interval of the replicates' predictions at one point."""
    value = F.col("intercept") + sum((F.col("coefficients")[i] * F.lit(float(v)) for i, v in enumerate(point)), F.lit(0.0))
    tail = (1 - level) / 2
    return fits.select(value.alias("p")).agg(
        F.avg("p").alias("mean"), F.stddev_pop("p").alias("std"), F.percentile("p", F.lit(tail)).alias("low"), F.percentile("p", F.lit(1 - tail)).alias("high")
    )


def bootstrap_line_band(df, ident, x, y, points, replicates=100, seed=42, level=0.95):
    """Percentile band around the regression line of y on x at the given points."""
    fits = bootstrap_linear(df.dropna(subset=[x, y]), ident, [x], y, replicates, seed)
    at = fits.select(F.explode(F.lit([float(p) for p in points])).alias("x"), (F.col("intercept")).alias("b"), F.col("coefficients")[0].alias("w"))
    value = F.col("b") + F.col("w") * F.col("x")
    tail = (1 - level) / 2
    return at.groupBy("x").agg(F.percentile(value, F.lit(tail)).alias("low"), F.percentile(value, F.lit(1 - tail)).alias("high"))
