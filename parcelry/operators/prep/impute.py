"""Iterative imputation by chained Bayesian ridge regressions.

Every imputed cell is an affine function of the observed cells of its row, and
rows with the same missing cells share that function. So the moments of the
completed table follow from the moments of the observed cells per missing
pattern, and one distributed aggregation serves all rounds of the chain; only
small matrices are handled on the driver. A second aggregation measures how far
the cells move per round, for the stopping rule.

The number of patterns can double with each column. Beyond FLAT_LIMIT columns
each step is a pass of its own instead: tasks complete their rows as far as the
chain has come and add up one moment matrix of the rows in which the column is
observed, and the completed rows are stored once a round. The driver holds one
matrix, whatever the patterns.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from parcelry.operators import gram
from parcelry.operators.prep.base import PreprocessingStrategy, as_list
from parcelry.session import share_package, written

FLAT_LIMIT = 6


def bayesian_ridge(xx, xy, yy, n, rounds=300, tolerance=1e-3, shape=1e-6):
    """Coefficients from centred moments, with noise and weight precision re-estimated in turn."""
    values, vectors = np.linalg.eigh(xx)
    values = np.clip(values, 0.0, None)
    turned = vectors.T @ xy
    noise, weight = 1.0 / (yy / n + np.finfo(float).eps), 1.0
    previous = None
    for _ in range(rounds):
        coefficients = vectors @ (turned / (values + weight / noise))
        error = max(yy - 2 * coefficients @ xy + coefficients @ xx @ coefficients, 0.0)
        effective = np.sum(noise * values / (weight + noise * values))
        weight = (effective + 2 * shape) / (coefficients @ coefficients + 2 * shape)
        noise = (n - effective + 2 * shape) / (error + 2 * shape)
        if previous is not None and np.abs(previous - coefficients).sum() < tolerance:
            break
        previous = coefficients
    return vectors @ (turned / (values + weight / noise))


def _clean(c):
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def advance(z, missing, steps):
    """Complete rows in place: each step sets the missing cells of its column from all others."""
    for step in steps:
        j, line = step["column"], np.asarray(step["line"])
        at = np.flatnonzero(missing[:, j])
        if len(at):
            z[at, j] = line[0] + z[at] @ line[1:]
    return z


def regression_line(total, j, others, k):
    """Intercept and slopes of column ``j`` on ``others`` from the moments of (1, columns), as a line over all columns."""
    n = total[0, 0]
    at = [i + 1 for i in others]
    mean_x, mean_y = total[at, 0] / n, total[j + 1, 0] / n
    xx = total[np.ix_(at, at)] - n * np.outer(mean_x, mean_x)
    xy = total[at, j + 1] - n * mean_x * mean_y
    yy = total[j + 1, j + 1] - n * mean_y**2
    slope = bayesian_ridge(xx, xy, max(yy, 0.0), n)
    line = np.zeros(k + 1)
    line[at] = slope
    line[0] = mean_y - slope @ mean_x
    return line


class MICEImputation(PreprocessingStrategy):
    """Start from the column means; refit each column on the others, the fullest column first.

    ``random_state`` is accepted for compatibility: nothing is drawn at random.
    ``n_nearest_features`` below the number of other columns keeps the most
    correlated ones.
    """

    def __init__(self, columns, max_iter=10, tol=1e-3, random_state=None, n_nearest_features=None):
        super().__init__(columns=as_list(columns), max_iter=max_iter, tol=tol, random_state=random_state, n_nearest_features=n_nearest_features)

    def fit(self, df, y=None):
        self._check(df)
        columns = self.params["columns"]
        k = len(columns)
        cells = df.select(*[_clean(c).alias(f"x{i}") for i, c in enumerate(columns)])
        first = cells.agg(
            *[F.avg(f"x{i}").alias(f"m{i}") for i in range(k)],
            *[F.count_if(F.col(f"x{i}").isNull()).alias(f"n{i}") for i in range(k)],
            *[F.max(F.abs(f"x{i}")).alias(f"t{i}") for i in range(k)],
        ).first()
        means = [first[f"m{i}"] for i in range(k)]
        if any(m is None for m in means):
            raise ValueError(f"no observed values in {[c for c, m in zip(columns, means) if m is None]}")
        self.state = {"means": means, "chain": []}
        if k == 1:
            return self
        order = sorted(range(k), key=lambda i: (first[f"n{i}"], i))
        if k > FLAT_LIMIT:
            self.state["chain"] = self._passes(cells, means, order, self.params["tol"] * max(first[f"t{i}"] for i in range(k)))
            return self
        moments = self._moments(cells, means)
        rounds, steps = self._run(moments, order, k)
        threshold = self.params["tol"] * max(first[f"t{i}"] for i in range(k))
        keep = self._rounds_needed(cells, means, moments, rounds, threshold)
        self.state["chain"] = steps[: keep * k]
        return self

    def _moments(self, cells, means):
        """{pattern: moment matrix of (1, observed cells less their means)}, zero at missing cells."""
        k = len(means)
        pattern = sum((F.col(f"x{i}").isNull().cast("int") * F.lit(1 << i) for i in range(k)), F.lit(0))
        z = [F.lit(1.0)] + [F.coalesce(F.col(f"x{i}") - F.lit(means[i]), F.lit(0.0)) for i in range(k)]
        sums = [F.sum(z[a] * z[b]).alias(f"s{a}_{b}") for a in range(k + 1) for b in range(a, k + 1)]
        moments = {}
        for row in cells.groupBy(pattern.alias("p")).agg(*sums).collect():  # one row per pattern
            matrix = np.zeros((k + 1, k + 1))
            for a in range(k + 1):
                for b in range(a, k + 1):
                    matrix[a, b] = matrix[b, a] = row[f"s{a}_{b}"]
            moments[row["p"]] = matrix
        return moments

    def _start(self, patterns, k):
        """Affine maps from observed to completed cells; a missing cell starts at its mean, zero here."""
        maps = {}
        for p in patterns:
            maps[p] = np.diag([1.0] + [0.0 if p >> i & 1 else 1.0 for i in range(k)])
        return maps

    def _passes(self, cells, means, order, threshold):
        """The chain's steps, one pass over the rows for each, and one for each round that stores them."""
        share_package(cells.sparkSession)
        k = len(means)
        gram._check(k + 1, 1)
        missing = [F.col(f"x{i}").isNull().alias(f"m{i}") for i in range(k)]
        rows = written(cells.select(*[F.coalesce(F.col(f"x{i}") - F.lit(m), F.lit(0.0)).alias(f"z{i}") for i, m in enumerate(means)], *missing), "cells")
        neighbours = self._neighbours({0: self._pass(rows, [], None, k)}, k)
        chain = []
        for _ in range(self.params["max_iter"]):
            steps = []
            for j in order:
                # a column without gaps changes no cell, but its step is part of the chain
                total = self._pass(rows, steps, j, k)
                steps.append({"column": j, "line": regression_line(total, j, neighbours[j], k).tolist()})
            chain += steps
            rows = written(self._advanced(rows, steps, k), "round")
            if (rows.agg(F.max("moved")).first()[0] or 0.0) < threshold:
                break
            rows = rows.drop("moved")
        return chain

    @staticmethod
    def _pass(rows, steps, j, k):
        """Moments of (1, completed cells) over the rows in which column ``j`` is observed, or over all."""

        def partial(batches):
            total = np.zeros((k + 1, k + 1))
            for batch in batches:
                cells = gram.matrix_of(batch)
                z, missing = cells[:, :k].copy(), cells[:, k:] > 0
                z = advance(z, missing, steps)
                z = z if j is None else z[~missing[:, j]]
                one = np.column_stack([np.ones(len(z)), z])
                total += one.T @ one
            yield from gram._rows({(0, 0): total}, pa.int32())

        return gram._added(rows, partial, T.IntegerType())[0, 0]

    @staticmethod
    def _advanced(rows, steps, k):
        """The rows after a round, with how far each has moved."""

        def run(batches):
            for batch in batches:
                cells = gram.matrix_of(batch)
                z, missing = cells[:, :k].copy(), cells[:, k:] > 0
                before = z.copy()
                z = advance(z, missing, steps)
                columns = [pa.array(z[:, i]) for i in range(k)] + [batch.column(k + i) for i in range(k)] + [pa.array(np.abs(z - before).sum(axis=1))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "moved"])

        return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("moved", T.DoubleType())]))

    def _transform_wide(self, df, columns, means, chain):
        """Rows completed by the whole chain, batch by batch; the imputed columns become doubles."""
        share_package(df.sparkSession)
        names = df.columns
        at = [names.index(c) for c in columns]

        def run(batches):
            for batch in batches:
                x = np.column_stack([batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in at])
                missing = np.isnan(x)
                z = advance(np.where(missing, 0.0, x - means), missing, chain)
                arrays = list(batch.columns)
                for i, own in zip(at, np.where(missing, z + means, x).T):
                    arrays[i] = pa.array(own)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        kinds = [T.StructField(f.name, T.DoubleType()) if f.name in columns else f for f in df.schema.fields]
        return df.mapInArrow(run, T.StructType(kinds))

    def _neighbours(self, moments, k):
        wanted = self.params["n_nearest_features"]
        others = {j: [i for i in range(k) if i != j] for j in range(k)}
        if wanted is None or wanted >= k - 1:
            return others
        total = sum(moments.values())
        spread = np.sqrt(np.maximum(np.diag(total)[1:], np.finfo(float).tiny))
        strength = np.abs(total[1:, 1:]) / np.outer(spread, spread)
        return {j: sorted(sorted(others[j], key=lambda i: -strength[j, i])[:wanted]) for j in range(k)}

    def _run(self, moments, order, k):
        maps = self._start(moments, k)
        neighbours = self._neighbours(moments, k)
        rounds, steps = [maps], []
        for _ in range(self.params["max_iter"]):
            maps = {p: m.copy() for p, m in maps.items()}
            for j in order:
                total = sum(maps[p] @ moments[p] @ maps[p].T for p in moments if not p >> j & 1)
                line = regression_line(total, j, neighbours[j], k)
                steps.append({"column": j, "line": line.tolist()})
                for p in maps:
                    if p >> j & 1:
                        maps[p][j + 1] = line @ maps[p]
            rounds.append(maps)
        return rounds, steps

    def _rounds_needed(self, cells, means, moments, rounds, threshold):
        """Rounds until no row moves by the threshold, measured by the sum of its cells' changes."""
        k = len(means)
        patterns = sorted(moments)
        last = len(rounds) - 1
        pattern = sum((F.col(f"x{i}").isNull().cast("int") * F.lit(1 << i) for i in range(k)), F.lit(0))
        where = F.array_position(F.lit(patterns), pattern).cast("int") - 1
        z = [F.lit(1.0)] + [F.coalesce(F.col(f"x{i}") - F.lit(means[i]), F.lit(0.0)) for i in range(k)]
        incomplete = cells.filter(pattern > 0).select((where * F.lit(last)).alias("w"), *[c.alias(f"z{i}") for i, c in enumerate(z)])
        # One row per round rather than one expression per round: the compiled code stays small.
        turns = incomplete.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(last))))
        change = F.lit(0.0)
        for j in range(1, k + 1):
            shift = F.lit(0.0)
            for i in range(k + 1):
                table = [float(rounds[r][p][j, i] - rounds[r - 1][p][j, i]) for p in patterns for r in range(1, last + 1)]
                if any(table):
                    shift = shift + F.get(F.lit(table), F.col("w") + F.col("round") - 1) * F.col(f"z{i}")
            change = change + F.abs(shift)
        moved = {row["round"]: row["change"] for row in turns.groupBy("round").agg(F.max(change).alias("change")).collect()}
        for r in range(1, last + 1):
            if moved.get(r, 0.0) < threshold:
                return r
        return last

    def transform(self, df):
        self._require_fit()
        columns, means, chain = self.params["columns"], self.state["means"], self.state["chain"]
        k = len(columns)
        if k <= FLAT_LIMIT:
            return self._transform_flat(df, columns, means, chain, k)
        return self._transform_wide(df, columns, np.array(means), chain)

    def _transform_flat(self, df, columns, means, chain, k):
        """The whole chain as one affine expression per missing pattern."""
        maps = self._start(range(1 << k), k)
        for step in chain:
            j, line = step["column"], np.array(step["line"])
            for p in maps:
                if p >> j & 1:
                    maps[p][j + 1] = line @ maps[p]
        pattern = sum((_clean(c).isNull().cast("int") * F.lit(1 << i) for i, c in enumerate(columns)), F.lit(0))
        z = [F.lit(1.0)] + [F.coalesce(_clean(c) - F.lit(m), F.lit(0.0)) for c, m in zip(columns, means)]
        filled = {}
        for j, c in enumerate(columns):
            estimate = F.lit(means[j])
            for i in range(k + 1):
                table = [float(maps[p][j + 1, i]) for p in range(1 << k)]
                if any(v for p, v in enumerate(table) if p >> j & 1):
                    estimate = estimate + F.get(F.lit(table), pattern) * z[i]
            filled[c] = F.coalesce(_clean(c), estimate)
        return df.withColumns(filled)
