"""Row filters with learnt limits. A missing value in a checked column drops the row."""

from functools import reduce

from pyspark.sql import functions as F

from parcelry.operators.prep.base import PreprocessingStrategy, as_list
from parcelry.operators.quantiles import clean_double, column_quantiles


class IQRMethod(PreprocessingStrategy):
    """Keep rows within 1.5 interquartile ranges of the quartiles in every column."""

    def __init__(self, columns):
        super().__init__(columns=as_list(columns))

    def fit(self, df, y=None):
        self._check(df)
        self.state = {c: {"q1": q1, "q3": q3} for c, (q1, q3) in column_quantiles(df, self.params["columns"], [0.25, 0.75]).items()}
        return self

    def transform(self, df):
        self._require_fit()
        tests = []
        for c, s in self.state.items():
            reach = 1.5 * (s["q3"] - s["q1"])
            tests.append(F.col(c).between(s["q1"] - reach, s["q3"] + reach))
        return df.filter(reduce(lambda a, b: a & b, tests))


class ZScoreMethod(PreprocessingStrategy):
    """Keep rows less than ``threshold`` sample deviations from the mean in every column."""

    def __init__(self, columns, threshold=2):
        super().__init__(columns=as_list(columns), threshold=threshold)

    def fit(self, df, y=None):
        self._check(df)
        columns = self.params["columns"]
        stats = df.agg(
            *[F.avg(clean_double(c)).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_samp(clean_double(c)).alias(f"s{i}") for i, c in enumerate(columns)],
        ).first()
        self.state = {c: {"mean": stats[f"m{i}"], "std": stats[f"s{i}"]} for i, c in enumerate(columns)}
        return self

    def transform(self, df):
        self._require_fit()
        tests = []
        for c, s in self.state.items():
            # No deviation (or a single row) keeps nothing: 0/0 is not below any threshold.
            z = F.try_divide(F.col(c) - F.lit(s["mean"]), F.lit(s["std"]).cast("double"))
            tests.append(F.abs(z) < self.params["threshold"])
        return df.filter(reduce(lambda a, b: a & b, tests))
