"""Column scaling. All statistics of a step come from one aggregation."""

from pyspark.sql import functions as F

from parcelry.operators.prep.base import PreprocessingStrategy, as_list
from parcelry.operators.quantiles import column_quantiles


class _Scaling(PreprocessingStrategy):
    """(x - center) / scale per column, a zero scale counting as one."""

    def __init__(self, columns):
        super().__init__(columns=as_list(columns))

    def fit(self, df, y=None):
        self._check(df)
        found = self._statistics(df, self.params["columns"])
        self.state = {c: {"center": center, "scale": scale or 1.0} for c, (center, scale) in found.items()}
        return self

    def transform(self, df):
        self._require_fit()
        return df.withColumns({c: (F.col(c) - F.lit(s["center"])) / F.lit(s["scale"]) for c, s in self.state.items()})

    def inverse_transform(self, df, columns=None):
        self._require_fit()
        wanted = as_list(columns) if columns else list(self.state)
        return df.withColumns({c: F.col(c) * F.lit(self.state[c]["scale"]) + F.lit(self.state[c]["center"]) for c in wanted})


def _aggregates(df, columns, first, second):
    values = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    row = df.agg(
        *[first(values[c]).alias(f"a{i}") for i, c in enumerate(columns)],
        *[second(values[c]).alias(f"b{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(columns)}


class StandardScaling(_Scaling):
    """Mean and population deviation."""

    def _statistics(self, df, columns):
        return _aggregates(df, columns, F.avg, F.stddev_pop)


class MinMaxScaling(_Scaling):
    """Minimum and range; new data may fall outside [0, 1]."""

    def _statistics(self, df, columns):
        ends = _aggregates(df, columns, F.min, F.max)
        return {c: (lo, hi - lo) for c, (lo, hi) in ends.items()}


class RobustScaling(_Scaling):
    """Median and interquartile range, exact."""

    def _statistics(self, df, columns):
        found = column_quantiles(df, columns, [0.25, 0.5, 0.75])
        return {c: (q2, q3 - q1) for c, (q1, q2, q3) in found.items()}


class Normalizing(PreprocessingStrategy):
    """Divide the columns of each row by the row's Euclidean length; a zero row stays."""

    def __init__(self, columns):
        super().__init__(columns=as_list(columns))

    def transform(self, df):
        self._check(df)
        columns = self.params["columns"]
        square = sum((F.col(c).cast("double") * F.col(c).cast("double") for c in columns), F.lit(0.0))
        length = F.sqrt(square)
        return df.withColumns({c: F.when(length > 0, F.col(c) / length).otherwise(F.col(c).cast("double")) for c in columns})
