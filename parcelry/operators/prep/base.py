"""The fit/transform contract, chaining of steps, and saving of fitted steps.

``fit`` learns plain numbers (``state``) or dictionary tables (``tables``);
``transform`` is a column expression or a lookup, so it also runs on a
streaming DataFrame.
"""

import json

from parcelry.schema import require_columns


def as_list(columns):
    return [columns] if isinstance(columns, str) else list(columns)


class PreprocessingStrategy:
    def __init__(self, **params):
        self.params = params
        self.state = {}
        self.tables = {}

    def fit(self, df, y=None):
        """Learn from ``df``; steps without statistics learn nothing."""
        return self

    def transform(self, df):
        raise NotImplementedError

    def fit_transform(self, df, y=None):
        return self.fit(df, y).transform(df)

    def _require_fit(self):
        if not self.state and not self.tables:
            raise RuntimeError(f"{type(self).__name__} has not been fitted")

    def _check(self, df):
        require_columns(df, as_list(self.params.get("columns", self.params.get("column", []))))


class PreprocessingPipeline(PreprocessingStrategy):
    """Steps in order; each is fitted on the output of the ones before it."""

    def __init__(self, steps):
        super().__init__()
        self.steps = list(steps)

    def fit(self, df, y=None):
        for i, step in enumerate(self.steps):
            step.fit(df, y)
            if i + 1 < len(self.steps):
                df = step.transform(df)
        return self

    def transform(self, df):
        for step in self.steps:
            df = step.transform(df)
        return df


def save_fitted(spark, step, path):
    """Parameters and learnt numbers as JSON, dictionary tables as parquet beside it."""
    steps = step.steps if isinstance(step, PreprocessingPipeline) else [step]
    described = []
    for i, s in enumerate(steps):
        described.append({"kind": type(s).__name__, "params": s.params, "state": s.state, "tables": sorted(s.tables)})
        for name, table in s.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/step-{i}/{name}")
    text = json.dumps({"chain": isinstance(step, PreprocessingPipeline), "steps": described}, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/steps")
    return path


def load_fitted(spark, path):
    from parcelry.operators import prep

    saved = json.loads(spark.read.text(f"{path}/steps").first()[0])
    steps = []
    for i, item in enumerate(saved["steps"]):
        step = getattr(prep, item["kind"])(**item["params"])
        step.state = item["state"]
        step.tables = {name: spark.read.parquet(f"{path}/step-{i}/{name}") for name in item["tables"]}
        steps.append(step)
    return PreprocessingPipeline(steps) if saved["chain"] else steps[0]
