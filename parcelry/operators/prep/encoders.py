"""Category encoders. Dictionaries are tables with one row per category."""

from pyspark.sql import Window, functions as F, types as T

from parcelry.operators.lookup import MAX_ROWS, collect_bounded, lookup, settle
from parcelry.operators.prep.base import PreprocessingStrategy, as_list
from parcelry.session import written


def sorted_codes(values, column, name="code", max_rows=MAX_ROWS):
    """Rows of the distinct ``values`` with their rank 0..k-1 in sort order.

    The values are computed once. A small set is sorted as local rows. A big
    one is range-partitioned, sorted and saved with each row's place, so that
    the places within a partition and the partition offsets refer to the same
    partitions.
    """
    values = written(values.select(column), "values")
    rows = collect_bounded(values, max_rows)
    if rows is not None:
        kind = values.schema[column].dataType.simpleString()
        numbered = [(v, i) for i, v in enumerate(sorted(r[0] for r in rows))]
        return values.sparkSession.createDataFrame(numbered, f"`{column}` {kind}, `{name}` bigint")
    # the id holds the partition and, in its lower 33 bits, the row's place in it
    parts = written(values.repartitionByRange(column).sortWithinPartitions(column).select(column, F.monotonically_increasing_id().alias("__id")), "ranges")
    parts = parts.select(column, F.shiftright("__id", 33).alias("__p"), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"))
    sizes = parts.groupBy("__p").agg((F.max("__at") + 1).alias("count"))
    # One row per partition, so this window stays small.
    offsets = written(sizes.select("__p", (F.sum("count").over(Window.orderBy("__p")) - F.col("count")).alias("__o")), "offsets")
    return parts.join(F.broadcast(offsets), "__p").select(column, (F.col("__at") + F.col("__o")).cast("bigint").alias(name))


class LabelEncoding(PreprocessingStrategy):
    """Rank of the category among the sorted categories; an unknown category is an error."""

    def __init__(self, column):
        super().__init__(column=column)

    def fit(self, df, y=None):
        self._check(df)
        c = self.params["column"]
        self.tables = {"codes": sorted_codes(df.select(c).dropna().distinct(), c)}
        return self

    def transform(self, df):
        self._require_fit()
        c = self.params["column"]
        joined = lookup(df, self.tables["codes"].withColumnRenamed("code", "__code"), c)
        unknown = F.raise_error(F.concat(F.lit(f"unknown label in {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))))
        return joined.withColumn(c, F.coalesce(F.col("__code"), unknown.cast("bigint"))).drop("__code").select(*df.columns)


def category_text(df, column):
    """The category as text, a missing one as "nan", a flag capitalised."""
    text = F.col(column).cast("string")
    if isinstance(df.schema[column].dataType, T.BooleanType):
        text = F.initcap(text)
    return F.coalesce(text, F.lit("nan"))


class OneHotEncoding(PreprocessingStrategy):
    """0/1 columns ``column_category`` in sorted order instead of the originals.

    With ``missing="category"`` a missing value is a category of its own, with
    "zero" it has no column. ``output="vector"`` gives one sparse vector per
    column and suits category sets too big for single columns.
    """

    def __init__(self, columns, missing="category", output="columns", max_categories=2000):
        if missing not in ("category", "zero") or output not in ("columns", "vector"):
            raise ValueError("missing is 'category' or 'zero', output is 'columns' or 'vector'")
        super().__init__(columns=as_list(columns), missing=missing, output=output, max_categories=max_categories)

    def _categories(self, df, column):
        rows = df if self.params["missing"] == "category" else df.dropna(subset=[column])
        return rows.select(category_text(df, column).alias("category")).distinct()

    def fit(self, df, y=None):
        self._check(df)
        if self.params["output"] == "vector":
            self.tables = {f"codes_{c}": sorted_codes(self._categories(df, c), "category") for c in self.params["columns"]}
            return self
        self.state = {}
        for c in self.params["columns"]:
            rows = collect_bounded(self._categories(df, c), self.params["max_categories"])
            if rows is None:
                raise ValueError(f"{c} has too many categories for single columns: use output='vector'")
            self.state[c] = sorted(r[0] for r in rows)
        return self

    def feature_names(self):
        return [f"{c}_{category}" for c, categories in self.state.items() for category in categories]

    def transform(self, df):
        self._require_fit()
        if self.params["output"] == "vector":
            return self._vectors(df)
        hits = []
        for c, categories in self.state.items():
            text = category_text(df, c)
            test = text if self.params["missing"] == "category" else F.when(F.col(c).isNotNull(), text)
            hits += [F.coalesce((test == v).cast("int"), F.lit(0)).alias(f"{c}_{v}") for v in categories]
        kept = [F.col(f"`{c}`") for c in df.columns if c not in self.state]
        return df.select(*kept, *hits)

    def _vectors(self, df):
        from pyspark.ml.feature import OneHotEncoder

        for c in self.params["columns"]:
            codes = self.tables[f"codes_{c}"]
            size = codes.count()
            table = codes.select(F.col("category").alias("__category"), F.col("code").alias("__code"))
            text = category_text(df, c)
            if self.params["missing"] == "zero":
                text = F.when(F.col(c).isNotNull(), text)
            joined = lookup(df.withColumn("__category", text), table, "__category")
            indexed = joined.withColumn("__index", F.coalesce(F.col("__code"), F.lit(size)).cast("double"))
            # The index after the last category stands for "none of them" and becomes an all-zero vector.
            encoder = OneHotEncoder(inputCol="__index", outputCol=f"{c}_vector", handleInvalid="keep", dropLast=True)
            model = encoder.fit(codes.select(F.col("code").cast("double").alias("__index")))
            df = model.transform(indexed).drop("__category", "__code", "__index", c)
        return df


class TargetEncoding(PreprocessingStrategy):
    """Category mean of the target, drawn towards the overall mean where rows are few.

    Missing and unseen categories get the overall mean. ``single_is_prior``
    also gives it to categories with one row.
    """

    def __init__(self, columns, target, smoothing=1.0, min_samples_leaf=1, single_is_prior=False):
        super().__init__(
            columns=as_list(columns), target=target, smoothing=smoothing, min_samples_leaf=min_samples_leaf, single_is_prior=single_is_prior
        )

    def fit(self, df, y=None):
        self._check(df)
        p = self.params
        target = F.col(p["target"]).cast("double")
        prior = df.agg(F.avg(target)).first()[0]
        self.state = {"prior": prior}
        self.tables = {}
        n = F.col("__n")
        share = 1 / (1 + F.exp(-(n - p["min_samples_leaf"]) / F.lit(float(p["smoothing"]))))
        if p["single_is_prior"]:
            share = F.when(n == 1, 0.0).otherwise(share)
        for c in p["columns"]:
            stats = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(target).alias("__n"), F.avg(target).alias("__m"))
            encoded = F.lit(prior) * (1 - share) + F.col("__m") * share
            self.tables[c] = settle(stats.select(F.col(c).alias("category"), encoded.alias("encoded")), f"target-{c}")
        return self

    def transform(self, df):
        self._require_fit()
        columns = df.columns
        for c in self.params["columns"]:
            table = self.tables[c].select(F.col("category").alias(c), F.col("encoded").alias("__encoded"))
            joined = lookup(df, table, c)
            df = joined.withColumn(c, F.coalesce(F.col("__encoded"), F.lit(self.state["prior"]))).select(*columns)
        return df


def collapse_rare(df, column, minimum, fallback, name):
    """``column`` where it occurs at least ``minimum`` times, else the ``fallback`` expression.

    Counts are aggregated first and looked up, so no task ever holds all rows
    of a frequent category.
    """
    rare = df.groupBy(column).agg(F.count(F.lit(1)).alias("__count")).filter(F.col("__count") < minimum).select(column, F.lit(True).alias("__rare"))
    joined = lookup(df, rare, column)
    return joined.withColumn(name, F.when(F.col("__rare"), fallback).otherwise(F.col(column))).drop("__rare").select(*df.columns, name)
