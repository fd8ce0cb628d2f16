import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelry.operators.explore import box_stats
from parcelry.operators import skew
from parcelry.operators.lookup import lookup, salted_join
from parcelry.operators.quantiles import column_quantiles, group_quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 0.995, 1.0]


@pytest.mark.parametrize("accuracy, direct_rows", [(20, 0), (200, 0), (10_000, 0), (200, 1000), (200, 100_000)])
def test_matches_pandas_on_skewed_groups(spark, accuracy, direct_rows):
    rng = np.random.default_rng(3)
    n = 20_000
    # One key holds more than a third of all rows; values have heavy ties and long tails.
    key = np.where(rng.random(n) < 0.4, "hot", rng.integers(0, 40, n).astype(str))
    value = np.where(rng.random(n) < 0.3, 7.0, rng.lognormal(1, 2, n))
    pdf = pd.DataFrame({"k": key, "v": value})
    pdf.loc[rng.random(n) < 0.05, "v"] = np.nan
    expected = pdf.groupby("k")["v"].quantile(PROBS).unstack()
    df = spark.createDataFrame(pdf).repartition(7)
    rows = group_quantiles(df, "k", "v", PROBS, accuracy, direct_rows).collect()
    assert len(rows) == len(expected)
    for row in rows:
        assert np.allclose(row["q"], expected.loc[row["k"]].to_numpy(), rtol=1e-12)


def test_tiny_groups_and_no_keys(spark):
    for values in ([5.0], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0, 5.0], [10.0, 12.0, 14.0, 1000.0]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        for p in (0.1, 0.3, 0.5, 0.77):
            got = group_quantiles(df, [], "v", [p]).first()
            assert got["n"] == len(values)
            assert got["q"][0] == pytest.approx(np.quantile(values, p))


def test_column_quantiles_ignores_missing(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None), (4, None)], "a int, b double")
    got = column_quantiles(df, ["a", "b"], [0.25])
    assert got["a"] == [1.75]
    assert np.isnan(got["b"][0])


def test_salted_join_equals_plain_join(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    table = spark.range(0, 50, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = sorted(map(str, df.join(table, "k", how).collect()))
        assert sorted(map(str, salted_join(df, table, "k", how).collect())) == plain
        assert sorted(map(str, lookup(df, table, "k", how).collect())) == plain
        assert sorted(map(str, lookup(df, table, "k", how, max_rows=3).collect())) == plain


def test_salted_join_copies_only_what_is_hot(spark, monkeypatch):
    rows = [(None if k % 7 == 0 else 0 if k % 3 == 0 else k % 50, k % 2, k) for k in range(1000)]
    df = spark.createDataFrame(rows, "k int, j int, id int").repartition(3)
    table = spark.createDataFrame([(k, j, (k or 0) * 10 + j) for k in [*range(0, 50, 2), None] for j in (0, 1, 1)], "k int, j int, w int")
    copied = lambda found: "Generate" in found._jdf.queryExecution().optimizedPlan().toString()
    for on in (["k"], ["k", "j"]):
        for how in ("left", "inner", "left_semi", "left_anti"):
            plain = df.join(table, on, how)
            for floor in (10_000, 20):
                monkeypatch.setattr(skew, "FLOOR", floor)
                monkeypatch.setattr(skew, "SHARE", 2048)
                found = salted_join(df, table, on, how)
                assert found.columns == plain.columns and copied(found) == (floor == 20)
                assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("chunks", [1, 7, 256])
def test_steps_of_a_bracket_without_ties(spark, monkeypatch, chunks):
    from parcelry.operators import quantiles

    monkeypatch.setattr(quantiles, "CHUNKS", chunks)
    n = 60_000
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("v"))
    assert group_quantiles(df, [], "v", [0.25, 0.26, 0.5], accuracy=20).first()["q"] == pytest.approx([(n - 1) / 4, (n - 1) * 0.26, (n - 1) / 2])


def test_infinities_and_ties(spark):
    values = [float("-inf")] * 5 + [1.0] * 50 + [2.0, 3.0] + [float("inf")] * 5
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = group_quantiles(df, [], "v", [0.0, 0.5, 1.0], accuracy=10).first()
    assert got["q"][1] == 1.0


def counted(spark, df):
    """The table, and an accumulator of the rows that were read of it."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), seen


def test_columns_are_read_twice(spark):
    df, seen = counted(spark, spark.range(0, 5000, 1, 3).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b")))
    found = column_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75], accuracy=200)
    assert found == {"a": [1249.75, 2499.5, 3749.25], "b": [1.0, 3.0, 5.0]}
    assert seen.value == 2 * 5000


def test_boxes_read_their_rows_once(spark):
    df, seen = counted(spark, spark.range(0, 6000, 1, 3).select((F.col("id") % 2).alias("k"), F.floor(F.col("id") / 2).cast("double").alias("v")))
    rows = {r["k"]: r for r in box_stats(df, "k", "v").collect()}
    assert [rows[k]["median"] for k in (0, 1)] == [1499.5, 1499.5]
    assert seen.value == 6000
