"""Exact ranks against a plain sort."""

import math
import random

import pytest
from pyspark.sql import functions as F

from parcelry.operators import ranks
from parcelry.operators.reshape import hash_unit, id_unit


def plain_order(rows):
    return sorted(rows, key=lambda r: (r[1] if r[1] is not None else -1, r[0]))


@pytest.fixture(scope="module", params=["spread", "tied", "one"])
def table(spark, request):
    rnd = random.Random(2)
    number = {"spread": lambda k: rnd.random(), "tied": lambda k: rnd.choice([0.25, 0.5, 0.7, 0.7, 0.7]), "one": lambda k: 0.125}[request.param]
    rows = [(k * 7 % 1009, number(k), k % 13) for k in range(1009)]
    rows[5] = (rows[5][0], None, 1)
    return spark.createDataFrame(rows, "key long, unit double, extra int").repartition(7), [k for k, *_ in plain_order([(k, None if u is None else math.floor(u * 2**40)) for k, u, _ in [(r[0], r[1] if r[1] is not None else 0.0, 0) for r in rows]])]


@pytest.mark.parametrize("few", [4096, 10])
def test_sample_split_and_folds_have_exact_sizes(table, monkeypatch, few):
    monkeypatch.setattr(ranks, "FEW", few)
    df, order = table
    unit = F.col("unit")
    first = {r.key for r in ranks.exact_sample(df, unit, "key", 0.3).collect()}
    assert first == set(order[:303])
    train, test = ranks.exact_split(df, unit, ["key"], 0.2)
    assert {r.key for r in test.collect()} == set(order[:202]) and {r.key for r in train.collect()} == set(order[202:])
    folds = {r.key: r.fold for r in ranks.exact_folds(df, unit, "key", 5).collect()}
    sizes = [202, 202, 202, 202, 201]
    assert [folds[k] for k in order] == [f for f, n in enumerate(sizes) for _ in range(n)]


def test_edges(spark):
    df = spark.createDataFrame([(k, k % 3) for k in range(4)], "key long, x int")
    unit = id_unit("key")
    assert ranks.exact_sample(df, unit, "key", 0.0).count() == 0 and ranks.exact_sample(df, unit, "key", 1.0).count() == 4
    assert sorted(r.fold for r in ranks.exact_folds(df, unit, "key", 5).collect()) == [0, 1, 2, 3]
    nothing = df.limit(0)
    assert ranks.exact_folds(nothing, unit, "key").count() == 0 and [p.count() for p in ranks.exact_split(nothing, unit, "key")] == [0, 0]
    # one row more or a new partitioning moves no more rows than it must
    more = df.union(spark.createDataFrame([(9, 1)], "key long, x int"))
    assert ranks.exact_sample(more, hash_unit("key"), "key", 0.5).count() == 2


def test_text_keys_and_repeated_keys_stay_together(spark):
    df = spark.createDataFrame([(f"k{k % 40}", k) for k in range(200)], "key string, x int").repartition(3)
    folds = ranks.exact_folds(df, hash_unit("key"), "key", 4).groupBy("key").agg(F.count_distinct("fold").alias("n")).collect()
    assert len(folds) == 40 and all(r.n == 1 for r in folds)
