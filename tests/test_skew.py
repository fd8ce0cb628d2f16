"""Join of hot ids against the plain join."""

import random

import pytest
from pyspark.sql import functions as F

from parcelry.operators import skew


def sides(spark, left, right):
    a = spark.createDataFrame(left, "id int, v string, w double").repartition(5)
    b = spark.createDataFrame(right, "id int, v string").repartition(3)
    return a, b


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def random_rows(seed, size, hot):
    rnd = random.Random(seed)
    ids = [rnd.choice(hot) if rnd.random() < 0.5 else rnd.randrange(1000) for _ in range(size)]
    return [(None if rnd.random() < 0.05 else i, rnd.choice(["a", None, "", "b" * 50])) for i in ids]


@pytest.mark.parametrize("left_hot, right_hot", [([7], [7]), ([7, 8], [8, 9]), ([3], [2000]), ([5000], [1])])
def test_equals_plain_join(spark, monkeypatch, left_hot, right_hot):
    monkeypatch.setattr(skew, "CHUNK", 3)
    left = [(i, v, k % 4 / 2) for k, (i, v) in enumerate(random_rows(1, 600, left_hot))]
    a, b = sides(spark, left, random_rows(2, 200, right_hot))
    found = skew.split_join(a, b, "id", share=50, floor=5)
    plain = a.join(b, "id", "inner")
    assert found.columns == plain.columns == ["id", "v", "w", "v"]
    assert rows_of(found) == rows_of(plain)


def test_repeated_rows_without_end_are_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(skew, "CHUNK", 10)
    a, b = sides(spark, [(1, "same", 0.5)] * 3000 + [(2, "x", 1.0)], [(1, "r")] * 7 + [(2, "y")])
    found = skew.split_join(a, b, "id", share=100, floor=50)
    assert rows_of(found) == rows_of(a.join(b, "id"))
    grid = spark.createDataFrame([(1, 60, 1)], "id int, a int, b int")
    dealt = skew._dealt(a, ["id"], grid, "a", "b", "lhs").groupBy("i").agg(F.sum("lhs_n").alias("n")).collect()
    assert sum(r["n"] for r in dealt) == 3000 and max(r["n"] for r in dealt) < 300


def test_heavy_ids_are_exactly_those_over_the_limit(spark):
    rows = [(1, i) for i in range(101)] + [(2, i) for i in range(100)] + [(None, i) for i in range(500)] + [(i, 0) for i in range(10, 60)]
    df = spark.createDataFrame(rows, "id int, v int")
    found, limit = skew.heavy_ids(df, ["id"], share=2, floor=100)
    assert limit == 125 and found == []
    found, limit = skew.heavy_ids(df, ["id"], share=10, floor=100)
    assert limit == 100 and [tuple(r) for r in found] == [(1, 101)]


def test_grid_is_bounded():
    assert skew.grid_of(5, 10, 1, 10) == (1, 1)
    assert skew.grid_of(100, 10, 1, 10) == (10, 1)
    a, b = skew.grid_of(10**9, 10**6, 10**9, 10**6, cells=4096)
    assert a == b == 64


def test_empty_sides_maps_and_several_keys(spark):
    a, b = sides(spark, [(1, "x", 1.0)] * 40, [(1, "y")])
    for left, right in [(a.limit(0), b), (a, b.limit(0))]:
        assert skew.split_join(left, right, "id", share=2, floor=2).count() == 0
    assert skew.split_join(a, b.select("id"), ["id"], share=2, floor=2).count() == 40
    assert skew.split_join(a.select("id"), b.select("id"), "id", share=2, floor=2).columns == ["id"]
    both = skew.split_join(a, a.select("id", "v"), ["id", "v"], share=2, floor=2)
    assert both.columns == ["id", "v", "w"] and both.count() == 1600
    mapped = b.withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    assert skew.split_join(a, mapped, "id", share=2, floor=2).count() == 40
