"""Units of different seeds, resampling counts and lookups."""

import math

from pyspark.sql import functions as F

from parcelry.functions import listing as L
from parcelry.operators import joins, reshape as R


def test_two_seeds_split_independently(spark):
    df = spark.range(40_000).select("id", R.id_unit("id", 7).alias("a"), R.id_unit("id", 42).alias("b"))
    cells = df.groupBy(F.floor(F.col("a") * 5), F.floor(F.col("b") * 5)).count().collect()
    assert len(cells) == 25 and all(abs(r["count"] - 1600) < 200 for r in cells)


def test_every_fold_of_a_split_has_rows(spark):
    train, _ = R.train_test_split(spark.range(10_000), R.id_unit("id", 7))
    folds = {r["fold"]: r["count"] for r in R.with_fold(train, R.id_unit("id")).groupBy("fold").count().collect()}
    assert sorted(folds) == [0, 1, 2, 3, 4] and min(folds.values()) > 1400


def test_poisson_goes_as_far_as_the_unit(spark):
    top = spark.range(1).select(R.poisson_one(F.lit(1 - 2.0**-R.UNIT_BITS)).alias("n"), R.poisson_one(F.lit(0.0)).alias("z")).first()
    assert top["z"] == 0 and top["n"] > 9 and math.factorial(top["n"] + 1) > 2**R.UNIT_BITS / math.e / 2


def test_translate_takes_one_row_per_name_in_any_case(spark):
    names = spark.createDataFrame([("a", "Z"), ("A ", "Y"), ("B", "X")], "old string, new string")
    rows = joins.translate(spark.createDataFrame([("a",), ("b",), ("c",)], "name string"), "name", names, "new")
    assert sorted(tuple(r) for r in rows.collect()) == [("a", "Y"), ("b", "X"), ("c", "Other")]


def test_cards_inside_the_container_only(spark):
    card = lambda h: f'<a class="card-cm" href="{h}"><div><div>x</div></div></a>'
    box = '<div class="gap-24 d-flex flex-column card-container">'
    pages = [("1", f'{card("/no")}{box}<div>{card("/a")}</div>{card("/b")}</div><div class="related">{card("/no")}</div>'), ("2", f'{box}{card("/c")}'), ("3", "<p>none</p>"), ("4", None)]
    rows = spark.createDataFrame(pages, "id string, html string").select("id", F.transform(L.card_blocks("html"), lambda c: F.regexp_extract(c, 'href="([^"]*)"', 1)).alias("links"))
    assert {r["id"]: r["links"] for r in rows.collect()} == {"1": ["/a", "/b"], "2": ["/c"], "3": [], "4": None}
