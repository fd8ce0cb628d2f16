import pytest
from pyspark.sql import functions as F

from parcelry.operators import clean
from parcelry.operators.clean import DataCleaner
from parcelry.sources import files


@pytest.fixture
def fruit(spark):
    rows = [("2025-10-01", 100.0, "  apple "), ("2025-10-02", None, "banana "), ("invalid", 200.0, "apple, orange")]
    return spark.createDataFrame(rows, "date string, price double, desc string")


def test_chained_cleaning(fruit):
    out = DataCleaner(fruit).strip_spaces().handle_nan("mean").format_dates("date").split_composite_columns("desc", ["f1", "f2"], sep=",").drop_duplicates()
    rows = {r["price"]: r for r in out.get_cleaned_data().collect()}
    assert sorted(rows) == [100.0, 150.0, 200.0]
    assert rows[200.0]["date"] is None and rows[100.0]["date"].year == 2025
    assert (rows[100.0]["f1"], rows[100.0]["f2"]) == ("apple", None)
    assert (rows[200.0]["f1"], rows[200.0]["f2"]) == ("apple", " orange")


@pytest.mark.parametrize("method, value", [("zero", 0.0), ("mean", 150.0), ("median", 150.0), ("mode", 100.0)])
def test_fill(fruit, method, value):
    filled = clean.fill_missing(fruit, method, ["price"]).filter("desc = 'banana '").first()
    assert filled["price"] == value


def test_fill_errors(spark, fruit):
    with pytest.raises(ValueError):
        clean.fill_missing(fruit, "max")
    gaps = spark.createDataFrame([("a",), (None,)], "t string")
    with pytest.raises(TypeError):
        clean.fill_missing(gaps, "mean")
    assert clean.fill_missing(gaps, "mode").filter("t IS NULL").count() == 0


def test_missing_columns_are_refused(fruit):
    with pytest.raises(KeyError):
        clean.parse_dates(fruit, "day")
    with pytest.raises(KeyError):
        clean.split_column(fruit, "text", ["a"])


def test_split_refuses_extra_parts(spark):
    df = spark.createDataFrame([("a.b.c",)], "s string")
    assert clean.split_column(df, "s", ["x", "y", "z"], ".").first()[1:] == ("a", "b", "c")
    with pytest.raises(Exception, match="more than 2 parts"):
        clean.split_column(df, "s", ["x", "y"], ".").collect()


def test_strip_takes_no_break_spaces(spark):
    df = spark.createDataFrame([("  a b \t", 1)], "s string, n int")
    assert clean.strip_strings(df).first()["s"] == "a b"


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "a"), (2, "a")], "a int, b string")
    assert clean.duplicate_rows(df).first()[0] == 3
    assert clean.drop_duplicate_rows(df).count() == 2


def test_negatives_become_missing_but_not_ids(spark):
    df = spark.createDataFrame([(-1, -2.0, -3)], "id int, price double, day int")
    assert tuple(clean.mask_negatives(df).first()) == (-1, None, -3)


def test_export(spark, fruit, tmp_path):
    path = DataCleaner(fruit, str(tmp_path)).export("clean")
    assert spark.read.option("header", True).csv(path).count() == 3
    with pytest.raises(ValueError):
        DataCleaner(fruit, str(tmp_path)).export("clean", "docx")


def test_jsonl_skips_broken_lines(spark, tmp_path):
    lines = ['{"id": "1", "title": "nhà"}', '{"id": "2"', "", '{"id": ""}', '{"id": "1"}']
    (tmp_path / "log.jsonl").write_text("\n".join(lines), encoding="utf-8")
    rows = files.read_jsonl(spark, str(tmp_path / "log.jsonl"))
    assert rows.count() == 3
    assert [r[0] for r in files.seen_ids(rows).collect()] == ["1"]


def test_label_map_round_trip(spark, tmp_path):
    labels = spark.createDataFrame([(1, "Quận 12 | Hồ Chí Minh")], "k int, v string")
    path = files.write_label_map(labels, str(tmp_path / "map"))
    assert tuple(files.read_label_map(spark, path).first()) == ("1", "Quận 12 | Hồ Chí Minh")


def test_csv_takes_nan_as_missing(spark, tmp_path):
    (tmp_path / "l.csv").write_text("id,detail_url,title,location,timeline_hours,area_m2,bedrooms,bathrooms,floors,frontage,price_million_vnd\n007,,,,,60,,,,true,NaN\n")
    row = files.load_rental_properties(spark, str(tmp_path / "l.csv")).first()
    assert (row["id"], row["area_m2"], row["frontage"], row["price_million_vnd"], row["title"]) == ("007", 60, True, None, None)


def test_zscore_statistics_ignore_nan(spark):
    from parcelry.operators.prep import ZScoreMethod

    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),)], "v double")
    assert sorted(r[0] for r in ZScoreMethod("v").fit_transform(df).collect()) == [1.0, 2.0, 3.0]
