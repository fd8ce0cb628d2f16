"""Decomposed text, percent formats, dropped rows."""

import datetime
import unicodedata

import pytest
from pyspark.sql import functions as F

from parcelry.functions import listing as L, text as T
from parcelry.operators import clean


def test_composed_equals_the_normal_form(spark):
    texts = ["Nhà 3 tầng mặt tiền", "ẦẬẤẶ ộ ữ ỹ", "plain", "", None, "x́́ ệ́!", "ậb\n漢é", "́start", "ấ"]
    rows = [(k, t if t is None else unicodedata.normalize(form, t)) for k, t in enumerate(texts) for form in ("NFD", "NFC")]
    got = spark.createDataFrame(rows, "k int, t string").select("k", "t", T.composed("t").alias("c")).collect()
    for r in got:
        if r.k not in (5,):
            assert r.c == (None if r.t is None else unicodedata.normalize("NFC", r.t)), repr(r.t)


def test_phrases_of_decomposed_text(spark):
    apart = lambda t: unicodedata.normalize("NFD", t)
    row = spark.createDataFrame([(apart("2 tuần trước"), apart("Bán nhà 4 LẦU mặt  phố"), apart("3 tỷ 200 triệu"), [apart("3 Phòng  ngủ")])], "age string, title string, price string, facts array<string>")
    got = row.select(L.age_hours("age"), L.title_floors("title"), L.has_frontage("title"), L.price_million("price"), L.first_number("facts", L.BEDROOMS), T.normalise_title("title")).first()
    assert tuple(got) == (336, 5, True, 3200.0, 3, "bán nhà lầu mặt phố")


def test_percent_formats(spark):
    assert clean.date_pattern("yyyy-MM-dd") == "yyyy-MM-dd" and clean.date_pattern("%Y%m%d") == "yyyyMMdd" and clean.date_pattern("%d.%m.%Y at %H%%") == "d.M.yyyy 'a''t' H%"
    with pytest.raises(ValueError):
        clean.date_pattern("%Q")
    df = spark.createDataFrame([("2024-01-05",), ("2024-1-5",), ("x",), (None,)], "d string")
    got = [r.d for r in clean.DataCleaner(df).format_dates("d").get_cleaned_data().collect()]
    assert got == [datetime.datetime(2024, 1, 5), datetime.datetime(2024, 1, 5), None, None]


def test_dropped_rows_are_counted(spark):
    cleaner = clean.DataCleaner(spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "a"), (2, "b")], "a int, b string"))
    assert cleaner.dropped_rows() == 0
    assert cleaner.drop_duplicates().dropped_rows() == 2 and cleaner.get_cleaned_data().count() == 3
    assert cleaner.drop_duplicates().dropped_rows() == 0
