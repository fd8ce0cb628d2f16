"""Records as other programs write them."""

import json

import pandas as pd

from parcelry.sources import files


def test_csv_as_pandas_writes_it(spark, tmp_path):
    frame = pd.DataFrame({"id": ["1", "2", "3"], "area_m2": [60.0, None, 3.0], "frontage": [True, False, True], "price_million_vnd": [5.5, None, 7.0], "floors": ["4", "x", "2.5"]})
    path = f"{tmp_path}/listings.csv"
    frame.reindex(columns=["id", "detail_url", "title", "location", "timeline_hours", "area_m2", "bedrooms", "bathrooms", "floors", "frontage", "price_million_vnd"]).to_csv(path, index=False)
    rows = [r.asDict() for r in files.read_listings_csv(spark, path).orderBy("id").collect()]
    assert [r["area_m2"] for r in rows] == [60, None, 3] and [r["frontage"] for r in rows] == [True, False, True]
    assert [r["floors"] for r in rows] == [4, None, None] and [r["price_million_vnd"] for r in rows] == [5.5, None, 7.0]
    assert {r["column"]: r["cells"] for r in files.unreadable_cells(spark, path).collect() if r["cells"]} == {"floors": 2}


def test_jsonl_keeps_every_record(spark, tmp_path):
    lines = [{"id": "1", "area_m2": 60.0}, {"id": "3", "frontage": 1}, {"id": 4, "floors": "2"}, {"id": "5", "area_m2": "big", "title": "t"}]
    path = tmp_path / "log.jsonl"
    path.write_text("\n".join([json.dumps(x) for x in lines] + ["{broken", "", "  "]))
    rows = {r["id"]: r for r in files.read_jsonl(spark, str(path)).collect()}
    assert sorted(rows) == ["1", "3", "4", "5"]
    assert rows["1"]["area_m2"] == 60 and rows["3"]["frontage"] is True and rows["4"]["floors"] == 2
    assert rows["5"]["area_m2"] is None and rows["5"]["title"] == "t"
    assert tuple(files.rejected_lines(spark, str(path)).first()) == (4, 1)


def test_a_dataset_in_two_formats_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(40).selectExpr("id", "if(id % 3 = 0, null, concat('é \\n', id)) AS title", "id / 8 AS price").mapInArrow(counted, "id long, title string, price double")
    paths = files.save_dataset(rows, "listings", str(tmp_path), ["json", "parquet"])
    assert [p.rsplit(".")[-1] for p in paths] == ["json", "parquet"] and seen.value == 40
    a, b = spark.read.schema(rows.schema).json(paths[0]), spark.read.parquet(paths[1])
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() == 40
