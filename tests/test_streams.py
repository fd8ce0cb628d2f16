import json

from pyspark.sql import functions as F, types as T

from parcelry.operators.prep import PreprocessingPipeline, RobustScaling, TargetEncoding
from parcelry.streaming import ingest as S

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("ts", T.TimestampType())])


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(dict(zip(("id", "v", "ts"), r))) for r in rows))


def stream(spark, folder, **options):
    return S.read_stream(spark, str(folder), SCHEMA, format="json", files_per_trigger=1, **options)


def test_ids_are_stored_once_across_batches_and_runs(spark, tmp_path):
    source, sink, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    drop(source, "a", [("1", 1, None), ("2", 2, None), ("2", 2, None), ("", 0, None), (None, 0, None)])
    S.run_available(S.ingest_new(stream(spark, source), sink, log))
    drop(source, "b", [("2", 9, None), ("3", 3, None)])
    drop(source, "c", [("3", 9, None), ("1", 9, None), ("4", 4, None)])
    S.run_available(S.ingest_new(stream(spark, source), sink, log))
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(sink).collect()) == [("1", 1), ("2", 2), ("3", 3), ("4", 4)]


def test_a_repeated_batch_leaves_one_copy(spark, tmp_path):
    source, sink = tmp_path / "in", str(tmp_path / "out")
    drop(source, "a", [("1", 1, None), ("2", 2, None)])
    for log in ("log1", "log2"):  # a new log starts again at batch 0
        S.run_available(S.ingest_new(stream(spark, source), sink, str(tmp_path / log)))
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == ["1", "2"]


def test_watermarked_ingest(spark, tmp_path):
    source, sink, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    drop(source, "a", [("1", 1, "2024-01-01T00:00:00"), ("1", 1, "2024-01-01T00:05:00"), ("2", 2, "2024-01-01T00:10:00")])
    S.run_available(S.ingest_within(stream(spark, source), "ts", "1 hour", sink, log))
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == ["1", "2"]


def test_late_rows_are_dropped_from_windows(spark, tmp_path):
    source, sink, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    drop(source, "a", [("1", 1, "2024-01-01T10:00:00"), ("2", 1, "2024-01-03T10:00:00")])
    S.run_available(S.write_append(S.counts_per_window(stream(spark, source), "ts"), sink, log))
    drop(source, "b", [("3", 1, "2024-01-01T11:00:00"), ("4", 1, "2024-01-03T11:00:00"), ("5", 1, "2024-01-05T11:00:00")])
    S.run_available(S.write_append(S.counts_per_window(stream(spark, source), "ts"), sink, log))
    rows = spark.read.parquet(sink).orderBy("window_start").collect()
    assert [(r["window_start"].day, r["listings"]) for r in rows] == [(1, 1), (3, 2)]


def test_fitted_steps_on_a_stream_equal_the_batch(spark, tmp_path):
    source, sink, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    for n in range(3):
        drop(source, f"f{n}", [(str(i % 4), i * 10 + n, None) for i in range(8)])
    batch = spark.read.schema(SCHEMA).json(str(source)).select("id", "v", F.col("v").alias("t"))
    steps = PreprocessingPipeline([TargetEncoding("id", "t"), RobustScaling("v")]).fit(batch)
    rows = stream(spark, source).select("id", "v", F.col("v").alias("t"))
    S.run_available(S.transform_stream(rows, steps, sink, log))
    order = ["id", "v", "t"]
    assert spark.read.parquet(sink).orderBy(*order).collect() == steps.transform(batch).orderBy(*order).collect()


def test_late_repeats_over_many_batches_read_only_their_buckets(spark, tmp_path):
    folder, sink = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [range(0, 400), range(300, 700), range(0, 30), [5, 5, 1000, None, 640], [1000, 2000]]
    for k, ids in enumerate(batches):
        rows = [(None if i is None else f"id{i}", k) for i in ids]
        spark.createDataFrame(rows, "id string, n int").coalesce(1).write.mode("append").parquet(folder)
        S.run_available(S.ingest_new(S.read_stream(spark, folder, "id string, n int"), sink, str(tmp_path / "progress"), buckets=64))
    got = sorted(r.id for r in spark.read.parquet(sink).select("id").collect())
    assert got == sorted({f"id{i}" for ids in batches for i in ids if i is not None})
    store = S.SeenIds(spark, sink + ".seen", "id", spark.read.parquet(sink).schema["id"].dataType, 64)
    assert spark.read.parquet(sink + ".seen/ids").count() == len(got)
    asked = spark.createDataFrame([("id640",), ("new",)], "id string").withColumn("bucket", store.bucket(F.col("id")))
    assert [r.id for r in store.known(asked, 99).collect()] == ["id640"]
    # the ids of one bucket are read, and none of a bucket whose filter knows no asked id
    home = asked.where("id = 'id640'").first()["bucket"]
    read = store.read("ids", [home], 99)
    assert read.count() < 40 and all(f"/bucket={home}/" in f for f in read.inputFiles()) or read.select("bucket").distinct().count() == 1
    assert store.suspects(asked.where("id = 'new'"), 99).count() <= 1
    assert store.known(asked, 0) is None or store.known(asked, 0).count() == 0


def test_a_batch_that_runs_again_leaves_one_copy_and_old_sinks_get_a_store(spark, tmp_path):
    folder, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a", 1), ("b", 1)], "id string, n int").write.parquet(f"{sink}/batch=-7")
    spark.createDataFrame([("b", 2), ("c", 2)], "id string, n int").write.parquet(folder)
    for again in ("first", "second"):
        # another progress folder: the same files come as batch 0 once more
        S.run_available(S.ingest_new(S.read_stream(spark, folder, "id string, n int"), sink, str(tmp_path / again)))
        assert sorted((r.id, r.n) for r in spark.read.parquet(sink).collect()) == [("a", 1), ("b", 1), ("c", 2)]
