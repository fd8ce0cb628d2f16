"""The stages keep what they should, each on what the one before kept."""

import corpus_pipeline
from pyspark.sql import functions as F

from parcelry.llm import repeats
from parcelry.session import fresh_path

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns and after.count() <= docs.count()
        assert after.join(docs, "doc_id", "left_anti").isEmpty()
        docs = steps[name] = after
    kept = steps["near_duplicates"]
    assert kept.count() == kept.select("doc_id").distinct().count()
    assert steps["repeats"].count() == kept.count()
    assert repeats.find_repeats(kept).where(F.size("spans") > 0).count() == steps["repeats"].join(kept.select("doc_id", F.col("text").alias("before")), "doc_id").where("text != before").count()
    packed = corpus_pipeline.run(spark, SMALL)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").isEmpty()


def test_stages_take_odd_rows(spark, docs, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, str(tmp_path))
            assert out.count() <= 2000


def test_near_duplicates_keep_different_texts_of_one_id_or_none(spark):
    """Ten words a text: each row that is no copy stays, whatever its id."""
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(10))
    rows = [(None, text(0)), (None, text(1)), (None, text(2)), (None, text(2)), (5, text(3)), (5, text(4)), (5, text(4)), (6, text(4)), (4, text(5)), (7, text(5)), (7, text(6)), (None, text(6))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()), key=repr)
    assert got == sorted([(None, text(0)), (None, text(1)), (None, text(2)), (5, text(3)), (5, text(4)), (4, text(5)), (7, text(6))], key=repr)
