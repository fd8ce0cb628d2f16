from pyspark.sql import functions as F

from catalogue.registry import HOMES, homes, register, table
from parcelry.operators.joins import translate
from parcelry.operators.prep import IQRMethod, PreprocessingPipeline, StandardScaling
from parcelry.operators.prep.base import load_fitted, save_fitted
from parcelry.schema import LISTING
from parcelry.session import fresh_path
from parcelry.sources import files

LISTING_COLUMNS = ", ".join(f.name for f in LISTING.fields)


def listing_rows(spark, folder):
    return homes(spark, folder).select(*[f.name for f in LISTING.fields])


@register("s1_csv_scan", f"{HOMES} SELECT {LISTING_COLUMNS} FROM homes")
def s1(spark, folder):
    rows = listing_rows(spark, folder)
    # whole numbers with gaps as a table of floats writes them, flags as Python does
    rows = rows.withColumns({c: F.col(c).cast("double") for c in ("area_m2", "bedrooms", "bathrooms", "floors")} | {"frontage": F.initcap(F.col("frontage").cast("string"))})
    path = files.write_table(rows, fresh_path(spark, "listings"), "csv")
    return files.load_buying_properties(spark, path)


@register("s2_jsonl_scan", f"{HOMES} SELECT {LISTING_COLUMNS} FROM homes WHERE key % 9 <> 0")
def s2(spark, folder):
    """A log in which every ninth order left a broken line."""
    rows = homes(spark, folder)
    names = [f.name for f in LISTING.fields]
    kind = F.col("key") % 4
    as_float = [F.col(c).cast("double").alias(c) if c in ("area_m2", "floors") else F.col(c) for c in names]
    as_text = [F.col(c).cast("string").alias(c) if c != "id" else F.col(c) for c in names]
    as_number = [F.col(c).cast("int").alias(c) if c == "frontage" else F.col(c) for c in names]
    record = F.when(kind == 0, F.to_json(F.struct(*as_float))).when(kind == 1, F.to_json(F.struct(*as_text))).when(kind == 2, F.to_json(F.struct(*as_number))).otherwise(F.to_json(F.struct(*names)))
    line = F.when(F.col("key") % 9 == 0, F.concat(F.lit("{"), F.col("title"))).otherwise(record)
    path = fresh_path(spark, "log")
    rows.select(line.alias("value")).write.text(path)
    return files.read_jsonl(spark, path)


@register("s2_seen_ids", f"{HOMES} SELECT DISTINCT id FROM homes")
def s2_ids(spark, folder):
    return files.seen_ids(homes(spark, folder, located=False))


@register("s3_jsonl_append", f"{HOMES} SELECT {LISTING_COLUMNS} FROM homes")
def s3(spark, folder):
    rows, path = homes(spark, folder), fresh_path(spark, "appended")
    for part in (0, 1):
        files.append_jsonl(rows.filter(F.col("key") % 2 == part).drop("key"), path)
    return files.read_jsonl(spark, path)


@register("s4_csv_sink", f"{HOMES} SELECT count(*) AS listings, count(title) AS titles, round(sum(price_million_vnd), 2) AS price FROM homes")
def s4(spark, folder):
    path = files.write_table(listing_rows(spark, folder), fresh_path(spark, "interim"), "csv")
    return files.read_listings_csv(spark, path).agg(
        F.count(F.lit(1)).alias("listings"), F.count("title").alias("titles"), F.round(F.sum("price_million_vnd"), 2).alias("price")
    )


@register("s5_parquet_sink", f"{HOMES} SELECT {LISTING_COLUMNS} FROM homes")
def s5(spark, folder):
    paths = files.save_dataset(listing_rows(spark, folder), "listings", fresh_path(spark, "processed"), ["parquet", "json"])
    return spark.read.parquet(paths[0])


@register(
    "s6_label_map",
    """SELECT p_partkey, p_brand, CASE WHEN p_brand IS NULL THEN 'Other' ELSE 'Label of ' || p_brand END AS brand_label FROM part""",
)
def s6(spark, folder):
    part = table(spark, folder, "part")
    # every name twice, the second time in capitals and with a label that sorts behind
    labels = part.select(F.lower("p_brand").alias("key"), F.concat(F.lit("Label of "), "p_brand").alias("label"))
    labels = labels.union(part.select(F.upper("p_brand"), F.concat(F.lit("Later label of "), "p_brand"))).distinct()
    path = files.write_label_map(labels, fresh_path(spark, "brands"))
    saved = files.read_label_map(spark, path).toDF("old", "new")
    return translate(part.select("p_partkey", "p_brand"), "p_brand", saved, "brand_label")


@register(
    "s7_saved_steps",
    f"""{HOMES}, q AS (SELECT quantile_cont(CAST(area_m2 AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(area_m2 AS DOUBLE), 0.75) AS q3 FROM homes),
kept AS (SELECT id, CAST(area_m2 AS DOUBLE) AS a FROM homes, q WHERE area_m2 BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
SELECT id, round((a - (SELECT avg(a) FROM kept)) / (SELECT stddev_pop(a) FROM kept), 6) AS area_m2 FROM kept""",
)
def s7(spark, folder):
    rows = homes(spark, folder, located=False).select("id", "area_m2")
    steps = PreprocessingPipeline([IQRMethod(["area_m2"]), StandardScaling(["area_m2"])]).fit(rows)
    loaded = load_fitted(spark, save_fitted(spark, steps, fresh_path(spark, "steps")))
    return loaded.transform(rows).select("id", F.round("area_m2", 6).alias("area_m2"))
