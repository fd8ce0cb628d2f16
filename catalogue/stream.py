from pyspark.sql import functions as F

from catalogue.registry import register, table
from parcelry.operators.prep import StandardScaling
from parcelry.session import fresh_path
from parcelry.streaming import ingest as S


def event_stream(spark, folder):
    """The events as a stream; their times are plain local times, read as UTC."""
    schema = table(spark, folder, "events").schema
    rows = S.read_stream(spark, folder, schema, pattern="events.parquet")
    return rows.withColumn("ts", F.to_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))


@register("r1_incremental_ingest", "SELECT DISTINCT CAST(event_id % 5000 AS VARCHAR) AS id FROM events WHERE event_id % 11 <> 0")
def r1(spark, folder):
    """Event ids folded onto 5000, some missing: each id is stored once."""
    ident = F.when(F.col("event_id") % 11 != 0, (F.col("event_id") % 5000).cast("string"))
    rows = event_stream(spark, folder).select(ident.alias("id"), "value")
    sink = fresh_path(spark, "ingested")
    S.run_available(S.ingest_new(rows, sink, fresh_path(spark, "progress")))
    return spark.read.parquet(sink).select("id")


@register(
    "r2_window_counts",
    """SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, count(*) AS listings FROM events GROUP BY 1
 HAVING CAST(date_trunc('day', max(ts)) AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
def r2(spark, folder):
    """Events per day, for the days the watermark has closed."""
    sink = fresh_path(spark, "windows")
    counts = S.counts_per_window(event_stream(spark, folder), "ts")
    S.run_available(S.write_append(counts, sink, fresh_path(spark, "progress")))
    start = F.from_utc_timestamp("window_start", F.current_timezone()).cast("timestamp_ntz")
    return spark.read.parquet(sink).select(start.alias("window_start"), "listings")


@register("r3_stream_transform", "SELECT event_id, round((value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events), 6) AS value FROM events")
def r3(spark, folder):
    fitted = StandardScaling(["value"]).fit(table(spark, folder, "events"))
    sink = fresh_path(spark, "scaled")
    S.run_available(S.transform_stream(event_stream(spark, folder).select("event_id", "value"), fitted, sink, fresh_path(spark, "progress")))
    return spark.read.parquet(sink).select("event_id", F.round("value", 6).alias("value"))
