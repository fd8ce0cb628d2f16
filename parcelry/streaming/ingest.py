"""Incremental ingest, windowed counts and streaming feature transforms."""

from pyspark.sql import functions as F, types as T

from parcelry.plans.extraction import listings_from_pages, one_row_each
from parcelry.session import written

#: Parts of the store of seen ids; bits of a part's filter, in words of 64; positions that an id sets there.
BUCKETS, WORDS, POSITIONS = 64, 1 << 18, 3


def read_stream(spark, folder, schema, format="parquet", pattern=None, files_per_trigger=None):
    reader = spark.readStream.schema(schema).format(format)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def run_available(writer):
    """Process everything that has arrived, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _existing(spark, path, schema):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return None
    return spark.read.schema(schema).parquet(path)


class SeenIds:
    """Ids stored in buckets by hash, with a Bloom filter for each bucket.

    A batch reads the filter words of the buckets that it touches, and then only the ids of those buckets in which the
    filter knows one of its ids; the filter never misses a stored id, and the ids themselves decide. Each batch replaces
    its own folders, so a batch that is run again leaves one copy and does not see itself.
    """

    def __init__(self, spark, path, ident, kind, buckets=BUCKETS, words=WORDS):
        self.spark, self.path, self.ident, self.buckets, self.words = spark, path.rstrip("/"), ident, buckets, words
        self.kinds = {"ids": [T.StructField("id", kind)], "filter": [T.StructField("word", T.IntegerType()), T.StructField("bits", T.LongType())]}

    def bucket(self, column):
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int")

    def positions(self, column):
        """The words and bits that an id sets, as an array of (position, word, mask)."""
        marks = [F.xxhash64(F.lit(k + 1), column) for k in range(POSITIONS)]
        return F.array(*[F.struct(F.lit(k).alias("position"), F.pmod(F.shiftright(h, 6), F.lit(self.words)).cast("int").alias("word"), F.pmod(h, F.lit(64)).cast("int").alias("bit")) for k, h in enumerate(marks)])

    def read(self, what, buckets, batch_id):
        """Rows of earlier batches in some buckets; only their folders are read."""
        fields = [*self.kinds[what], T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())]
        stored = _existing(self.spark, f"{self.path}/{what}", T.StructType(fields))
        if stored is None or not buckets:
            return None
        return stored.where(F.col("bucket").isin(buckets) & (F.col("batch") < batch_id))

    def suspects(self, ids, batch_id):
        """Those of ``ids`` (id, bucket) that the filters know, among them all stored ones; None if there is no filter yet."""
        touched = [r["bucket"] for r in ids.select("bucket").distinct().collect()]  # at most as many as there are buckets
        words = self.read("filter", touched, batch_id)
        if words is None:
            return None
        words = words.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        asked = ids.select("id", "bucket", F.explode(self.positions(F.col("id"))).alias("p")).select("id", "bucket", "p.*")
        hit = F.expr("(shiftrightunsigned(bits, bit) & 1L) = 1L")
        return asked.join(words, ["bucket", "word"]).where(hit).groupBy("id", "bucket").agg(F.count("*").alias("n")).where(F.col("n") == POSITIONS).drop("n")

    def known(self, ids, batch_id):
        """The stored ones of ``ids``, or None."""
        suspects = self.suspects(ids, batch_id)
        if suspects is None:
            return None
        suspects = written(suspects, "suspects")
        stored = self.read("ids", [r["bucket"] for r in suspects.select("bucket").distinct().collect()], batch_id)
        return None if stored is None else suspects.join(stored.select("id", "bucket"), ["id", "bucket"], "left_semi").select("id")

    def add(self, ids, batch_id):
        ids.select("id", "bucket").repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/ids/batch={batch_id}")
        bits = ids.select("bucket", F.explode(self.positions(F.col("id"))).alias("p")).select("bucket", "p.word", F.expr("shiftleft(1L, p.bit)").alias("bits"))
        bits = bits.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        bits.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/filter/batch={batch_id}")


def ingest_new(stream, sink, checkpoint, ident="id", seen=None, buckets=BUCKETS):
    """Append records whose id is present and not in the sink yet; exact, however late an id comes back.

    Each batch goes to its own folder of the sink and replaces it, so a batch that is run again after a failure leaves one
    copy. The ids are kept beside it, in ``seen`` (by default the sink's path with ``.seen``); a sink that was filled
    without such a store gets one from its records with the first batch.
    """
    seen = seen or f"{sink.rstrip('/')}.seen"

    def append(batch, batch_id):
        spark = batch.sparkSession
        kind = batch.schema[ident].dataType
        store = SeenIds(spark, seen, ident, kind, buckets)
        named = lambda df: df.select(F.col(ident).alias("id"), store.bucket(F.col(ident)).alias("bucket"))
        if _existing(spark, f"{seen}/ids", T.StructType(store.kinds["ids"])) is None:
            stored = _existing(spark, sink, T.StructType([*batch.schema.fields, T.StructField("batch", T.LongType())]))
            if stored is not None:
                store.add(named(stored.filter(F.col("batch") != batch_id).dropDuplicates([ident])), -1)
        fresh = written(one_row_each(batch.filter(F.coalesce(F.col(ident).cast("string"), F.lit("")) != ""), ident), "arrived")
        known = store.known(named(fresh), batch_id)
        if known is not None:
            fresh = written(fresh.join(known.withColumnRenamed("id", ident), ident, "left_anti").select(*batch.columns), "fresh")
        store.add(named(fresh), batch_id)
        fresh.select(*batch.columns).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)


def ingest_within(stream, time, delay, sink, checkpoint, ident="id"):
    """Append records not repeated within the watermark; state is bounded by the delay."""
    fresh = stream.filter(F.col(ident).isNotNull()).withWatermark(time, delay).dropDuplicatesWithinWatermark([ident])
    return fresh.writeStream.format("parquet").outputMode("append").option("path", sink).option("checkpointLocation", checkpoint)


def ingest_pages(pages, base_url, sink, checkpoint):
    """Listings of arriving pages, each id once."""
    return ingest_new(listings_from_pages(pages, base_url), sink, checkpoint)


def counts_per_window(stream, time, window="1 day", delay="1 hour", keys=()):
    """Rows per tumbling window; rows later than the watermark are dropped."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, window), *keys)
        .agg(F.count(F.lit(1)).alias("listings"))
        .select(F.col("window.start").alias("window_start"), *keys, "listings")
    )


def write_append(stream, sink, checkpoint, format="parquet"):
    return stream.writeStream.format(format).outputMode("append").option("path", sink).option("checkpointLocation", checkpoint)


def transform_stream(stream, fitted, sink, checkpoint):
    """A fitted step or chain of steps applied to every arriving row."""
    return write_append(fitted.transform(stream), sink, checkpoint)
