"""What the operators of this package share: worker set-up, column selection, block sizes, skew-proof lookups."""

import os

from pyspark.sql import functions as F

from parcelry.session import fresh_path, shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: A key with at least this fraction of all rows counts as heavy; so there are at most 1 / HEAVY heavy keys.
HEAVY = 1 / 4096


#: Rows and bytes of a batch that goes to a Python worker: whole texts are long, and several workers share an executor's memory.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def ready(spark):
    """Let Python workers import this package, keep their batches small, and point checkpoints at the shared folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    path = context.environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(x for x in (path, ROOT) if x)
    shared_folder(spark)
    return spark


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs):
    """``doc_id`` and the whole ``text`` of each document, a missing text as the empty one."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def settled(df, label):
    """``df`` written once to the shared folder and read back: no lineage, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(key, modulus):
    """crc32 of the key's decimal text, modulo ``modulus``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(modulus)


def blocks_for(docs, block_bytes, column="text", least=12):
    """How many blocks of about ``block_bytes`` hold all of ``column``; one pass over its lengths."""
    total = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(least, -(-int(total) // block_bytes))


def unique_join(rows, keyed, key, columns, heavy=HEAVY):
    """Left join of ``rows`` with ``keyed``, which has one row per key and the number of rows it meets as ``n_rows``.

    Keys that meet at least the fraction ``heavy`` of all rows are broadcast: there are at most 1 / heavy of them.
    The rest is joined by shuffle, where no key holds more than that fraction. Both must be stored tables.
    """
    total = keyed.agg(F.sum("n_rows")).first()[0] or 0
    is_heavy = F.col("n_rows") >= F.lit(max(1.0, total * heavy))
    hot = F.broadcast(keyed.where(is_heavy).select(key, *columns))
    cold = keyed.where(~is_heavy).select(key, *columns)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key, "left"))
