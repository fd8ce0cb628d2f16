"""Session settings and the shared folder for intermediate tables."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app="parcelry", master=None, **conf):
    """A session with the settings every operator is written for.

    Partition counts are left to adaptive execution: on a cluster the initial
    number suits a shuffle of terabytes, and smaller ones are coalesced.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sizes = {} if (master or "").startswith("local") else {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192"}
    settings = {
        **sizes,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark):
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="parcelry-")
    context.setCheckpointDir(folder)
    return folder


def fresh_path(spark, label):
    """A new, unused location below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/parcelry/{label}-{uuid.uuid4().hex}"


def written(df, label):
    """``df`` stored once in the shared folder and read back.

    For a table that several statistics passes read: it cuts the lineage and
    outlives lost executors.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def share_package(spark):
    """Let Python workers that start from now on import this package."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    path = environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (path, root) if x)
    return spark
