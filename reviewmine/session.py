"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; the cluster's own values win where they are set.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


WORTH_WAITING = 1 << 26  # bytes of files that are worth a wait until nothing refers to them


def get_session(app: str = "reviewmine", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    active = SparkSession.getActiveSession()
    given = SparkConf()
    for key, value in SCALE_CONF.items():
        if (active.conf.get(key, None) if active else given.get(key)) is None:
            builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset a temporary folder is made, and only on a local master,
    because on a cluster such a folder would not be shared.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    path = spark.conf.get("spark.reviewmine.sharedDir", None)
    if path:
        return path
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster is a cluster
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.reviewmine.sharedDir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/reviewmine/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Take out what was written to a path of ``scratch_path`` once nothing reads it any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def free_files(spark: SparkSession, size: int) -> None:
    """Lets Spark delete the shuffle files and checkpoints that nothing refers to any more, about ``size`` bytes."""
    if size > WORTH_WAITING:
        gc.collect()
        time.sleep(0.2)  # py4j lets go of its objects in a thread of its own
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
