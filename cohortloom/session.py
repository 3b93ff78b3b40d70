"""Sessions for local runs, and the shared folder used for written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, folder: str = "/tmp/cohortloom-checkpoints"
) -> SparkSession:
    """A single-JVM session for tests and the bench; a cluster brings its own.

    ``folder`` is where written tables go if the session has no ``spark.checkpoint.dir``.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cohortloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", folder)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor must be able to reach."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/cohortloom/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative trainers cut their lineage in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
