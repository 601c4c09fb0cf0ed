"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


#: Bytes of a shuffle that Spark gives one task, if the cluster does not say. Records are made and parsed as JSON
#: behind joins: with Spark's 64 MB a stage has hardly more tasks than cores, and some cores stand idle at its end.
TASK_INPUT = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def configure(spark: SparkSession) -> SparkSession:
    """Dates and date keys are taken in UTC, whatever the machine's zone is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    if spark.conf.get(TASK_INPUT, None) is None:
        spark.conf.set(TASK_INPUT, "16m")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    used = spark.sparkContext.getCheckpointDir()
    if used:
        return used.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="tidewell-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Share out the rows of a scan that has fewer tasks than the cluster has cores.

    A file of one row group, or a gzip file, is read by one task, and all work up
    to the first shuffle would stay in it. A table of many blocks is left alone.
    `by` names columns that tell rows apart; without them Spark would sort the rows
    to share them out the same way each time.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *by)
