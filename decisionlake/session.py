"""Session settings, table access and lineage cutting that hold on a cluster and in tests."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8, **more: str) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter's settings hold."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("decisionlake").config("spark.driver.memory", memory)
    for k, v in (CONF | {"spark.sql.shuffle.partitions": str(partitions)} | more).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table of that name in a folder of parquet tables."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir`` that all machines share, set as the checkpoint folder.

    Where neither the session nor its context names a folder, a local master (in tests) gets a temporary one; on a cluster
    that is an error, since a machine's own folder is lost with it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
        if not named:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
            named = tempfile.mkdtemp(prefix="decisionlake-")
        context.setCheckpointDir(named)
    folder = context.getCheckpointDir()
    assert folder is not None
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application, so that they needn't have it installed."""
    context = spark.sparkContext
    if getattr(context, "_decisionlake_shipped", None) != context.applicationId:
        folder = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="decisionlake-"), "decisionlake.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for at, _, names in os.walk(folder):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(at, name)
                        z.write(path, os.path.join("decisionlake", os.path.relpath(path, folder)))
        context.addPyFile(archive)
        context._decisionlake_shipped = context.applicationId
    return spark
