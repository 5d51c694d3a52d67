"""Session construction and the one place that decides where checkpoints go."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "clauseforge", cores: str | int = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the tests and the benchmark share (UTC, AQE, Arrow)."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CLAUSEFORGE_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where that setting is absent *and* the master is local (tests, laptop) is a temporary folder
    chosen; on a cluster a missing setting is an error, because executors share no temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="clauseforge-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable (shared-folder) checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bound(df: DataFrame, *columns: Column) -> DataFrame:
    """``df`` with further columns that are computed once: a generator of one row, through which no filter is pushed down
    with a copy of their expressions."""
    return df.select("*", F.explode(F.array(F.struct(*columns))).alias("__bound")).select("*", "__bound.*").drop("__bound")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
