"""Session helpers shared by queries, tests and the bench."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
ROOT = str(Path(__file__).resolve().parent.parent)


def local_session(cpus: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench share."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("wayline")
    defaults = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def with_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package wherever the driver found it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    if not spark.sparkContext.getConf().contains(BATCH):
        spark.conf.set(BATCH, str(8 << 20))  # long texts come to Python a few at a time
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables, by any path Spark can read."""
    return with_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _checkpoint_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, set as such; in local mode one of our own where that is unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
            folder = tempfile.mkdtemp(prefix="wayline-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and kept with its partitions in the folder of checkpoints."""
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df, computed once and kept as Parquet in the folder of checkpoints: what asks for some of its columns reads no others."""
    spark = df.sparkSession
    path = f"{_checkpoint_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
