"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of the contracts: runs of anything but the six ASCII white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode one of our own where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="wayline-"))
            atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
        folder = f"file://{_own_folder[0]}"
    return folder.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again: its lineage ends there, and lost executors lose none of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/wayline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer until df has no such column."""
    taken, out = {name.lower() for name in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def row_key() -> Column:
    """A number, never null, that tells a row by its doc_id and whole text."""
    return F.xxhash64(F.col("doc_id").cast("long"), whole_text())
