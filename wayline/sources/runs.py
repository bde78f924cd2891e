"""Folders of run archives straight to runs and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.operators import assembly
from wayline.sources import archives


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The typed archives of a folder, or the one in a file, with what is wrong with each; a reviewed version stands in for its original."""
    return archives.parse_archives(archives.select_archives(archives.read_files(spark, path)))


def read_samples(spark: SparkSession, path: str, excluded: Sequence[str] = (), reviewed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(samples, account) of a folder of archives: the runs that make a sample, and why the others make none, broken archives among them.

    Original archives count, or with `reviewed` the reviewed versions where there are any. Nothing is read before it is asked for.
    """
    files = archives.read_files(spark, path)
    if not reviewed:
        files = files.where(~F.endswith("name", F.lit(".reviewed.json")))
    return assembly.samples(archives.select_archives(files), excluded=excluded)
