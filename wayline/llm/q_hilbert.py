"""op8: approximate nearest neighbours of every twentieth vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayline.llm.hilbert import neighbours
from wayline.session import table


def op8_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))
