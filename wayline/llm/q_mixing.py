"""op6: all documents mixed to the weights of their sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.llm.mixing import mixture
from wayline.session import table


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixture(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
