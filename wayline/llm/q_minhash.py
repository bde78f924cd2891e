"""op2: near-duplicate classes of documents by three-word shingles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayline.llm.minhash import near_duplicates
from wayline.session import table


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
