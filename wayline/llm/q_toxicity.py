"""op9: toxicity of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.llm.toxicity import held_out, toxicity
from wayline.session import table


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
