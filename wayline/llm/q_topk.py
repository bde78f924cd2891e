"""op10: exact highest integer scores of every fiftieth vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayline.llm.topk import top_scores
from wayline.session import table


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH usable AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
