"""op3: byte-level BPE encoding and decoding of every document."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.llm import bpe
from wayline.session import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def digests(docs: DataFrame) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    # one Python worker encodes and decodes
    found = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"),
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
