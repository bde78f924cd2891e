"""op12: every document's ids, written as shuffled planes and read back."""

from __future__ import annotations

import uuid
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wayline.llm.common import shared_folder
from wayline.llm.planes import read_ids, write_ids
from wayline.session import table

VOCABULARY = "byte_bpe_50k.json"


def op12_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/wayline-ids-{uuid.uuid4().hex}"
    vocabulary = Path(public_tokenizers.path(VOCABULARY)).read_text(encoding="utf-8")
    write_ids(table(spark, sf_dir, "documents"), folder, vocabulary)
    return read_ids(spark, folder, ids=False)
