"""The corpus pipeline: toxic documents go, near copies go, secrets are blanked, sources are mixed, texts are encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayline.llm import bpe, minhash, mixing, secrets, toxicity
from wayline.llm.common import row_key, unused, written
from wayline.session import table, with_package

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def same_row(doc: str, row: str) -> Column:
    """Whether a row is the one that the columns named doc and row tell."""
    return (row_key() == F.col(row)) & F.col("doc_id").eqNullSafe(F.col(doc))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score is below one half."""
    scores = toxicity.scored(docs, table(spark, sf_dir, "labels"))
    doc, row = unused(docs, "_doc", "_row")
    rejected = scores.where("score >= 0.5").select(F.col("doc_id").alias(doc), F.col("row").alias(row)).distinct()
    return docs.join(rejected, same_row(doc, row), "left_anti").select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, one of the smallest doc_id; of equal rows one."""
    with_package(spark)
    doc, row, n = unused(docs, "_doc", "_row", "_n")
    kept = minhash.representatives(docs).toDF(doc, row, n)
    rows = docs.join(kept, same_row(doc, row))
    # only equal rows are compared with each other, so texts are shuffled once
    several = rows.where(F.col(n) > 1).dropDuplicates([doc, row])
    return rows.where(F.col(n) == 1).select(*docs.columns).unionByName(several.select(*docs.columns))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets replaced."""
    return secrets.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document's ids and of the bytes they decode to."""
    with_package(spark)
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    found = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)  # one Python worker encodes and decodes
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", clean),
    ("near-duplicates", distinct),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("encoding", encoded),
]

#: Learned scores and Newton steps have no SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
