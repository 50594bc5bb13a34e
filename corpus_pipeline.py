"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet to the shared folder and read again as the next stage's ``docs``.
All stages but the last return the columns of ``documents``:

1. quality            rejected documents go
2. simhash            one document of each near-duplicate group stays
3. decontaminate      documents that leak a benchmark item go
4. secrets            secret spans are masked in the texts; every document stays
5. packing            sequences of at most 2048 tokens, a row per piece
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkwright.llm import decontaminate, packing, quality, secrets, simhash
from sparkwright.llm.shared import stage, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, quality.training_labels(spark, sf_dir))
    return quality.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=4, bits=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: SQL can express neither the classifier nor the tokenizer; the pipeline is
#: tested against a brute-force version of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, apply) in enumerate(STAGES, 1):
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
