"""From raw documents to piece ids: what a training run reads.

Rules learned from labels drop poor text, a conditional random field drops toxic
text, near-duplicates and benchmark leaks go, and the rest is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colmask.llm.decontaminate import remove_contaminated
from colmask.llm.pieces import encoded_documents
from colmask.llm.rules import keep_quality
from colmask.llm.simhash import drop_near_duplicates
from colmask.llm.toxicity import drop_toxic
from colmask.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned quality rules keep."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under a half."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document left."""
    return encoded_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Stages are learned or iterate: no SQL. They are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
