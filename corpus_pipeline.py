"""A training corpus from ``documents``: five stages, each over all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of ``documents``; their
results are written as Parquet and read again as the next stage's docs.

1. toxicity: the ordinal model is fitted on the labelled documents; those of expected severity 0.5 and more go.
2. jaccard_join: of documents whose shingle sets are alike by three quarters, directly or over others, the one of the
   smallest id stays.
3. decontamination: documents that hold a window of a benchmark item go.
4. secret_scan: found secrets become a mark in the text; every document stays, with its new length.
5. bpe: token counts and digests of the ids and of the decoded text.

A null or empty text is not toxic, links with nothing, holds no window and no secret, and stays to the end, where it has no
tokens. Rows with a null id stay. Rows that share an id are one document to the join: they stay or go together. Each stage
reads whole texts, however long, and hands on every column of ``documents``, also further ones, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import bpe, decontaminate, jaccard_join, secret_scan, toxicity
from orderflow.llm.common import prepare, saved, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.reject_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_scan.redact(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.round_trip(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("jaccard_join", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("bpe", bpe_stage),
]

#: SQL can't express the first and the last stage; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole of ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
