"""Corpus pipeline: reject poor texts, keep one of each near-duplicate class, drop benchmark leaks, mask personal data, mix sources.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame, which is written
as Parquet and read again for the next one. All but the last return the columns of ``documents``; the last adds ``copy``.
The classifier learns from the labels of documents that reach it; benchmark items are read from the tables.

Defined cases, in every stage: further columns, whatever their names, are kept as they are; repeated rows are judged alike; an
empty table stays empty; very long texts are read whole. Null ids and null or empty texts are said with each stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklore.llm import decontaminate, mixing, near_dedup, pii, quality
from tracklore.llm.common import fold, shared_folder, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts. Null and empty texts get a score like others; a null id is never learnt from."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), keep=fold(F.col("doc_id"), quality.HELD_OUT[0]) != quality.HELD_OUT[1])
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class. Texts without words are alone in their class; rows with a null id all stay."""
    return near_dedup.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a benchmark passage, each judged by its own text, so that null ids matter not. Null and empty texts stay."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked, n_chars counted anew where the text changed. Null and empty texts stay as they are."""
    return pii.redact(docs, pii.train(pii.example_table(spark)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with the number of the copy. A null source is a source; texts without words are
    taken once where their source's rate is 1 or more."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("personal data", mask_personal_data),
    ("source mix", mix_sources),
]

#: The classifier, the random field and the signatures are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
