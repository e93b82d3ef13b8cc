"""From raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the stage's output is written as
Parquet and read again as the next one's ``docs``. All stages but the last keep the columns of
``docs``. A stage cannot be told in SQL as a whole (trained models, graph components, a tokenizer), so
there is no SQL for the rows of ``run``; the tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from novalake.llm import decontamination, jaccard_join, language, packing, pii
from novalake.llm.common import read_table, shared_code, staged
from novalake.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those whose language is not recognised."""
    shared_code(spark)
    return language.keep_known(docs, language.train(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    shared_code(spark)
    return jaccard_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more are passages of the benchmark."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data; ``n_chars`` follows the text."""
    shared_code(spark)
    return pii.redact(docs, pii.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the ids of whole documents into sequences."""
    shared_code(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", decontaminated),
    ("personal_data", redacted),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
