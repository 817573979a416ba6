"""From raw documents to encoded training text, in stages that are each written and read again.

Each stage works on all rows its predecessor kept: texts the quality classifier rejects go, one text of
each class of near duplicates stays, texts that hold a benchmark window go, personal data is replaced in
what is left, and the result is encoded. The texts' order, ids and other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regchron.llm import decontaminate, near_text, pii, quality, sentencepieces
from regchron.llm.common import read_table, stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.pipeline_stage(spark, docs, sf_dir)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_text.pipeline_stage(spark, docs, sf_dir)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.pipeline_stage(spark, docs, sf_dir)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pipeline_stage(spark, docs, sf_dir)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepieces.pipeline_stage(spark, docs, sf_dir)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", replace_personal_data),
    ("encoding", encode),
]

# Classifier, alignment and merges are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage kept is stored before the next one begins."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
