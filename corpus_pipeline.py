"""Training-data pipeline over ``documents``: quality rules, language, repeated lines, near
copies, packing. Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet in the shared checkpoint folder and reads them for the next.

Stage 1 drops documents that the base rules or the fitted quality model reject, stage 2 those
without a clear language, stage 3 takes repeated lines out of the texts, stage 4 keeps one
document of each group of near copies, stage 5 returns the packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cdmspark.llm import lang_id, line_dedup, near_dedup, packing, quality_rules
from cdmspark.llm.common import materialise, read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_id.keep_identified(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, k=5, percent=80)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("language", language_stage),
    ("repeated lines", line_stage),
    ("near copies", near_stage),
    ("packing", packing_stage),
]

#: The fitted models (quality, language) and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{i}")
    return docs
