"""From raw documents to a training mix: five stages, each over all that the one before kept.

Every stage is a function of (spark, docs, sf_dir). ``run`` writes what a stage returns as Parquet to the shared folder and
rereads it for the next: lineage stays short and a lost executor costs a reread. All stages but the last return the
columns of ``documents``; the last returns one row per remaining document with the words that the mix takes from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lettora.llm.decontamination import without_leaks
from lettora.llm.line_dedup import drop_shared_lines
from lettora.llm.mixing import mix, words_taken
from lettora.llm.quality_rules import keep_good
from lettora.llm.simhash import one_of_each
from lettora.llm.tables import table
from lettora.sources.shared import cleaned, deleted, fresh_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule, or are anomalies by the isolation forest, go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of five or more documents stay in one of them; documents stay, if need be with an empty text."""
    return drop_shared_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest ``doc_id``."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes from each document."""
    return words_taken(mix(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
]

#: The forest, the fingerprints and the hashed draws have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name.replace(' ', '-')}")
        with cleaned(spark):  # what a stage itself has put into the shared folder; its result stays
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            deleted(spark, before)  # it has been read for the last time
        docs, before = spark.read.parquet(path), path
    return docs
