"""Corpus pipeline: five stages from raw documents to a weighted mix.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept.  All but
the last return the columns of ``documents``; the last returns the mix (document, times taken).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import _runtime as rt
from cadastra.llm import decontaminate, langid, mixing, quality, setsketch

#: A language prediction below this probability rejects a document.
LEAST_LANGUAGE_SCORE = 0.3


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    gone = rt.materialize(rejected.select(F.col("doc_id").alias("_gone")).distinct(), "rejected")
    return docs.join(rt.maybe_broadcast(gone, 40), docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    found = langid.identify(docs)
    return _without(docs, found.where((F.col("lang_pred") == "und") | (F.col("score") < LEAST_LANGUAGE_SCORE)))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for label 0 go."""
    return _without(docs, quality.classify(docs, rt.table(spark, sf_dir, "labels")).where("predicted = 0"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays.  Shingles of five words and a similarity of 0.8,
    the figures for every stage on word shingles; three words and 0.85 belong to the query op6 alone."""
    return setsketch.drop_near_duplicates(docs, setsketch.Params(shingle=5, percent=80))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, rt.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: doc_id, source, size, source_size, target, epochs, taken."""
    return mixing.mix(docs)


STAGES = [
    ("language ID", language),
    ("quality classifier", good),
    ("MinHash near-dedup", dedup),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
]

#: Networks and sketches cannot be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rt.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = rt.materialize(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
