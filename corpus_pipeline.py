"""Corpus pipeline: quality classifier, exact dedup, SimHash near-dedup, benchmark decontamination, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet under
``spark.checkpoint.dir`` and reads again as the next stage's ``docs``.  All but
the last stage return the columns of ``documents``; the last returns a row for
each packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.llm import decontaminate, exact_dedup, packing, quality, simhash
from graphmill.llm.common import settle, table, unused


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more."""
    name = unused(docs, "quality_score")
    weights = quality.fit(*quality.training_rows(docs, table(spark, sf_dir, "labels"), "quality", 24_000))
    return quality.score(docs, weights, name=name).where(F.col(name) >= 0.3).drop(name)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component (three-word shingles, three bits) the document with the smallest id."""
    return simhash.drop_near(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("exact", exact_stage), ("near", near_stage), ("benchmark", benchmark_stage), ("packing", packing_stage)]

#: Neither the classifier nor the packing can be stated in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
