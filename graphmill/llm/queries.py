"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graphmill.llm import (chat, collocations, conversation_repair, decontaminate, exact_dedup, html_extract, packing, pii, quality, simhash,
                           suffix_dedup, token_counts, toxicity)
from graphmill.llm.common import table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.extract(_documents(spark, sf_dir)))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_repeats(_documents(spark, sf_dir)).drop("kept")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return out.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_documents(spark, sf_dir))


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_pii, op2_packing, op3_toxicity, op4_decontamination, op5_suffix, op6_html, op7_quality,
                                   op8_chat, op9_simhash, op10_exact, op11_collocations, op12_tokens, op13_repair)}

ORACLE: dict[str, str] = {
    "op8_chat": chat.ROTATE_SQL,
    "op11_collocations": collocations.COLLOCATIONS_SQL,
    "op10_exact": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW same AS (PARTITION BY t)""",
}
