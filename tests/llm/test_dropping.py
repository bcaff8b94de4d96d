"""Dropping stages move only rows that may be dropped; awkward rows and empty tables through every stage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from graphmill.llm import decontaminate, exact_dedup, simhash
from graphmill.llm.common import may_hold
from tests.llm import brute
from tests.llm.test_text_operators import AWKWARD

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, own_id int, bits_at string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "web", len(t or ""), 1, "x") for i, t in rows], SCHEMA)


@pytest.fixture
def unbroadcast(spark):
    """Joins aren't broadcast unless they are told to be."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_may_hold(spark):
    keys = spark.range(0, 5000, 7).select(F.xxhash64("id").alias("k"))
    some, others = may_hold(spark.range(5000), F.xxhash64("id"), keys, keys.count())
    some, others = ({r[0] for r in x.collect()} for x in (some, others))
    assert some | others == set(range(5000)) and not some & others
    assert set(range(0, 5000, 7)) <= some and len(some) < 1200
    assert may_hold(spark.range(5), F.xxhash64("id"), keys.limit(0), 0)[0].count() == 0


def test_only_possible_hits_move(unbroadcast):
    spark = unbroadcast
    rows = [(i, f"text {i} of many words that are not said twice {i * i}") for i in range(400)] + [(500 + i, "text 3 of many words that are not said twice 9") for i in range(5)]
    docs = documents(spark, rows)
    path = corpus_pipeline.settle(docs, "docs")
    got = exact_dedup.drop_copies(path)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted([i for i, _ in rows[:400] if i != 3] + [504])
    metrics = {}

    def walk(node):  # rows that were written to shuffles of whole documents
        text = node.toString()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec" and "text" in node.child().output().toString():
            metrics[node.hashCode()] = node.metrics().apply("shuffleRecordsWritten").value()
        for k in range(node.children().size()):
            walk(node.children().apply(k))
        return text

    plan = got._jdf.queryExecution().executedPlan()
    walk(plan.executedPlan() if hasattr(plan, "executedPlan") else plan)
    assert sum(metrics.values()) <= 20


def plain_exact(rows):
    keep = {}
    for i, t in rows:
        keep[t or ""] = max(keep.get(t or "", -1), -1 if i is None else i)
    return sorted(keep.values())


@pytest.mark.parametrize("broadcast", [True, False])
def test_awkward_rows(spark, broadcast):
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    docs = documents(spark, AWKWARD)
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in got.collect()) == plain_exact(AWKWARD)
    near = simhash.drop_near(docs)
    ids, fps = [i for i, _ in AWKWARD], [brute.fingerprint(t) for _, t in AWKWARD]
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(set(brute.near_components(ids, fps)))
    items = spark.createDataFrame([(1, "two words"), (2, None), (None, "don't stop")], "item_id long, text string")
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] or -1 for r in left.collect()) == sorted(i or -1 for i, _ in AWKWARD if i not in (5, 10))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_table_through_all_stages(spark, sf):
    docs = documents(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0, name
        if name != "packing":
            assert out.columns == docs.columns
            docs = out
