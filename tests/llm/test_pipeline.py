"""The whole pipeline against plain versions of its stages, each on its own input."""

from __future__ import annotations

import corpus_pipeline
from graphmill.llm import quality
from graphmill.llm.common import settle, table
from tests.llm import brute


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
        docs = settle(stage(spark, docs, sf), name)
        after = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
        if name == "quality":
            scored = quality.quality(table(spark, sf, "documents"), table(spark, sf, "labels"))
            assert after == sorted(r["doc_id"] for r in scored.where("predicted = 1").collect())
            marks = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
            good = [i for i, q in marks.items() if q == 1]
            assert len(set(good) & set(after)) >= 0.98 * len(good)
        elif name == "exact":
            keep = {}
            for i, t in before.items():
                keep[t] = max(i, keep.get(t, i))
            assert after == sorted(keep.values())
        elif name == "near":
            ids = list(before)
            assert after == sorted(set(brute.near_components(ids, [brute.fingerprint(before[i]) for i in ids])))
        elif name == "benchmark":
            items = [r["text"] for r in table(spark, sf, "benchmark").collect()]
            holds = {i for i, t in before.items() if any(x in t for x in items)}
            assert holds and not holds & set(after) and len(before) - len(after) <= len(holds) + 5
        if name != "packing":
            assert docs.columns == columns
        else:
            assert set(after) == set(before)
        seen.append(len(before))
    assert seen[0] > seen[1] > seen[2] >= seen[3] > seen[4]  # few near copies at this size, or none


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
