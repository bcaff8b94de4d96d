"""Rounds of PageRank and of paths from few vertices meet blocks of edges: a few rows of arrays, whatever the number of edges."""

from collections import Counter, defaultdict

import pytest

from graphmill.functions import blocks
from graphmill.functions.state import StateStore
from graphmill.operators import pagerank as pr, paths


def plain(edges, tol=None, rounds=10_000, reset=0.15):
    out = Counter(a for a, _ in edges)
    value = {v: reset for e in edges for v in e}
    delta = dict(value)
    for _ in range(rounds):
        got = defaultdict(float)
        for a, b in edges:
            if a is not None and (tol is None or delta.get(a, 0.0) > tol):
                got[b] += delta.get(a, 0.0) / out[a]
        delta = {v: x * (1 - reset) for v, x in got.items()}
        for v, x in delta.items():
            value[v] += x
        if not delta:
            break
    return value


@pytest.mark.parametrize("block", [500_000, 10])
def test_blocks_of_edges(spark, monkeypatch, block):
    """A hub, parallel edges, a loop, sinks, null ends and parts without out-edges; one block, or many with the hub's dealt over several."""
    edges = [(0, i) for i in range(1, 80)] + [(i, i * 7 % 40) for i in range(1, 60)] + [(5, 6)] * 3 + [(9, 9), (-3, 2**40), (7, None), (None, 3)]
    df = spark.createDataFrame(edges, "src long, dst long")
    monkeypatch.setattr(blocks, "BLOCK_EDGES", block)
    tables, real = [], StateStore.save_bucketed

    def save_bucketed(self, rows, *given):
        out = real(self, rows, *given)
        tables.append((out.count(), out.select("part").distinct().count()))
        return out

    monkeypatch.setattr(StateStore, "save_bucketed", save_bucketed)
    for tol, n in ((1e-2, None), (None, 3), (None, 0)):
        got = {r["id"]: r["value"] for r in pr.pagerank(df, tol=tol, num_iter=n).collect()}
        assert got == pytest.approx(plain(edges, tol, *([] if n is None else [n])), abs=1e-9)
    rows, parts = tables[0]
    assert rows == 1 if block > len(edges) else parts < rows < len(edges) / 2


def test_state_of_past_rounds_goes(spark, demo, monkeypatch):
    kept, real = [], StateStore.save

    def save(self, df, name, **metrics):
        out = real(self, df, name, **metrics)
        if name.startswith("delta"):
            kept.append(sum(x.startswith("delta") for x in self._versions))
        return out

    monkeypatch.setattr(StateStore, "save", save)
    pr.pagerank(demo, num_iter=8)
    assert max(kept) <= 3


def test_no_edges(spark):
    none = spark.createDataFrame([], "src long, dst long")
    assert pr.pagerank(none, tol=1e-3).collect() == [] == pr.pagerank(none, num_iter=2, normalize=True).collect()


def shortest(edges, marks):
    """Lengths to the marks, by plain relaxation."""
    out = {}
    for m in marks:
        best, found = {m: 0.0}, True
        while found:
            found = False
            for a, b, w in edges:
                if b is not None and w is not None and b in best and best[b] + w < best.get(a, float("inf")):
                    best[a], found = best[b] + w, True
        out |= {(v, m): d for v, d in best.items()}
    return out


@pytest.mark.parametrize("block", [500_000, 10])
def test_few_landmarks_meet_blocks(spark, monkeypatch, block):
    """A hub, parallel edges, a weight of 0, null ends and an unreachable vertex; from one vertex and to three of them."""
    edges = [(0, i, float(i)) for i in range(1, 60)] + [(i, i * 7 % 40, 1.0 + i % 3) for i in range(1, 60)] + [(3, 5, 9.0), (3, 5, 0.0), (9, 9, 1.0),
             (70, 71, 1.0), (7, None, 1.0), (None, 3, 2.0)]
    df = spark.createDataFrame(edges, "src long, dst long, weight double")
    monkeypatch.setattr(blocks, "BLOCK_EDGES", block)
    tables, real = [], StateStore.save_bucketed
    monkeypatch.setattr(StateStore, "save_bucketed", lambda self, rows, *given: tables.append(real(self, rows, *given)) or tables[-1])

    def rows(d, a, b):
        got = [((r[a], r[b]), r["distance"]) for r in d.collect()]
        assert len(dict(got)) == len(got)
        return dict(got)

    marks = spark.createDataFrame([(0,), (5,), (9,), (1000,), (None,), (5,)], "id long")
    assert rows(paths.landmark_distances(df, marks, weighted=True), "id", "landmark") == shortest(edges, (0, 5, 9))
    assert rows(paths.single_source(df, spark.range(1)), "id", "origin") == shortest([(b, a, w) for a, b, w in edges], (0,))
    assert len(tables) == 2 and all(t.count() < len(edges) / 2 for t in tables)
    with pytest.raises(RuntimeError, match="not settled"):
        paths.landmark_distances(df, marks, weighted=True, max_iter=1)


def test_odd_weights_go_by_rows(spark):
    df = spark.createDataFrame([(1, 2, None), (2, 3, 1.0), (3, 4, float("inf")), (5, 3, None)], "src long, dst long, weight double")
    got = {(r["id"], r["landmark"]): r["distance"] for r in paths.landmark_distances(df, spark.createDataFrame([(3,), (4,)], "id long"), weighted=True).collect()}
    inf = float("inf")
    assert got == {(3, 3): 0.0, (2, 3): 1.0, (4, 4): 0.0, (3, 4): inf, (2, 4): inf}
    with pytest.raises(ValueError, match="negative"):
        paths.landmark_distances(spark.createDataFrame([(1, 2, -1.0)], "src long, dst long, weight double"), spark.range(3), weighted=True)


def test_nothing_by_vertex_is_broadcast(spark, demo, monkeypatch):
    """Small files may unpack to a row a vertex: no round and no result collects them on the driver."""
    plans = []
    for name in ("a_round", "totals"):
        real = getattr(blocks, name)
        monkeypatch.setattr(blocks, name, lambda *a, _real=real, **k: plans.append(_real(*a, **k)) or plans[-1])
    assert paths.mean_path_length(demo, spark.range(1, 2)).count() == 1
    assert len(plans) > 2 and not any("Broadcast" in p._jdf.queryExecution().executedPlan().toString() for p in plans)
