"""Nets that tasks take whole: right rows, without a round of jobs a level."""

import heapq
import random
from collections import Counter, deque

import pytest

from graphmill.functions import nets
from graphmill.functions.state import DeltaLog, StateStore
from graphmill.operators import louvain, multi_source, paths
from graphmill.operators.closeness import closeness
from graphmill.operators.delta_stepping import delta_stepping
from graphmill.operators.louvain import init_state, louvain_edges


def some_edges(seed=7, n=330):
    """Over ``FEW_VERTICES`` vertices: two random nets, a way with cycles on it, single edges, a loop."""
    rng = random.Random(seed)
    rows = [(rng.randrange(n) + at, rng.randrange(n) + at) for at in (0, 1000) for _ in range(3 * n)]
    rows += [(5000 + i, 5001 + i) for i in range(9)] + [(5003, 5001), (5005, 5005)] + [(7000 + 2 * i, 7001 + 2 * i) for i in range(30)] + [(9000, 9000)]
    return [(a, b, float(rng.randrange(1, 9))) for a, b in rows]


def hops(edges, v):
    """Least hops against edge direction to ``v``."""
    into = {}
    for a, b, _ in edges:
        into.setdefault(b, []).append(a)
    far, todo = {v: 0}, deque([v])
    while todo:
        x = todo.popleft()
        for y in into.get(x, []):
            if y not in far:
                far[y] = far[x] + 1
                todo.append(y)
    return far


def frame(spark, edges):
    return spark.createDataFrame(edges, "src long, dst long, weight double")


@pytest.fixture
def logs(monkeypatch):
    """Names of the logs that are written; several units share a net, and nets of few edges a unit."""
    names, append = [], DeltaLog.append
    monkeypatch.setattr(DeltaLog, "append", lambda self, rows: names.append(self.name) or append(self, rows))
    monkeypatch.setattr(nets, "SHARED_EDGES", 100)
    for module in (multi_source, paths):
        monkeypatch.setattr(module, "MARKS_SERVED", 128)
    return names


def test_searches_from_all_vertices(spark, logs, monkeypatch):
    edges = some_edges()
    ids = {v for a, b, _ in edges for v in (a, b)}
    far = {v: hops(edges, v) for v in ids}
    every = Counter((v, h) for t in ids for v, h in far[t].items())
    reached = Counter(v for t in ids for v in far[t])
    e = frame(spark, edges)
    assert {(r["id"], r["hop"]): r["targets"] for r in multi_source.hop_profile(e).collect()} == every
    assert {r["id"]: r["reached"] for r in paths.reach_counts(e).collect()} == reached
    total = Counter()
    for (v, h), n in every.items():
        total[v] += h * n
    got = {r["id"]: r["value"] for r in closeness(e).collect()}
    assert got == {v: pytest.approx(reached[v] / total[v]) if total[v] else 0.0 for v in ids}
    assert not logs
    monkeypatch.setattr(nets, "NET_EDGES", 500)  # the random nets go by tables
    assert {(r["id"], r["hop"]): r["targets"] for r in multi_source.hop_profile(e).collect()} == every
    assert logs


def test_pairs_of_many_targets(spark, logs):
    edges = some_edges()
    marks = sorted({v for a, b, _ in edges for v in (a, b) if v % 9 != 4})
    assert len(marks) > multi_source.LANE
    e, want = frame(spark, edges), {(v, t): h for t in marks for v, h in hops(edges, t).items()}
    seeds = spark.createDataFrame([(m,) for m in marks + [-1]], "id long")
    got = paths.landmark_distances(e, seeds)
    assert {(r["id"], r["landmark"]): r["distance"] for r in got.collect()} == want and not logs
    assert "net-edges" in got._jdf.queryExecution().executedPlan().toString()  # rows of pairs are made as they are read


def plain_lengths(edges, marks):
    into, out = {}, {}
    for a, b, w in edges:
        into.setdefault(b, []).append((a, w))
    for m in marks:
        best, todo = {}, [(0.0, m)]
        while todo:
            d, x = heapq.heappop(todo)
            if x not in best:
                best[x] = d
                for y, w in into.get(x, []):
                    heapq.heappush(todo, (d + w, y))
        out |= {(v, m): d for v, d in best.items()}
    return out


def test_lengths_inside_tasks(spark, logs, monkeypatch):
    edges = some_edges() + [(2, 3, 0.0), (2, 3, 5.0), (1001, 1002, 40.0)]
    ends = sorted({v for a, b, _ in edges for v in (a, b)})
    marks = ends[:40] + ends[330:350] + ends[-20:]
    e, want, seeds = frame(spark, edges), plain_lengths(edges, marks), spark.createDataFrame([(m,) for m in marks + [-1]], "id long")

    def rows(df):
        return {(r["id"], r["landmark"]): r["distance"] for r in df.collect()}

    assert rows(paths.landmark_distances(e, seeds, weighted=True)) == want == rows(delta_stepping(e, seeds)) == rows(delta_stepping(e, seeds, 2.0))
    assert not logs
    monkeypatch.setattr(nets, "NET_EDGES", 500)  # the random nets go by tables
    assert rows(paths.landmark_distances(e, seeds, weighted=True)) == want
    assert logs


def test_null_ends_go_by_rows_and_types_stay(spark, monkeypatch):
    edges = spark.createDataFrame([(a, b) for a, b, _ in some_edges()], "src int, dst int")
    assert nets.Nets.of(edges.unionByName(spark.createDataFrame([(None, 3)], "src int, dst int")), StateStore(spark, "t")) is None
    assert nets.Nets.of(edges.selectExpr("string(src) src", "string(dst) dst"), StateStore(spark, "t")) is None
    assert nets.Nets.of(edges.limit(20), StateStore(spark, "t")) is None
    for df in (multi_source.hop_profile(edges), paths.reach_counts(edges)):
        assert df.schema["id"].dataType.simpleString() == "int"


def test_level_inside_tasks(spark, monkeypatch):
    """A level's moves in groups of nets, and with the whole graph in one, are those of the rounds; work ahead is cut at the right pass."""
    edges = louvain_edges(frame(spark, [(a, b, w) for a, b, w in some_edges() if a < 2000] + [(3, 3, 2.0)]), "weight")
    want, rounds = None, []
    state, e = init_state(edges)
    m = state.agg({"node_weight": "sum"}).first()[0]
    for whole, halves in ((0, 4), (500_000, 24)):
        monkeypatch.setattr(nets, "WHOLE_EDGES", whole)
        monkeypatch.setattr(louvain, "HALVES", halves)
        with monkeypatch.context() as quiet:
            quiet.setattr(louvain, "heard", lambda *a: rounds.append(a))
            q, after, passes = louvain.louvain_level(state, e, m, StateStore(spark, "t"))
        got = (round(q, 9), passes, sorted(tuple(r) for r in after.select("id", "community", "sigma_tot", "changed").collect()))
        assert not rounds and want in (None, got)
        want = got
    q, after, passes = louvain.louvain_level(state, e, m, StateStore(spark, "t"), trace=[])
    assert want == (round(q, 9), passes, sorted(tuple(r) for r in after.select("id", "community", "sigma_tot", "changed").collect()))
