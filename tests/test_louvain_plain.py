"""Louvain over several levels against a plain version that scores every vertex in every half cycle, and resumed loops."""

import random
from collections import defaultdict

import pytest

from graphmill.functions.state import forget
from graphmill.operators import louvain as lv
from graphmill.operators import pagerank as pr
from graphmill.plans import graphs as G
from tests.conftest import as_map


def plain_level(state, edges, m):
    """``state``: id -> [community, internal, node weight]; edges: (a, b) -> weight, both ends hear of each other."""
    hears = defaultdict(list)
    for (a, b), w in edges.items():
        hears[a].append((b, w))
        hears[b].append((a, w))
    stalls = before = passes = 0
    traces = []

    def sums():
        out = defaultdict(int)
        for c, internal, k in state.values():
            out[c] += internal + k
        return out

    def half(even):
        total, moves = sums(), {}
        for i in hears:
            own, internal, k = state[i]
            near = defaultdict(int)
            for j, w in hears[i]:
                near[state[j][0]] += w
            best = None
            for c, k_in in near.items():
                sigma = total[c] - (internal + k if c == own else 0)
                gain = (k_in + (internal if c == own else 0)) * m - (internal + k) * sigma
                if c == own and sigma == 0:
                    gain = 0
                if gain > 0 and (best is None or (gain, c) > best):
                    best = gain, c
            if best and best[1] != own and (own > best[1] if even else own < best[1]):
                moves[i] = best[1]
        for i, c in moves.items():
            state[i][0] = c
        traces.append((sum(map(len, hears.values())), len(moves)))
        return len(moves)

    while True:
        passes += 1
        moved = half(True) + half(False)
        stalls += moved >= before - 1
        before = moved
        if not moved or stalls > 1:
            break
    total, q = sums(), 0.0
    for i in hears:
        own, internal, k = state[i]
        k_own = sum(w for j, w in hears[i] if state[j][0] == own)
        q += max(0.0, (internal + k_own) / m - total[own] * (internal + k) / m ** 2)
    return q, passes, traces


def plain_louvain(rows):
    edges, weight = defaultdict(int), defaultdict(int)
    for a, b, w in rows:
        edges[a, b] += w
        weight[a] += w
        weight[b] += w
    state = {i: [i, 0, k] for i, k in weight.items()}
    m, prev, history, levels, traces, where = sum(weight.values()), -1.0, [], [], [], {i: i for i in state}
    while True:
        q, passes, trace = plain_level(state, edges, m)
        traces += trace
        where = {i: state[c][0] for i, c in where.items()}
        levels.append(dict(where))
        history.append((q, passes))
        if not (passes > 2 and q > prev + 0.001):
            return levels, history, traces
        prev, internal, between, node = q, defaultdict(int), defaultdict(int), defaultdict(int)
        for c, inside, _ in state.values():
            internal[c] += inside
        for (a, b), w in edges.items():
            a, b = state[a][0], state[b][0]
            if a == b:
                internal[a] += 2 * w
            else:
                between[min(a, b), max(a, b)] += w
                node[a] += w
                node[b] += w
        state, edges = {c: [c, internal[c], node[c]] for c in internal}, between


def check(edges, trace=None, **options):
    assign, hist = lv.louvain(edges, weight="weight", trace=trace, **options)
    rows = [(r["src"], r["dst"], int(r["weight"])) for r in edges.collect()]
    levels, history, traces = plain_louvain(rows)
    got = defaultdict(dict)
    for r in assign.collect():
        got[r["level"]][r["id"]] = r["community"]
    assert [got[k] for k in range(len(levels))] == levels and len(got) == len(levels)
    assert [(r["passes"], round(r["q"], 9)) for r in hist.orderBy("level").collect()] == [(p, round(q, 9)) for q, p in history]
    return traces


def test_parts_over_all_levels(spark):
    trace = []
    plain = check(G.part_graph(spark, "/root/testdata/sf0.001"), trace)
    assert [m for _, m in trace] == [m for _, m in plain]  # the same moves in every half cycle of every level


def blocks(seed=5, groups=12, size=8):
    """Groups with many inner links in a ring, loops, and parallel and reversed edges."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        own = range(g * size, (g + 1) * size)
        for a in own:
            for b in own:
                if a < b and rng.random() < 0.6:
                    rows.append((a, b, rng.randint(1, 4)) if rng.random() < 0.5 else (b, a, rng.randint(1, 4)))
        rows += [(own[0], (own[-1] + 1) % (groups * size), 1), (own[1], own[1], 2), (own[2], own[3], 1), (own[3], own[2], 1)]
    return rows


def test_blocks_hear_less_each_half_cycle(spark):
    trace = []
    edges = spark.createDataFrame(blocks(), "src long, dst long, weight long")
    plain = check(edges, trace)
    assert [m for _, m in trace] == [m for _, m in plain]
    quiet = [(rows, every) for (rows, _), (every, _) in zip(trace, plain) if rows < every]
    assert quiet and min(rows / every for rows, every in quiet) < 0.5
    assert all(rows <= every for (rows, _), (every, _) in zip(trace, plain))


class Lost(Exception):
    pass


def lose_at(monkeypatch, module, name, call):
    """Let the driver be lost at a call of a function."""
    real, seen = getattr(module, name), []

    def wrapped(*a, **k):
        seen.append(1)
        if len(seen) == call:
            raise Lost
        return real(*a, **k)

    monkeypatch.setattr(module, name, wrapped)


@pytest.mark.parametrize("name, call", [("settle_moves", 4), ("compress", 1), ("modularity_frame", 2)])
def test_louvain_resumes(spark, monkeypatch, name, call):
    forget(spark, "louvain", "t")
    edges = spark.createDataFrame(blocks(groups=6, size=5), "src long, dst long, weight long")
    with monkeypatch.context() as lost:
        lose_at(lost, lv, name, call)
        with pytest.raises(Lost):
            lv.louvain(edges, weight="weight", resume="t")
    trace = []
    plain = check(edges, trace, resume="t")
    assert [m for _, m in trace] == [m for _, m in plain][-len(trace):] and len(trace) < len(plain)
    again = []
    check(edges, again, resume="t")
    assert not again  # the result was there
    with pytest.raises(ValueError, match="other edges or settings"):
        lv.louvain(edges.where("src <> 1"), weight="weight", resume="t")
    forget(spark, "louvain", "t")


def test_pagerank_resumes(spark, demo, monkeypatch):
    forget(spark, "pagerank", "t")
    with monkeypatch.context() as lost:
        real = pr.StateStore.save

        def save(self, df, name, **metrics):
            if name == "delta3":
                raise Lost
            return real(self, df, name, **metrics)

        lost.setattr(pr.StateStore, "save", save)
        with pytest.raises(Lost):
            pr.pagerank(demo, num_iter=10, resume="t")
    rounds, real = [], pr.StateStore.save
    monkeypatch.setattr(pr.StateStore, "save", lambda self, df, name, **m: rounds.append(name) or real(self, df, name, **m))
    got = as_map(pr.pagerank(demo, num_iter=10, resume="t"))
    assert [r for r in rounds if r.startswith("delta")][0] == "delta3"
    assert got == as_map(pr.pagerank(demo, num_iter=10))
    forget(spark, "pagerank", "t")
