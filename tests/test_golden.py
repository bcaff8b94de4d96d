"""Worked values on the demo graph (FIXTURES §2)."""

import pytest

from graphmill.functions.graph import canonical
from graphmill.operators.betweenness import k_betweenness, k_hop_neighborhood
from graphmill.operators.closeness import closeness
from graphmill.operators.degree import degree_centrality
from graphmill.operators.eigenvector import eigenvector
from graphmill.operators.pagerank import pagerank
from graphmill.operators.paths import landmark_distances, mean_path_length, single_source
from graphmill.operators.triangles import local_clustering, triangle_count
from tests.conftest import as_map


def approx_map(got, want, tol=1e-6):
    assert set(got) == set(want), (got, want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=tol), (k, got[k], v)


def test_degree(demo):
    e = canonical(demo)
    approx_map(as_map(degree_centrality(e, "in")),
               {2: .166667, 3: .166667, 4: .333333, 5: .5, 6: .333333, 7: .333333})
    approx_map(as_map(degree_centrality(e, "out")),
               {1: .333333, 2: .5, 3: .166667, 4: .333333, 5: .333333, 6: .166667})
    approx_map(as_map(degree_centrality(e, "all")),
               {1: .333333, 2: .666667, 3: .333333, 4: .666667, 5: .833333, 6: .5, 7: .333333})


def test_triangles_and_clustering(demo):
    assert as_map(triangle_count(demo), value="triangles") == {1: 1, 2: 3, 3: 1, 4: 3, 5: 4, 6: 2, 7: 1}
    approx_map(as_map(local_clustering(demo)), {1: 1, 2: .5, 3: 1, 4: .5, 5: .4, 6: .666667, 7: 1})


def test_closeness(demo):
    approx_map(as_map(closeness(canonical(demo))),
               {1: .636364, 2: .857143, 3: .8, 4: 1, 5: 1.5, 6: 2, 7: 0})


def test_pagerank_tol_and_normalised(demo):
    want = {1: .15, 2: .21375, 3: .210563, 4: .274312, 5: .506123, 6: .481685, 7: .774535}
    approx_map(as_map(pagerank(demo, tol=1e-6)), want)
    approx_map(as_map(pagerank(demo, tol=1e-6, normalize=True)),
               {1: .40215, 2: .573063, 3: .564518, 4: .735431, 5: 1.356916, 6: 1.291397, 7: 2.076526})
    # on a DAG of depth 5, five fixed rounds reach the same fixed point
    approx_map(as_map(pagerank(demo, num_iter=5)), want)


def test_eigenvector(demo):
    approx_map(as_map(eigenvector(demo, num_iter=5)),
               {1: .004207, 2: .025243, 3: .067315, 4: .088352, 5: .319749, 6: .509073, 7: .790957})
    approx_map(as_map(eigenvector(demo, max_iter=100)),
               {1: 0, 2: .000001, 3: .000027, 4: .000028, 5: .001875, 6: .047815, 7: .998854})


def test_k_betweenness(demo):
    zeros = {i: 0.0 for i in range(1, 8)}
    approx_map(as_map(k_betweenness(demo, 0)), zeros)
    approx_map(as_map(k_betweenness(demo, 1)), zeros)
    approx_map(as_map(k_betweenness(demo, 2)), {1: 0, 2: 4, 3: 0, 4: 4, 5: 9, 6: 1, 7: 0})
    approx_map(as_map(k_betweenness(demo, 3)),
               {1: 0, 2: 4.666667, 3: 0, 4: 5.333333, 5: 10.333333, 6: 1.666667, 7: 0})


def test_k_hop(demo):
    rows = {(r.root, r.id): r.hop for r in k_hop_neighborhood(demo, 2).collect()}
    assert rows[(1, 1)] == 0 and rows[(1, 2)] == 1 and rows[(1, 5)] == 2
    assert (1, 7) not in rows


SSSP_WEIGHTED = {1: {1: 0, 2: 7, 3: 15, 4: 5, 5: 14, 6: 11, 7: 22}, 2: {2: 0, 3: 8, 4: 9, 5: 7, 6: 15, 7: 16},
                 3: {3: 0, 5: 5, 6: 13, 7: 14}, 4: {4: 0, 5: 15, 6: 6, 7: 17}, 5: {5: 0, 6: 8, 7: 9},
                 6: {6: 0, 7: 11}, 7: {7: 0}}
SSSP_HOPS = {1: {1: 0, 2: 1, 3: 2, 4: 1, 5: 2, 6: 2, 7: 3}, 2: {2: 0, 3: 1, 4: 1, 5: 1, 6: 2, 7: 2},
             3: {3: 0, 5: 1, 6: 2, 7: 2}, 4: {4: 0, 5: 1, 6: 1, 7: 2}, 5: {5: 0, 6: 1, 7: 1}, 6: {6: 0, 7: 1},
             7: {7: 0}}


@pytest.mark.parametrize("weighted,want", [(True, SSSP_WEIGHTED), (False, SSSP_HOPS)])
def test_shortest_paths(spark, demo, weighted, want):
    origins = spark.range(1, 8)
    got = {}
    for r in single_source(demo, origins, weighted).collect():
        got.setdefault(r.origin, {})[r.id] = r.distance
    assert got == want
    # landmark form: distance from id to landmark equals distance from landmark's view
    lm = landmark_distances(demo, spark.range(7, 8), weighted)
    assert {r.id: r.distance for r in lm.collect()} == {s: d[7] for s, d in want.items() if 7 in d}


def test_mean_path_length(spark, demo):
    approx_map(as_map(mean_path_length(demo, spark.range(1, 2), True), key="origin"), {1: 10.571429})
    approx_map(as_map(mean_path_length(demo, spark.range(1, 2), False), key="origin"), {1: 1.571429})


def test_louvain_demo(spark):
    from graphmill.operators.louvain import louvain
    from tests.conftest import DEMO_EDGES
    e = spark.createDataFrame([(a, b) for a, b, _ in DEMO_EDGES], "src long, dst long")
    assign, hist = louvain(e)
    h = [(r.level, round(r.q, 6), r.passes) for r in hist.orderBy("level").collect()]
    assert h == [(0, 0.136364, 3), (1, 0.132231, 1)]
    final = {r.id: r.community for r in assign.where("level = 1").collect()}
    assert final == {1: 1, 2: 1, 3: 6, 4: 1, 5: 6, 6: 6, 7: 6}


def test_louvain_cliques(spark):
    from graphmill.operators.louvain import louvain
    pairs = [(a, b) for a in range(1, 5) for b in range(a + 1, 5)] + \
            [(a, b) for a in range(5, 9) for b in range(a + 1, 9)] + [(4, 5), (9, 10), (9, 11), (10, 11)]
    e = spark.createDataFrame(pairs, "src long, dst long")
    assign, hist = louvain(e)
    h = [(r.level, round(r.q, 6), r.passes) for r in hist.orderBy("level").collect()]
    assert h == [(0, 0.572266, 3), (1, 0.419922, 1)]
    lvl0 = {r.id: r.community for r in assign.where("level = 0").collect()}
    assert lvl0 == {**{i: 2 for i in range(1, 5)}, **{i: 7 for i in range(5, 9)}, **{i: 10 for i in (9, 10, 11)}}
