"""Inputs that must not be narrowed silently, and empty inputs."""

import pytest

from graphmill.functions.graph import symmetrize
from graphmill.operators import louvain as lv
from graphmill.operators.betweenness import k_betweenness, k_hop_edges, k_hop_neighborhood
from graphmill.operators.closeness import closeness
from graphmill.operators.components import connected_components
from graphmill.operators.degree import degree_centrality
from graphmill.operators.eigenvector import eigenvector
from graphmill.operators.pagerank import pagerank
from graphmill.operators.paths import all_pairs, landmark_distances, mean_path_length, reachable, single_source
from graphmill.operators.triangles import local_clustering, triangle_count


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def test_fractional_or_null_weight_fails(spark):
    for w in (0.9, None):
        e = spark.createDataFrame([(1, 2, 1.0), (2, 3, w)], "src long, dst long, weight double")
        with pytest.raises(Exception, match="whole weights"):
            lv.louvain_edges(e, "weight").collect()


def test_missing_or_second_label_fails(spark, demo):
    some = [(i, i % 2) for i in range(1, 7)]
    for rows, message in ((some, "no label"), (some + [(7, 1), (7, 0)], "several labels")):
        labels = spark.createDataFrame(rows, "id long, label long")
        with pytest.raises(Exception, match=message):
            lv.modularity(demo, labels, "weight").collect()


def test_level_that_does_not_end_fails(spark, demo):
    from graphmill.functions.state import StateStore

    state, e = lv.init_state(lv.louvain_edges(demo))
    with pytest.raises(RuntimeError, match="hasn't ended"):
        lv.louvain_level(state, e, 22, StateStore(spark, "t"), max_passes=1)


def test_unweighted_paths_need_no_weight(spark, demo):
    got = {r["id"]: r["distance"] for r in single_source(demo.select("src", "dst"), ids(spark, 1), weighted=False).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: 1, 5: 2, 6: 2, 7: 3}


def test_seeded_variants_agree_with_all(spark, demo):
    want = {(r["id"], r["landmark"], r["distance"]) for r in all_pairs(demo).collect() if r["landmark"] in (5, 7)}
    assert {(r["id"], r["landmark"], r["distance"]) for r in landmark_distances(demo, ids(spark, 5, 7)).collect()} == want
    near = {r["id"]: r["value"] for r in closeness(demo, targets=ids(spark, 5, 7)).collect()}
    assert near[1] == 1 / 2.5 and near[7] == 0.0
    assert {(r["id"], r["reachable"]) for r in reachable(demo, sources=ids(spark, 5)).collect()} == {(5, 5), (5, 6), (5, 7)}
    every = {tuple(r) for r in k_hop_neighborhood(demo, 2).collect()}
    assert {tuple(r) for r in k_hop_neighborhood(demo, 2, roots=ids(spark, 3)).collect()} == {x for x in every if x[0] == 3}
    total = {}
    for v in range(1, 8):
        for r in k_betweenness(demo, 3, roots=ids(spark, v)).collect():
            total[r["id"]] = total.get(r["id"], 0.0) + r["value"]
    assert {k: round(v, 6) for k, v in total.items()} == {r["id"]: round(r["value"], 6) for r in k_betweenness(demo, 3).collect()}


@pytest.mark.parametrize("op", [
    lambda e, v: degree_centrality(e), lambda e, v: pagerank(e, tol=1e-3), lambda e, v: pagerank(e, num_iter=2, normalize=True),
    lambda e, v: eigenvector(e), lambda e, v: closeness(e), lambda e, v: all_pairs(symmetrize(e)), lambda e, v: mean_path_length(e, v),
    lambda e, v: reachable(e), lambda e, v: k_betweenness(e, 2), lambda e, v: k_hop_edges(e, 2), lambda e, v: triangle_count(e),
    lambda e, v: local_clustering(e), lambda e, v: connected_components(e)], ids=str)
def test_empty_graph(spark, op):
    e = spark.createDataFrame([], "src long, dst long, weight double")
    assert op(e, spark.createDataFrame([], "id long")).count() == 0
