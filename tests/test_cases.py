"""Hand cases, properties and brute-force checks."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from graphmill.functions.graph import (adjacency, aggregate_messages, canonical, degrees, make_graph,
                                       merge_edges, symmetrize, triplets, vertices_of)
from graphmill.operators.betweenness import dependencies, k_betweenness, k_hop_edges
from graphmill.operators.components import connected_components, ego_circles
from graphmill.operators.degree import degree_centrality
from graphmill.operators.louvain import compress_labelled, modularity
from graphmill.operators.pagerank import pagerank
from graphmill.operators.paths import all_pairs, reachable
from graphmill.operators.triangles import local_clustering, triangle_count, triangles
from tests.conftest import as_map, edges_df


def test_self_loop_parallel_and_reversed_edges(spark):
    e = edges_df(spark, [(1, 1), (1, 2), (1, 2), (2, 1), (2, 3), (3, 1)])
    assert as_map(degrees(e, "all"), value="degree") == {1: 6, 2: 4, 3: 2}
    # triangles use the simple graph: {1,2,3} once
    assert as_map(triangle_count(e), value="triangles") == {1: 1, 2: 1, 3: 1}
    # multigraph degree in the clustering denominator (parity): d(1) = 6 -> 1/15
    assert as_map(local_clustering(e))[1] == pytest.approx(1 / 15, abs=1e-6)
    assert as_map(local_clustering(e, degree="simple"))[1] == pytest.approx(1.0)
    assert sorted(tuple(r) for r in adjacency(e).collect()) == [
        (1, 1), (1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2)]
    assert sorted(tuple(r) for r in merge_edges(e).collect()) == [
        (1, 1, 1.0), (1, 2, 2.0), (2, 1, 1.0), (2, 3, 1.0), (3, 1, 1.0)]


def test_degree_single_vertex_and_zero_degrees(spark):
    e = edges_df(spark, [(5, 5)])
    assert as_map(degree_centrality(e, "all")) == {5: None}
    e2 = edges_df(spark, [(1, 2), (1, 3)])
    assert as_map(degree_centrality(e2, "in", include_zero=True)) == {1: 0.0, 2: 0.5, 3: 0.5}


def test_reachability_on_cycle_terminates(spark):
    e = edges_df(spark, [(1, 2), (2, 3), (3, 1), (3, 4)])
    got = sorted(tuple(r) for r in reachable(e).collect())
    want = sorted([(a, b) for a in (1, 2, 3) for b in (1, 2, 3, 4)] + [(4, 4)])
    assert got == want


def test_components_long_path_and_star(spark):
    ids = list(range(1, 51))
    random.Random(7).shuffle(ids)
    path = edges_df(spark, list(zip(ids, ids[1:])))
    comp = as_map(connected_components(path), value="component")
    assert set(comp.values()) == {1} and len(comp) == 50
    star = edges_df(spark, [(0, i) for i in range(1, 1001)] + [(2000, 2001)])
    comp = as_map(connected_components(star), value="component")
    assert comp[777] == 0 and comp[2001] == 2000 and len(comp) == 1003
    assert triangles(star).count() == 0
    assert as_map(degree_centrality(star, "out"))[0] == pytest.approx(1000 / 1002, abs=1e-6)


def test_ego_circles_text(spark):
    ego = spark.createDataFrame([(5, 3, 1), (5, 1, 2), (5, 9, 9), (6, 4, 4)], "ego_id long, src long, dst long")
    assert as_map(ego_circles(ego), key="ego_id", value="circles") == {5: "1 2 3;9", 6: "4"}


def test_triangle_identity_and_symmetric_apsp(spark, demo):
    t = triangles(demo).count()
    assert triangle_count(demo).agg(F.sum("triangles")).first()[0] == 3 * t
    d = {(r.id, r.landmark): r.distance for r in all_pairs(symmetrize(demo)).collect()}
    assert all(d[(b, a)] == v for (a, b), v in d.items())


def _brandes(adj, k=None):
    bc = {v: 0.0 for v in adj}
    for s in adj:
        dist, sigma, order, preds = {s: 0}, {s: 1.0}, [], {v: [] for v in adj}
        q = deque([s])
        while q:
            v = q.popleft()
            order.append(v)
            for w in adj[v]:
                if w not in dist:
                    if k is not None and dist[v] + 1 > k:
                        continue
                    dist[w] = dist[v] + 1
                    sigma[w] = 0.0
                    q.append(w)
                if dist.get(w) == dist[v] + 1:
                    sigma[w] += sigma[v]
                    preds[w].append(v)
        delta = {v: 0.0 for v in order}
        for w in reversed(order):
            for v in preds[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                bc[w] += delta[w]
    return bc


@pytest.mark.parametrize("k", [2, 3, 10])
def test_k_betweenness_against_brute_force(spark, k):
    rnd = random.Random(11)
    pairs = {(rnd.randint(1, 25), rnd.randint(1, 25)) for _ in range(60)}
    e = edges_df(spark, sorted(pairs))
    adj = {}
    for a, b in pairs:
        adj.setdefault(a, set())
        adj.setdefault(b, set())
        if a != b:
            adj[a].add(b)
            adj[b].add(a)
    want = _brandes(adj, k)
    got = as_map(k_betweenness(e, k))
    assert set(got) == set(want)
    for v in want:
        assert got[v] == pytest.approx(want[v], abs=1e-6)
    if k == 10:  # k beyond the diameter: full (unnormalised, ordered-pair) betweenness
        full = _brandes(adj)
        assert all(got[v] == pytest.approx(full[v], abs=1e-6) for v in full)


def test_k_hop_edges_and_dependencies(spark, demo):
    rows = {(r.src, r.dst) for r in k_hop_edges(demo, 1).where("root = 1").collect()}
    assert rows == {(1, 2), (1, 4)}
    assert dependencies(demo, 1).count() == 0


def test_modularity_single_community_and_compress_preserves_weight(spark, demo):
    labels = vertices_of(demo).select("id", F.lit(1).cast("long").alias("label"))
    q = modularity(demo, labels).first()
    assert q.q_unclamped == pytest.approx(0.0, abs=1e-12)
    per = vertices_of(demo).select("id", (F.col("id") % 3).alias("label"))
    v, e = compress_labelled(demo, per)
    total = v.agg(F.sum(F.col("internal_weight") + F.col("node_weight"))).first()[0]
    assert total == 2 * demo.count()
    assert e.agg(F.sum("weight")).first()[0] * 2 + v.agg(F.sum("internal_weight")).first()[0] == total


def test_pagerank_is_partition_invariant(spark, demo):
    a = as_map(pagerank(demo, num_iter=4))
    b = as_map(pagerank(demo.repartition(7), num_iter=4))
    assert a == b


def test_triplets_aggregate_messages_make_graph(spark, demo):
    v = spark.createDataFrame([(i, float(i)) for i in range(1, 8)], "id long, x double")
    t = triplets(demo, v, ["x"]).where("src = 1 AND dst = 2").first()
    assert (t.src_x, t.dst_x) == (1.0, 2.0)
    m = aggregate_messages(demo, v, to_src=None, to_dst={"s": F.col("src_x") * F.col("weight")},
                           agg={"s": "sum"}, attrs=["x"])
    assert as_map(m, value="s")[5] == pytest.approx(2 * 7 + 3 * 5 + 4 * 15, abs=1e-6)
    g = make_graph(spark.createDataFrame([(1, 9.0), (99, 1.0)], "id long, x double"), demo, {"x": 0.0})
    assert as_map(g, value="x") == {1: 9.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 0.0, 6: 0.0, 7: 0.0, 99: 1.0}
    assert canonical(edges_df(spark, [(3, 1)])).first()[:2] == (1, 3)


def test_louvain_state_text_and_level_sink(spark, demo):
    import tempfile
    from graphmill.operators.louvain import init_state, louvain_edges, render_state, save_levels, louvain
    state, _ = init_state(louvain_edges(demo))
    txt = as_map(render_state(state), value="text")
    assert txt[1] == "{community:1,communitySigmaTot:2,internalWeight:0,nodeWeight:2}"
    assign, hist = louvain(demo)
    d = tempfile.mkdtemp(dir="/tmp")
    save_levels(assign, hist, d)
    assert spark.read.parquet(f"{d}/levels").count() == 14
    assert spark.read.parquet(f"{d}/qvalues").count() == 2


def test_bucketed_edges_are_not_reshuffled(spark):
    import contextlib
    import io as _io
    from graphmill.functions.state import StateStore
    store = StateStore(spark, "plan-test")
    e = store.save_bucketed(edges_df(spark, [(i, i % 7) for i in range(200)]), "edges", ["dst"])
    front = spark.range(10).select(F.col("id").alias("dst"), F.lit(0.0).alias("distance"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buf = _io.StringIO()
        with contextlib.redirect_stdout(buf):
            front.join(e, "dst").explain()
        plan = buf.getvalue()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1   # only the frontier moves
