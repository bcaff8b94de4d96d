"""State that follows the frontier: batches, bit sets, logs, contraction, mirrors, and the general operator."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from graphmill.functions.graph import symmetrize, vertices_of
from graphmill.functions.state import DeltaLog, Mirrors, StateStore
from graphmill.operators.betweenness import k_betweenness, k_hop_neighborhood
from graphmill.operators.closeness import closeness
from graphmill.operators.components import connected_components
from graphmill.operators.eigenvector import eigenvector
from graphmill.operators import multi_source
from graphmill.operators.louvain import mostly_near
from graphmill.operators.paths import landmark_distances, reach_counts
from graphmill.operators.propagation import propagate, strong_components
from graphmill.session import free_state
from graphmill.sources import edge_files as io
from tests.conftest import as_map, edges_df


def random_edges(seed, n, m):
    rng = random.Random(seed)
    return sorted({(rng.randrange(n), rng.randrange(n)) for _ in range(m)})


def hops(pairs, v):
    out = {}
    for a, b in pairs:
        out.setdefault(a, []).append(b)
    far, todo = {v: 0}, deque([v])
    while todo:
        x = todo.popleft()
        for y in out.get(x, []):
            if y not in far:
                far[y] = far[x] + 1
                todo.append(y)
    return far


def test_hop_profile_and_closure_against_plain_search(spark):
    pairs = random_edges(1, 600, 2400) + [(9000, 9001), (9001, 9002), (9002, 9000), (9002, 9003), (9004, 9004)]  # over one lane, cycles, a loop
    e = edges_df(spark, pairs)
    ids = {v for p in pairs for v in p}
    far = {v: hops(pairs, v) for v in ids}
    got = {}
    for r in multi_source.hop_profile(e, batch_rows=700).collect():  # several batches
        got.setdefault(r["id"], {})[r["hop"]] = r["targets"]
    want = {v: {h: list(d.values()).count(h) for h in set(d.values())} for v, d in far.items()}
    assert got == want
    assert as_map(reach_counts(e, batch_rows=100), value="reached") == {v: len(d) for v, d in far.items()}
    value = as_map(closeness(e, include_self=False))
    assert value == {v: round((len(d) - 1) / sum(d.values()), 6) if len(d) > 1 else 0.0 for v, d in far.items()}


def test_strong_components_of_cycles_and_chains(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 7), (7, 8), (8, 8), (20, 1)]
    got = as_map(strong_components(edges_df(spark, pairs)), value="component")
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 20: 20}


def test_orientation_of_closeness(spark, demo):
    back = demo.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    assert as_map(closeness(back, orientation="canonical")) == as_map(closeness(demo))
    assert as_map(closeness(demo, orientation="undirected")) == as_map(closeness(symmetrize(demo)))
    with pytest.raises(ValueError, match="orientation"):
        closeness(demo, orientation="sideways")


def test_betweenness_in_batches(spark, monkeypatch):
    e = edges_df(spark, random_edges(3, 130, 300))
    want = as_map(k_betweenness(e, 3))
    every = {tuple(r) for r in k_hop_neighborhood(e, 2).collect()}
    assert as_map(k_betweenness(e, 3, batch_rows=1)) == want  # a slice at a time
    assert {tuple(r) for r in k_hop_neighborhood(e, 2, batch_rows=1).collect()} == every


def test_log_follows_the_frontier(spark):
    path = edges_df(spark, [(i, i + 1) for i in range(9)])
    written = []
    append = DeltaLog.append

    def counted(self, rows):
        part, n = append(self, rows)
        written.append(n)
        return part, n

    DeltaLog.append = counted
    try:
        d = landmark_distances(path, spark.range(9, 10))
        assert {r["id"]: r["distance"] for r in d.collect()} == {i: 9.0 - i for i in range(10)}
    finally:
        DeltaLog.append = append
    assert written == [1] * 10 + [0]  # a row a round, whatever is known already


def test_log_compacts_and_keeps_what_stands(spark):
    store = StateStore(spark, "log")
    least, last = DeltaLog(store, "a", ["k"], least="v", parts=3), DeltaLog(store, "b", ["k"], parts=3)
    for r in range(8):
        rows = spark.range(5).select(F.col("id").alias("k"), ((F.col("id") * 7 + r * 5) % 11).alias("v"))
        least.append(rows)
        last.append(rows)
    assert as_map(least.current(), "k", "v") == {k: min((k * 7 + r * 5) % 11 for r in range(8)) for k in range(5)}
    assert as_map(last.current(), "k", "v") == {k: (k * 7 + 35) % 11 for k in range(5)}
    assert len(least._parts) < 3 and least.rows_written < 8 * 5 * 2
    assert DeltaLog(store, "c", ["k"]).append(spark.range(0).select(F.col("id").alias("k")))[1] == 0


def test_long_path_in_few_rounds(spark):
    n = 100_000
    ids = spark.range(n).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    got = connected_components(ids, max_iter=20)
    assert got.agg(F.count(F.lit(1)), F.max("component")).first() == (n + 1, 0)


def test_mirrors_share_out_a_star(spark):
    """A hub with a third of all edges: no bucket of its table has over twice the rows of the median one."""
    star = spark.range(6000).select(F.lit(7).cast("long").alias("id"), (F.col("id") + 10).alias("other"))
    rest = spark.range(12_000).select((F.col("id") % 4000 + 10).alias("id"), (F.col("id") * 3 % 9000).alias("other"))
    store = StateStore(spark, "star")
    m = Mirrors(store, star.unionByName(rest), "star", "id", "other", 64)
    files = sorted(r["n"] for r in m.table.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect())
    assert files[-1] <= 2 * files[len(files) // 2]
    rows = spark.createDataFrame([(7, 1), (11, 2), (99_999, 3)], "id long, v int")
    assert m.meet(rows).groupBy("id").count().orderBy("id").collect() == [(7, 6000), (11, 3)]
    assert m.meet(rows).where("id = 7").select("other").distinct().count() == 6000


def test_propagate_rounds(spark, demo):
    """k rounds of a minimum that counts down: the k-hop neighbourhood of one root."""
    und = symmetrize(demo.select("src", "dst"))
    state = vertices_of(demo).withColumn("far", F.when(F.col("id") == 1, 0))
    for k in (0, 1, 2):
        got = propagate(state, und, {"m": F.col("far") + 1}, {"m": "min"}, {"far": F.coalesce(F.least("far", "m"), "m")}, start=F.col("far") == 0, rounds=k)
        want = {r["id"]: r["hop"] for r in k_hop_neighborhood(demo, k).where("root = 1").collect()}
        assert {r["id"]: r["far"] for r in got.where("far is not null").collect()} == want
    halted = propagate(state, und, {"m": F.col("far") + 1}, {"m": "min"}, {"far": F.coalesce(F.least("far", "m"), "m")}, start=F.col("far") == 0, halt=F.col("far") >= 1)
    assert {r["far"] for r in halted.collect()} == {0, 1, None}
    with pytest.raises(ValueError, match="names clash"):
        propagate(state, und.withColumn("far", F.lit(1)), {"m": F.col("far")}, {"m": "min"}, {"far": F.col("m")})


def test_eigenvector_says_whether_it_converged(spark, demo):
    _, converged, rounds = eigenvector(demo, max_iter=3, with_status=True)
    assert not converged and rounds == 4
    value, converged, rounds = eigenvector(symmetrize(demo), max_iter=100, with_status=True)
    assert converged and rounds < 101
    assert as_map(value) == as_map(eigenvector(symmetrize(demo), num_iter=rounds))


def test_permissive_reading(spark, tmp_path):
    (tmp_path / "w").write_text("# head\n1\t2\t3.5\n\n2\t3\n4\tx\t1\n5 6 7\n7\t8\t1\t9\n8\t9\t2\n")
    (tmp_path / "e").write_text("1 2\n# no\n3\n\n4 5 extra\na b\n")
    edges, seen = io.drop_corrupt(io.read_weighted_edge_list(spark, str(tmp_path / "w"), mode="permissive"))
    assert sorted(tuple(r) for r in edges.collect()) == [(1, 2, 3.5), (8, 9, 2.0)] and seen.get["dropped"] == 4
    edges, seen = io.drop_corrupt(io.read_edge_list(spark, str(tmp_path / "e"), mode="permissive"))
    assert sorted(tuple(r) for r in edges.collect()) == [(1, 2, 1.0), (4, 5, 1.0)] and seen.get["dropped"] == 2
    for read, name in ((io.read_weighted_edge_list, "w"), (io.read_edge_list, "e")):
        with pytest.raises(Exception, match="malformed"):
            read(spark, str(tmp_path / name)).collect()
    with pytest.raises(ValueError, match="mode"):
        io.read_edge_list(spark, str(tmp_path / "e"), mode="lenient")


def test_state_is_freed(spark, tmp_path):
    free_state(spark)
    store = StateStore(spark, "freed")
    store.save(spark.range(3), "a")
    table = store.save_bucketed(spark.range(3), "b", ["id"])
    assert table.count() == 3 and free_state(spark) >= 2 and free_state(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(store.base).count()


def test_scoring_all_where_most_hear_of_a_change():
    assert mostly_near(30, 1000, 29) and not mostly_near(20, 1000, 29) and not mostly_near(0, 1000, 29) and not mostly_near(0, 0, 0)
    assert mostly_near(1000, 1000, 0.5)
