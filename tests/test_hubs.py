"""Hub adjacency is dealt over salts, and every root counts."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from graphmill.functions.graph import adjacency, simple_undirected
from graphmill.functions.state import Mirrors, StateStore
from graphmill.operators import betweenness as b
from tests.conftest import as_map, edges_df


def test_hub_is_split_and_values_stay(spark, monkeypatch):
    e = edges_df(spark, [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(1, 40)])
    monkeypatch.setattr(b, "HUB_DEGREE", 1000)
    want = [as_map(b.k_betweenness(e, k)) for k in (2, 3)]
    edges = {tuple(r) for r in b.k_hop_edges(e, 2).collect()}
    monkeypatch.setattr(b, "HUB_DEGREE", 8)
    adj, hubs = b._salted(adjacency(simple_undirected(e)), StateStore(spark, "test"))
    assert {tuple(r) for r in hubs.collect()} == {(0, 8)}
    assert adj.where("id = 0").groupBy("salt").count().agg(F.max("count")).first()[0] < 20
    assert [as_map(b.k_betweenness(e, k)) for k in (2, 3)] == want
    assert {tuple(r) for r in b.k_hop_edges(e, 2).collect()} == edges


def test_every_root_has_its_oracle():
    sql = entry.oracle_sql()
    for name in ("k_hop", "k_hop_edges", "k_betweenness_2", "k_betweenness_3"):
        assert name in entry.queries() and "SEMI JOIN seeds" not in sql[name]


def test_lists_meet_instead_of_paths(spark, monkeypatch):
    """A neighbour's list goes along an edge as one row; lists in parts and roots in batches give the same."""
    e = edges_df(spark, [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(1, 30)] + [(70, 71), (71, 72), (72, 73), (73, 70)])
    rows, meet = [], Mirrors.meet

    def counted(self, given):
        out = meet(self, given)
        rows.append(out.count())
        return out

    def results():
        return [as_map(b.k_betweenness(e, k)) for k in (2, 3)] + [sorted(tuple(r) for r in b.k_hop_neighborhood(e, 3).collect())]

    monkeypatch.setattr(Mirrors, "meet", counted)
    want = results()
    assert max(rows) <= 2 * e.count()  # the star alone has 59 * 58 paths of two hops
    monkeypatch.setattr(Mirrors, "meet", meet)
    monkeypatch.setattr(b, "GROUP_ITEMS", 50)
    assert results() == want
    roots = e.selectExpr("explode(array(src, dst)) id").distinct()  # named roots go along paths, row by row
    assert [as_map(b.k_betweenness(e, k, roots=roots)) for k in (2, 3)] == want[:2]
    assert sorted(tuple(r) for r in b.k_hop_neighborhood(e, 3, roots=roots).collect()) == want[2]
