"""Registry of checked queries: Spark plans over the test tables and their DuckDB twins.

Every query reads the parquet tables of one scale factor, projects a graph
with :mod:`graphmill.plans.graphs` and runs one operator over the whole
graph.  ``ORACLE`` holds, per query, the same computation as DuckDB SQL over
the same tables (views ``lineitem``, ``orders``, ``supplier``, ...).
Floating results whose value depends on summation order are rounded to six
decimals on both sides; exact ones are left as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.functions.graph import (adjacency, aggregate_messages, canonical, merge_edges, symmetrize,
                                       triplets, vertices_of)
from graphmill.functions.state import StateStore
from graphmill.operators.betweenness import k_betweenness, k_hop_edges, k_hop_neighborhood
from graphmill.operators.closeness import closeness
from graphmill.operators.components import connected_components, ego_circles, ego_components
from graphmill.operators.degree import degree_centrality
from graphmill.operators.eigenvector import eigenvector
from graphmill.operators.delta_stepping import delta_stepping
from graphmill.operators import louvain as lv
from graphmill.operators.pagerank import pagerank
from graphmill.operators.multi_source import path_summary
from graphmill.operators.paths import landmark_distances, mean_path_length, reach_counts, reachable, single_source
from graphmill.operators.propagation import propagate
from graphmill.operators.triangles import local_clustering, triangle_count
from graphmill.plans import graphs as G
from graphmill.session import state_root
from graphmill.sources import edge_files as io

# Fixed values of the checked queries.
PAGERANK_ROUNDS = 10
PAGERANK_TOL = 1e-4
EIGEN_ROUNDS = 5
EIGEN_MAX_ITER = 100
KHOP_K = 2

Query = Callable[[SparkSession, str], DataFrame]


def _r6(c: str):
    return F.round(F.col(c), 6).alias(c)


# --------------------------------------------------------------------------- graph views

def _part(spark, sf):
    return G.part_graph(spark, sf)


def _kept_part(spark, sf):
    """The part graph as a table, for operators that read their edges more than once."""
    return StateStore(spark, "part-graph").save(_part(spark, sf), "edges")


def _scratch(spark: SparkSession, tag: str) -> str:
    return f"{state_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


# --------------------------------------------------------------------------- Spark side

def q_degree_in(spark, sf):
    return degree_centrality(canonical(_part(spark, sf)), "in")


def q_degree_out(spark, sf):
    return degree_centrality(canonical(_part(spark, sf)), "out")


def q_degree_all(spark, sf):
    return degree_centrality(canonical(_part(spark, sf)), "all")


def q_edge_merge(spark, sf):
    return merge_edges(canonical(_part(spark, sf)))


def q_adjacency(spark, sf):
    return adjacency(_part(spark, sf))


def q_triplets(spark, sf):
    return triplets(_part(spark, sf), G.part_sizes(spark, sf), ["label"])


def q_aggregate_messages(spark, sf):
    return aggregate_messages(
        _part(spark, sf), G.part_sizes(spark, sf),
        to_src={"weight_sum": F.col("weight"), "max_nbr_label": F.col("dst_label")},
        to_dst={"weight_sum": F.col("weight"), "max_nbr_label": F.col("src_label")},
        agg={"weight_sum": "sum", "max_nbr_label": "max"}, attrs=["label"])


def q_triangle_count(spark, sf):
    return triangle_count(_part(spark, sf))


def q_clustering_coef(spark, sf):
    return local_clustering(_part(spark, sf))


def q_pagerank_10(spark, sf):
    return pagerank(_kept_part(spark, sf), num_iter=PAGERANK_ROUNDS).select("id", _r6("value"))


def q_pagerank_tol(spark, sf):
    return pagerank(_kept_part(spark, sf), tol=PAGERANK_TOL).select("id", _r6("value"))


def q_eigenvector_5(spark, sf):
    return eigenvector(_kept_part(spark, sf), num_iter=EIGEN_ROUNDS).select("id", _r6("value"))


def q_eigenvector_tol(spark, sf):
    return eigenvector(_kept_part(spark, sf), max_iter=EIGEN_MAX_ITER).select("id", _r6("value"))


def q_closeness(spark, sf):
    return closeness(_kept_part(spark, sf), orientation="canonical")


def q_closeness_to_seeds(spark, sf):
    return closeness(canonical(_kept_part(spark, sf)), targets=G.seed_parts(spark, sf))


def q_hop_summary(spark, sf):
    return path_summary(_kept_part(spark, sf)).select("id", "reached", _r6("mean"), "eccentricity")


def q_reach_counts(spark, sf):
    return reach_counts(canonical(_kept_part(spark, sf)))


def q_reach_counts_cyclic(spark, sf):
    return reach_counts(_kept_part(spark, sf))


def q_propagate_hops(spark, sf):
    e = _kept_part(spark, sf)
    ids = vertices_of(e)
    origin = ids.agg(F.min("id").alias("origin"))
    state = ids.join(F.broadcast(origin), ids["id"] == origin["origin"], "left").select("id", F.when(F.col("origin").isNotNull(), 0).cast("long").alias("hops"))
    out = propagate(state, e.select("src", "dst"), send={"sent": F.col("hops") + 1}, merge={"sent": "min"},
                    update={"hops": F.coalesce(F.least("hops", "sent"), "sent")}, start=F.col("hops") == 0)
    return out.where("hops is not null")


def q_seed_hops(spark, sf):
    return landmark_distances(symmetrize(_kept_part(spark, sf)), G.seed_parts(spark, sf))


def q_landmark_hops(spark, sf):
    return landmark_distances(_kept_part(spark, sf), G.seed_parts(spark, sf), weighted=False)


def q_landmark_weighted(spark, sf):
    return landmark_distances(_kept_part(spark, sf), G.seed_parts(spark, sf), weighted=True)


def q_landmark_delta(spark, sf):
    return delta_stepping(_kept_part(spark, sf), G.seed_parts(spark, sf))


def q_sssp_mean(spark, sf):
    e = _kept_part(spark, sf)
    origin = vertices_of(e).agg(F.min("id").alias("id"))
    return mean_path_length(e, origin, weighted=True)


def q_sssp_distances(spark, sf):
    e = _kept_part(spark, sf)
    origin = vertices_of(e).agg(F.min("id").alias("id"))
    return single_source(e, origin, weighted=True)


def q_k_hop_edges(spark, sf):
    return k_hop_edges(_kept_part(spark, sf), KHOP_K)


def q_ego_components(spark, sf):
    return ego_components(G.customer_ego_nets(spark, sf))


def q_reachable(spark, sf):
    return reachable(canonical(_kept_part(spark, sf)), sources=G.seed_parts(spark, sf))


def q_k_hop(spark, sf):
    return k_hop_neighborhood(_kept_part(spark, sf), KHOP_K)


def q_k_betweenness_2(spark, sf):
    return k_betweenness(_kept_part(spark, sf), 2).select("id", _r6("value"))


def q_k_betweenness_3(spark, sf):
    return k_betweenness(_kept_part(spark, sf), 3).select("id", _r6("value"))


def q_connected_components(spark, sf):
    return connected_components(_kept_part(spark, sf))


def q_ego_circles(spark, sf):
    return ego_circles(G.customer_ego_nets(spark, sf))


def _louvain_part(spark, sf):
    return lv.louvain_edges(_kept_part(spark, sf), "weight")


def q_louvain_init(spark, sf):
    state, _ = lv.init_state(_louvain_part(spark, sf))
    return state.select(*lv.STATE_COLS)


def q_louvain_first_move(spark, sf):
    state, e = lv.init_state(_louvain_part(spark, sf))
    m = state.agg(F.sum("node_weight")).first()[0]
    return lv.half_cycle(state, e, m, even=True).select(*lv.STATE_COLS)


def q_louvain_level(spark, sf):
    state, e = lv.init_state(_louvain_part(spark, sf))
    store = StateStore(spark, "louvain-level")
    e, state = store.save(e, "edges"), store.save(state, "state")
    m = state.agg(F.sum("node_weight")).first()[0]
    _, state, _ = lv.louvain_level(state, e, m, store)
    return state.select("id", "community", "sigma_tot")


def q_louvain(spark, sf):
    assign, _ = lv.louvain(_kept_part(spark, sf), weight="weight")
    last = assign.agg(F.max("level")).first()[0]
    return assign.where(F.col("level") == last).select("id", "community")


def q_louvain_levels(spark, sf):
    _, hist = lv.louvain(_kept_part(spark, sf), weight="weight")
    return hist.select("level", _r6("q"), "passes")


def q_modularity_by_size(spark, sf):
    return lv.modularity(_kept_part(spark, sf), G.part_sizes(spark, sf), weight="weight").select(
        _r6("q"), _r6("q_unclamped"))


def q_compress_by_size_vertices(spark, sf):
    v, _ = lv.compress_labelled(_kept_part(spark, sf), G.part_sizes(spark, sf), weight="weight")
    return v


def q_compress_by_size_edges(spark, sf):
    _, e = lv.compress_labelled(_kept_part(spark, sf), G.part_sizes(spark, sf), weight="weight")
    return e


def q_edge_list_roundtrip(spark, sf):
    path = _scratch(spark, "edge-list")
    io.write_edge_list(_part(spark, sf), path)
    return io.read_edge_list(spark, path, canonical=True)


def q_weighted_edge_list_roundtrip(spark, sf):
    path = _scratch(spark, "weighted-edge-list")
    io.write_edge_list(_part(spark, sf), path, weighted=True)
    return io.read_weighted_edge_list(spark, path)


def q_permissive_roundtrip(spark, sf):
    """A weighted edge list with a line of words for each part in it, read permissively, with the number of lines dropped."""
    path = _scratch(spark, "mixed-edge-list")
    io.write_edge_list(_part(spark, sf), f"{path}/edges", weighted=True)
    G.table(spark, sf, "part").select(F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_type").alias("value")).write.text(f"{path}/words")
    edges, seen = io.drop_corrupt(io.read_weighted_edge_list(spark, f"{path}/*", mode="permissive"))
    edges = StateStore(spark, "permissive").save(edges, "edges")
    return edges.withColumn("dropped", F.lit(seen.get["dropped"]).cast("long"))


def q_ego_nets_roundtrip(spark, sf):
    path = _scratch(spark, "ego-nets")
    io.write_ego_nets(G.customer_ego_nets(spark, sf), path)
    return io.read_ego_nets(spark, path)


def q_graph_roundtrip(spark, sf):
    """Vertices and edges written as a graph, read back and joined."""
    path = _scratch(spark, "graph")
    io.write_graph(G.part_sizes(spark, sf), _part(spark, sf), path)
    return triplets(spark.read.parquet(f"{path}/edges"), spark.read.parquet(f"{path}/vertices"), ["label"])


def q_vertices_roundtrip(spark, sf):
    path = _scratch(spark, "vertices")
    io.write_vertices(degree_centrality(canonical(_part(spark, sf)), "all"), path)
    return spark.read.parquet(path)


QUERIES: dict[str, Query] = {
    "degree_in": q_degree_in,
    "degree_out": q_degree_out,
    "degree_all": q_degree_all,
    "edge_merge": q_edge_merge,
    "adjacency": q_adjacency,
    "triplets": q_triplets,
    "aggregate_messages": q_aggregate_messages,
    "triangle_count": q_triangle_count,
    "clustering_coef": q_clustering_coef,
    "pagerank_10": q_pagerank_10,
    "pagerank_tol": q_pagerank_tol,
    "eigenvector_5": q_eigenvector_5,
    "eigenvector_tol": q_eigenvector_tol,
    "closeness": q_closeness,
    "seed_hops": q_seed_hops,
    "landmark_hops": q_landmark_hops,
    "landmark_weighted": q_landmark_weighted,
    "landmark_delta": q_landmark_delta,
    "sssp_mean": q_sssp_mean,
    "sssp_distances": q_sssp_distances,
    "reachable": q_reachable,
    "k_hop": q_k_hop,
    "k_hop_edges": q_k_hop_edges,
    "k_betweenness_2": q_k_betweenness_2,
    "k_betweenness_3": q_k_betweenness_3,
    "closeness_to_seeds": q_closeness_to_seeds,
    "hop_summary": q_hop_summary,
    "reach_counts": q_reach_counts,
    "reach_counts_cyclic": q_reach_counts_cyclic,
    "propagate_hops": q_propagate_hops,
    "connected_components": q_connected_components,
    "ego_circles": q_ego_circles,
    "ego_components": q_ego_components,
    "louvain_init": q_louvain_init,
    "louvain_first_move": q_louvain_first_move,
    "louvain_level": q_louvain_level,
    "louvain": q_louvain,
    "louvain_levels": q_louvain_levels,
    "modularity_by_size": q_modularity_by_size,
    "compress_by_size_vertices": q_compress_by_size_vertices,
    "compress_by_size_edges": q_compress_by_size_edges,
    "edge_list_roundtrip": q_edge_list_roundtrip,
    "weighted_edge_list_roundtrip": q_weighted_edge_list_roundtrip,
    "permissive_roundtrip": q_permissive_roundtrip,
    "ego_nets_roundtrip": q_ego_nets_roundtrip,
    "graph_roundtrip": q_graph_roundtrip,
    "vertices_roundtrip": q_vertices_roundtrip,
}


# --------------------------------------------------------------------------- DuckDB side

_W = G.with_sql
_P = G.PART_GRAPH_SQL
_CANON = """
  c AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, weight FROM g_part)"""
_SIMPLE = """
  s AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM g_part WHERE src <> dst),
  adj AS (SELECT a AS id, b AS nbr FROM s UNION ALL SELECT b, a FROM s)"""
_V = """
  v AS (SELECT src AS id FROM g_part UNION SELECT dst FROM g_part),
  nv AS (SELECT count(*) AS n FROM v)"""


def _degree_sql(expr: str) -> str:
    return _W(_P, _CANON, _V) + f"""
SELECT id, count(*) / (SELECT n - 1 FROM nv) AS value FROM ({expr}) GROUP BY id"""


def _pagerank_rounds_sql(rounds: int) -> str:
    ctes = [_P, _V, """
  od AS (SELECT src, count(*) AS od FROM g_part GROUP BY src),
  es AS (SELECT g.src, g.dst, 1.0::DOUBLE / od.od AS sh FROM g_part g JOIN od USING (src)),
  r0 AS (SELECT id, 0.15::DOUBLE AS x FROM v)"""]
    for i in range(1, rounds + 1):
        ctes.append(f"""
  r{i} AS (SELECT v.id, 0.15 + 0.85 * coalesce(m.s, 0.0) AS x FROM v LEFT JOIN
           (SELECT es.dst AS id, sum(r.x * es.sh) AS s FROM es JOIN r{i - 1} r ON r.id = es.src GROUP BY 1) m
           USING (id))""")
    return _W(*ctes) + f"\nSELECT id, round(x, 6) AS value FROM r{rounds}"


def _eigen_rounds_sql(rounds: int) -> str:
    ctes = [_P, _V, """
  e AS (SELECT src, dst, count(*)::DOUBLE AS w FROM g_part GROUP BY 1, 2),
  x0 AS (SELECT id, 1.0::DOUBLE / (SELECT n FROM nv) AS x FROM v)"""]
    for i in range(1, rounds + 1):
        ctes.append(f"""
  y{i} AS (SELECT p.id, p.x + coalesce(m.s, 0.0) AS y FROM x{i - 1} p LEFT JOIN
           (SELECT e.dst AS id, sum(q.x * e.w) AS s FROM e JOIN x{i - 1} q ON q.id = e.src GROUP BY 1) m
           USING (id)),
  x{i} AS (SELECT id, y / (SELECT CASE WHEN sqrt(sum(y * y)) = 0 THEN 1.0 ELSE sqrt(sum(y * y)) END
                           FROM y{i}) AS x FROM y{i})""")
    return _W(*ctes) + f"\nSELECT id, round(x, 6) AS value FROM x{rounds}"


def _dist_sql(edges_cte: str, seeds: str, weight: str) -> str:
    """Recursive CTE ``d(id, landmark, distance)``: least path weight from id to landmark."""
    return f"""{edges_cte},
  d(id, landmark, distance) USING KEY (id, landmark) AS (
    {seeds}
    UNION
    (SELECT pe.src, d.landmark, min(d.distance + {weight}) FROM d JOIN pe ON pe.dst = d.id
       LEFT JOIN recurring.d r ON r.id = pe.src AND r.landmark = d.landmark
       GROUP BY pe.src, d.landmark, r.distance
       HAVING r.distance IS NULL OR min(d.distance + {weight}) < r.distance))"""


_LOUVAIN_INIT = """
  e0 AS (SELECT src, dst, CAST(weight AS BIGINT) AS w FROM g_part),
  em AS (SELECT src, dst, CAST(sum(w) AS BIGINT) AS w FROM e0 GROUP BY 1, 2),
  nw AS (SELECT id, CAST(sum(w) AS BIGINT) AS k FROM (SELECT src AS id, w FROM e0 UNION ALL SELECT dst, w FROM e0)
         GROUP BY id),
  st AS (SELECT id, id AS community, k AS sigma_tot, CAST(0 AS BIGINT) AS internal_weight, k AS node_weight,
                false AS changed FROM nw),
  mm AS (SELECT CAST(sum(internal_weight + node_weight) AS BIGINT) AS m FROM st)"""

_LOUVAIN_MOVE = """
  msgs AS (SELECT id, community, sigma_tot, sum(w) AS k_in FROM (
             SELECT em.src AS id, t.community, t.sigma_tot, em.w FROM em JOIN st t ON t.id = em.dst
             UNION ALL
             SELECT em.dst AS id, t.community, t.sigma_tot, em.w FROM em JOIN st t ON t.id = em.src)
           GROUP BY 1, 2, 3),
  cand AS (SELECT g.id, g.community AS cand, g.sigma_tot AS csig,
             CASE WHEN g.community = t.community AND g.sigma_tot - (t.node_weight + t.internal_weight) = 0
                  THEN CAST(0 AS HUGEINT)
                  ELSE CAST(g.k_in + CASE WHEN g.community = t.community THEN t.internal_weight ELSE 0 END AS HUGEINT)
                       * (SELECT m FROM mm)
                       - CAST(t.node_weight + t.internal_weight AS HUGEINT)
                       * (g.sigma_tot - CASE WHEN g.community = t.community
                                             THEN t.node_weight + t.internal_weight ELSE 0 END) END AS gain
           FROM msgs g JOIN st t USING (id)),
  best AS (SELECT id, cand, csig FROM (
             SELECT *, row_number() OVER (PARTITION BY id ORDER BY gain DESC, cand DESC) AS rn
             FROM cand WHERE gain > 0) WHERE rn = 1),
  lab AS (SELECT t.id, t.internal_weight, t.node_weight,
                 (b.cand IS NOT NULL AND b.cand <> t.community AND t.community > b.cand) AS mv,
                 t.community, b.cand
          FROM st t JOIN (SELECT DISTINCT id FROM msgs) USING (id) LEFT JOIN best b USING (id)),
  lab2 AS (SELECT id, internal_weight, node_weight, coalesce(mv, false) AS changed,
                  CASE WHEN mv THEN cand ELSE community END AS community FROM lab),
  tot AS (SELECT community, CAST(sum(node_weight + internal_weight) AS BIGINT) AS sigma_tot FROM lab2 GROUP BY 1)"""

_SIZE_STATE = """
  e0 AS (SELECT src, dst, CAST(weight AS BIGINT) AS w FROM g_part),
  nw AS (SELECT id, CAST(sum(w) AS BIGINT) AS k FROM (SELECT src AS id, w FROM e0 UNION ALL SELECT dst, w FROM e0)
         GROUP BY id),
  lab AS (SELECT nw.id, nw.k, n.label FROM nw JOIN sizes n USING (id)),
  sig AS (SELECT label, sum(k) AS sigma FROM lab GROUP BY label),
  mm AS (SELECT sum(k) AS m FROM nw)"""


ORACLE: dict[str, str] = {
    "degree_in": _degree_sql("SELECT dst AS id FROM c"),
    "degree_out": _degree_sql("SELECT src AS id FROM c"),
    "degree_all": _degree_sql("SELECT src AS id FROM c UNION ALL SELECT dst FROM c"),
    "edge_merge": _W(_P, _CANON) + "\nSELECT src, dst, sum(weight) AS weight FROM c GROUP BY 1, 2",
    "adjacency": _W(_P) + "\nSELECT src AS id, dst AS nbr FROM g_part UNION SELECT dst, src FROM g_part",
    "triplets": _W(_P, G.PART_SIZES_SQL) + """
SELECT g.src, g.dst, g.weight, a.label AS src_label, b.label AS dst_label
FROM g_part g LEFT JOIN sizes a ON a.id = g.src LEFT JOIN sizes b ON b.id = g.dst""",
    "aggregate_messages": _W(_P, G.PART_SIZES_SQL) + """
SELECT id, sum(weight) AS weight_sum, max(nl) AS max_nbr_label FROM (
  SELECT g.src AS id, g.weight, b.label AS nl FROM g_part g LEFT JOIN sizes b ON b.id = g.dst
  UNION ALL
  SELECT g.dst AS id, g.weight, a.label AS nl FROM g_part g LEFT JOIN sizes a ON a.id = g.src)
GROUP BY id""",
    "triangle_count": _W(_P, _SIMPLE, _V) + """,
  t AS (SELECT x.a, x.b, y.b AS c FROM s x JOIN s y ON x.b = y.a JOIN s z ON z.a = x.a AND z.b = y.b),
  per AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t)
          GROUP BY id)
SELECT v.id, coalesce(per.n, 0) AS triangles FROM v LEFT JOIN per USING (id)""",
    "clustering_coef": _W(_P, _SIMPLE, _V) + """,
  t AS (SELECT x.a, x.b, y.b AS c FROM s x JOIN s y ON x.b = y.a JOIN s z ON z.a = x.a AND z.b = y.b),
  per AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t)
          GROUP BY id),
  deg AS (SELECT id, count(*) AS d FROM (SELECT src AS id FROM g_part UNION ALL SELECT dst FROM g_part) GROUP BY id)
SELECT v.id, CASE WHEN deg.d < 2 THEN 0.0
                  ELSE coalesce(per.n, 0) / (deg.d * (deg.d - 1) / 2.0) END AS value
FROM v LEFT JOIN per USING (id) LEFT JOIN deg USING (id)""",
    "pagerank_10": _pagerank_rounds_sql(PAGERANK_ROUNDS),
    "pagerank_tol": _W(_P, _V) + f""",
  od AS (SELECT src, count(*) AS od FROM g_part GROUP BY src),
  es AS (SELECT g.src, g.dst, 1.0::DOUBLE / od.od AS sh FROM g_part g JOIN od USING (src)),
  fr(id, delta) AS (
    SELECT id, 0.15::DOUBLE FROM v
    UNION ALL
    SELECT es.dst, 0.85 * sum(fr.delta * es.sh) FROM fr JOIN es ON es.src = fr.id
    WHERE fr.delta > {PAGERANK_TOL} GROUP BY es.dst)
SELECT id, round(sum(delta), 6) AS value FROM fr GROUP BY id""",
    "eigenvector_5": _eigen_rounds_sql(EIGEN_ROUNDS),
    "eigenvector_tol": _W(_P, _V, f"""
  e AS (SELECT src, dst, sum(w) AS w, sum(own) AS own FROM (
          SELECT src, dst, 1.0::DOUBLE AS w, 0.0::DOUBLE AS own FROM g_part
          UNION ALL SELECT id, id, 1.0, 1.0 FROM v) GROUP BY 1, 2),
  x(r, id, x, delta) AS (
    SELECT 0, id, 1.0::DOUBLE / (SELECT n FROM nv), 1e300::DOUBLE FROM v
    UNION ALL
    SELECT r, id, z, sum(abs(z - prev)) OVER () FROM (
      SELECT r, id, prev, y / sqrt(sum(y * y) OVER ()) AS z FROM (
        SELECT x.r + 1 AS r, e.dst AS id, sum(x.x * e.w) AS y, sum(x.x * e.own) AS prev FROM x JOIN e ON e.src = x.id
        WHERE x.r <= {EIGEN_MAX_ITER} AND x.delta >= (SELECT n FROM nv) * 1e-6 GROUP BY 1, 2)))""") + """
SELECT id, round(x, 6) AS value FROM x WHERE r = (SELECT max(r) FROM x)""",
    "closeness": _W(_P, _V, G.SEEDS_SQL, _dist_sql("""
  pe AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM g_part)""",
                                      "SELECT id, id, 0.0::DOUBLE FROM v SEMI JOIN seeds USING (id)", "1.0")) + """
SELECT id, CASE WHEN sum(distance) = 0 THEN 0.0 ELSE 1.0::DOUBLE / (sum(distance) / count(*)) END AS value
FROM d GROUP BY id""",
    "seed_hops": _W(_P, _V, G.SEEDS_SQL, _dist_sql("""
  pe AS (SELECT src, dst FROM g_part UNION SELECT dst, src FROM g_part)""",
                                         "SELECT id, id, 0.0::DOUBLE FROM v SEMI JOIN seeds USING (id)", "1.0")) + """
SELECT id, landmark, distance FROM d""",
    "landmark_hops": _W(_P, _V, G.SEEDS_SQL, _dist_sql("""
  pe AS (SELECT DISTINCT src, dst FROM g_part)""",
                                                        "SELECT id, id, 0.0::DOUBLE FROM v SEMI JOIN seeds USING (id)",
                                                        "1.0")) + """
SELECT id, landmark, distance FROM d""",
    "landmark_weighted": _W(_P, _V, G.SEEDS_SQL, _dist_sql("""
  pe AS (SELECT src, dst, min(weight) AS weight FROM g_part GROUP BY 1, 2)""",
                                                            "SELECT id, id, 0.0::DOUBLE FROM v SEMI JOIN seeds USING (id)",
                                                            "pe.weight")) + """
SELECT id, landmark, distance FROM d""",
    "sssp_mean": _W(_P, _V, _dist_sql("""
  pe AS (SELECT dst AS src, src AS dst, min(weight) AS weight FROM g_part GROUP BY 1, 2)""",
                                    "SELECT min(id), min(id), 0.0::DOUBLE FROM v", "pe.weight")) + """
SELECT landmark AS origin, avg(distance) AS value FROM d GROUP BY landmark""",
    "sssp_distances": _W(_P, _V, _dist_sql("""
  pe AS (SELECT dst AS src, src AS dst, min(weight) AS weight FROM g_part GROUP BY 1, 2)""",
                                         "SELECT min(id), min(id), 0.0::DOUBLE FROM v", "pe.weight")) + """
SELECT landmark AS origin, id, distance FROM d""",
    "k_hop_edges": _W(_P, _SIMPLE, _V, G.SEEDS_SQL) + """,
  near AS (SELECT id AS root, id FROM v SEMI JOIN seeds USING (id) UNION SELECT a.id, a.nbr FROM adj a SEMI JOIN seeds USING (id))
SELECT DISTINCT near.root, s.a AS src, s.b AS dst FROM near JOIN s ON s.a = near.id OR s.b = near.id""",
    "reachable": _W(_P, G.SEEDS_SQL, """
  c AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM g_part),
  v AS (SELECT src AS id FROM g_part UNION SELECT dst FROM g_part),
  r(id, reachable) AS (SELECT id, id FROM v SEMI JOIN seeds USING (id) UNION SELECT r.id, c.dst FROM r JOIN c ON c.src = r.reachable)""") + """
SELECT id, reachable FROM r""",
    "k_hop": _W(_P, _SIMPLE, _V, G.SEEDS_SQL) + """,
  l0 AS (SELECT id AS root, id FROM v SEMI JOIN seeds USING (id)),
  l1 AS (SELECT DISTINCT l0.root, adj.nbr AS id FROM l0 JOIN adj USING (id)),
  l2 AS (SELECT DISTINCT l1.root, adj.nbr AS id FROM l1 JOIN adj USING (id)
         WHERE adj.nbr <> l1.root AND NOT EXISTS (SELECT 1 FROM l1 x WHERE x.root = l1.root AND x.id = adj.nbr))
SELECT root, id, 0 AS hop FROM l0 UNION ALL SELECT root, id, 1 FROM l1 UNION ALL SELECT root, id, 2 FROM l2""",
    "k_betweenness_2": _W(_P, _SIMPLE, _V, G.SEEDS_SQL) + """,
  p2 AS (SELECT x.id AS s, x.nbr AS w, y.nbr AS t FROM (SELECT * FROM adj SEMI JOIN seeds USING (id)) x JOIN adj y ON x.nbr = y.id
         WHERE y.nbr <> x.id AND NOT EXISTS (SELECT 1 FROM adj z WHERE z.id = x.id AND z.nbr = y.nbr)),
  d2 AS (SELECT s, t, count(*) AS sg FROM p2 GROUP BY 1, 2),
  bc AS (SELECT p2.w AS id, sum(1.0::DOUBLE / d2.sg) AS val FROM p2 JOIN d2 USING (s, t) GROUP BY 1)
SELECT v.id, round(coalesce(bc.val, 0.0), 6) AS value FROM v LEFT JOIN bc USING (id)""",
    "k_betweenness_3": _W(_P, _SIMPLE, _V, G.SEEDS_SQL) + """,
  p2 AS (SELECT x.id AS s, x.nbr AS w, y.nbr AS t FROM (SELECT * FROM adj SEMI JOIN seeds USING (id)) x JOIN adj y ON x.nbr = y.id
         WHERE y.nbr <> x.id AND NOT EXISTS (SELECT 1 FROM adj z WHERE z.id = x.id AND z.nbr = y.nbr)),
  d2 AS (SELECT s, t, count(*) AS sg FROM p2 GROUP BY 1, 2),
  p3 AS (SELECT d2.s, d2.t AS b, y.nbr AS t, d2.sg FROM d2 JOIN adj y ON y.id = d2.t
         WHERE y.nbr <> d2.s
           AND NOT EXISTS (SELECT 1 FROM adj z WHERE z.id = d2.s AND z.nbr = y.nbr)
           AND NOT EXISTS (SELECT 1 FROM d2 q WHERE q.s = d2.s AND q.t = y.nbr)),
  d3 AS (SELECT s, t, sum(sg) AS sg FROM p3 GROUP BY 1, 2),
  contrib AS (
    SELECT p2.w AS id, 1.0::DOUBLE / d2.sg AS c FROM p2 JOIN d2 USING (s, t)
    UNION ALL
    SELECT p3.b, p3.sg::DOUBLE / d3.sg FROM p3 JOIN d3 USING (s, t)
    UNION ALL
    SELECT p2.w, 1.0::DOUBLE / d3.sg FROM p3 JOIN p2 ON p2.s = p3.s AND p2.t = p3.b JOIN d3 ON d3.s = p3.s AND d3.t = p3.t),
  bc AS (SELECT id, sum(c) AS val FROM contrib GROUP BY id)
SELECT v.id, round(coalesce(bc.val, 0.0), 6) AS value FROM v LEFT JOIN bc USING (id)""",
    "connected_components": _W(_P, """
  u AS (SELECT src, dst FROM g_part WHERE src <> dst UNION SELECT dst, src FROM g_part WHERE src <> dst),
  v AS (SELECT src AS id FROM g_part UNION SELECT dst FROM g_part),
  cc(id, comp) USING KEY (id) AS (
    SELECT id, id FROM v
    UNION
    (SELECT u.dst, min(cc.comp) FROM cc JOIN u ON u.src = cc.id JOIN recurring.cc r ON r.id = u.dst
     GROUP BY u.dst, r.comp HAVING min(cc.comp) < r.comp))""") + """
SELECT id, comp AS component FROM cc""",
    "ego_circles": _W(G.EGO_NETS_SQL, """
  eu AS (SELECT ego_id, src, dst FROM ego WHERE src <> dst UNION SELECT ego_id, dst, src FROM ego WHERE src <> dst),
  ev AS (SELECT ego_id, src AS id FROM ego UNION SELECT ego_id, dst FROM ego),
  cc(ego_id, id, comp) USING KEY (ego_id, id) AS (
    SELECT ego_id, id, id FROM ev
    UNION
    (SELECT eu.ego_id, eu.dst, min(cc.comp) FROM cc JOIN eu ON eu.ego_id = cc.ego_id AND eu.src = cc.id
       JOIN recurring.cc r ON r.ego_id = eu.ego_id AND r.id = eu.dst
     GROUP BY eu.ego_id, eu.dst, r.comp HAVING min(cc.comp) < r.comp)),
  circ AS (SELECT ego_id, comp, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY id) AS circle FROM cc GROUP BY 1, 2)""") + """
SELECT ego_id, string_agg(circle, ';' ORDER BY comp) AS circles FROM circ GROUP BY ego_id""",
    "ego_components": _W(G.EGO_NETS_SQL, """
  eu AS (SELECT ego_id, src, dst FROM ego WHERE src <> dst UNION SELECT ego_id, dst, src FROM ego WHERE src <> dst),
  ev AS (SELECT ego_id, src AS id FROM ego UNION SELECT ego_id, dst FROM ego),
  cc(ego_id, id, comp) USING KEY (ego_id, id) AS (
    SELECT ego_id, id, id FROM ev
    UNION
    (SELECT eu.ego_id, eu.dst, min(cc.comp) FROM cc JOIN eu ON eu.ego_id = cc.ego_id AND eu.src = cc.id
       JOIN recurring.cc r ON r.ego_id = eu.ego_id AND r.id = eu.dst
     GROUP BY eu.ego_id, eu.dst, r.comp HAVING min(cc.comp) < r.comp))""") + """
SELECT ego_id, id, comp AS component FROM cc""",
    "louvain_init": _W(_P, _LOUVAIN_INIT) + """
SELECT id, community, sigma_tot, internal_weight, node_weight, changed FROM st""",
    "louvain_first_move": _W(_P, _LOUVAIN_INIT, _LOUVAIN_MOVE) + """
SELECT l.id, l.community, t.sigma_tot, l.internal_weight, l.node_weight, l.changed
FROM lab2 l JOIN tot t USING (community)""",
    "louvain_level": _W(_P, _LOUVAIN_INIT) + """,
  pairs AS (SELECT src AS id, dst AS nbr, w FROM em UNION ALL SELECT dst, src, w FROM em),
  lv(h, id, community, sigma, pm, prior, stalls, fin) AS (
    SELECT 0, id, id, CAST(k AS HUGEINT), CAST(0 AS HUGEINT), CAST(0 AS HUGEINT), 0, false FROM nw
    UNION ALL
    SELECT h + 1, id, c, sum(k) OVER (PARTITION BY c), pm, CASE WHEN h % 2 = 1 THEN pm ELSE prior END,
           stalls + CASE WHEN h % 2 = 1 AND pm >= prior - 1 THEN 1 ELSE 0 END,
           h % 2 = 1 AND (pm = 0 OR stalls + CASE WHEN pm >= prior - 1 THEN 1 ELSE 0 END > 1)
    FROM (SELECT h, id, k, prior, stalls, CASE WHEN mv THEN b ELSE community END AS c,
                 CASE WHEN h % 2 = 1 THEN pm ELSE 0 END + sum(CASE WHEN mv THEN 1 ELSE 0 END) OVER () AS pm
          FROM (SELECT o.*, nw.k, best.b,
                       coalesce(CASE WHEN o.h % 2 = 0 THEN o.community > best.b ELSE o.community < best.b END, false) AS mv
                FROM lv o JOIN nw ON nw.id = o.id LEFT JOIN (
                  SELECT id, arg_max(cand, (gain, cand)) FILTER (gain > 0) AS b FROM (
                    SELECT g.id, g.cand, CASE WHEN g.cand = own.community AND g.sigma = kk.k THEN CAST(0 AS HUGEINT)
                             ELSE CAST(g.k_in AS HUGEINT) * (SELECT m FROM mm) - CAST(kk.k AS HUGEINT)
                                  * (g.sigma - CASE WHEN g.cand = own.community THEN kk.k ELSE 0 END) END AS gain
                    FROM (SELECT p.id, n.community AS cand, n.sigma, sum(p.w) AS k_in FROM pairs p JOIN lv n ON n.id = p.nbr
                          GROUP BY 1, 2, 3) g JOIN lv own ON own.id = g.id JOIN nw kk ON kk.id = g.id) GROUP BY id
                  ) best ON best.id = o.id
                WHERE NOT o.fin)))
SELECT id, community, CAST(sigma AS BIGINT) AS sigma_tot FROM lv WHERE fin""",
    "modularity_by_size": _W(_P, G.PART_SIZES_SQL, _SIZE_STATE) + """,
  kin AS (SELECT id, sum(w) AS k_own FROM (
            SELECT e0.src AS id, e0.w FROM e0 JOIN lab a ON a.id = e0.src JOIN lab b ON b.id = e0.dst
            WHERE a.label = b.label
            UNION ALL
            SELECT e0.dst AS id, e0.w FROM e0 JOIN lab a ON a.id = e0.src JOIN lab b ON b.id = e0.dst
            WHERE a.label = b.label) GROUP BY id),
  terms AS (SELECT coalesce(kin.k_own, 0)::DOUBLE / (SELECT m FROM mm)
                   - (sig.sigma::DOUBLE * lab.k::DOUBLE) / power((SELECT m FROM mm)::DOUBLE, 2) AS q
            FROM lab JOIN sig USING (label) LEFT JOIN kin USING (id))
SELECT round(sum(greatest(q, 0.0)), 6) AS q, round(sum(q), 6) AS q_unclamped FROM terms""",
    "compress_by_size_vertices": _W(_P, G.PART_SIZES_SQL, _SIZE_STATE) + """,
  ce AS (SELECT e0.w, a.label AS cs, b.label AS cd FROM e0 JOIN lab a ON a.id = e0.src JOIN lab b ON b.id = e0.dst),
  intra AS (SELECT cs AS id, sum(2 * w) AS w2 FROM ce WHERE cs = cd GROUP BY 1),
  inter AS (SELECT least(cs, cd) AS src, greatest(cs, cd) AS dst, sum(w) AS w FROM ce WHERE cs <> cd GROUP BY 1, 2),
  kk AS (SELECT id, sum(w) AS k FROM (SELECT src AS id, w FROM inter UNION ALL SELECT dst, w FROM inter) GROUP BY 1),
  comms AS (SELECT DISTINCT label AS id FROM lab)
SELECT c.id, c.id AS community,
       CAST(coalesce(kk.k, 0) + coalesce(intra.w2, 0) AS BIGINT) AS sigma_tot,
       CAST(coalesce(intra.w2, 0) AS BIGINT) AS internal_weight,
       CAST(coalesce(kk.k, 0) AS BIGINT) AS node_weight, false AS changed
FROM comms c LEFT JOIN intra USING (id) LEFT JOIN kk USING (id)""",
    "compress_by_size_edges": _W(_P, G.PART_SIZES_SQL, _SIZE_STATE) + """,
  ce AS (SELECT e0.w, a.label AS cs, b.label AS cd FROM e0 JOIN lab a ON a.id = e0.src JOIN lab b ON b.id = e0.dst)
SELECT least(cs, cd) AS src, greatest(cs, cd) AS dst, CAST(sum(w) AS BIGINT) AS weight
FROM ce WHERE cs <> cd GROUP BY 1, 2""",
    "edge_list_roundtrip": _W(_P) + """
SELECT least(src, dst) AS src, greatest(src, dst) AS dst, 1.0::DOUBLE AS weight FROM g_part""",
    "weighted_edge_list_roundtrip": _W(_P) + "\nSELECT src, dst, weight FROM g_part",
    "vertices_roundtrip": _degree_sql("SELECT src AS id FROM c UNION ALL SELECT dst FROM c"),
    "graph_roundtrip": _W(_P, G.PART_SIZES_SQL) + """
SELECT g.src, g.dst, g.weight, a.label AS src_label, b.label AS dst_label
FROM g_part g LEFT JOIN sizes a ON a.id = g.src LEFT JOIN sizes b ON b.id = g.dst""",
    "permissive_roundtrip": _W(_P) + "\nSELECT src, dst, weight, (SELECT count(*) FROM part) AS dropped FROM g_part",
    "ego_nets_roundtrip": _W(G.EGO_NETS_SQL) + "\nSELECT ego_id, src, dst FROM ego",
}

# From every vertex, where the operators also take seeds.
_SEEDED = " SEMI JOIN seeds USING (id)"
ORACLE["closeness_to_seeds"] = ORACLE["closeness"]
for _name in ("k_hop", "k_hop_edges", "k_betweenness_2", "k_betweenness_3", "closeness"):
    ORACLE[_name] = ORACLE[_name].replace(_SEEDED, "")

_CLOSED = """
  r(id, reachable) AS (SELECT id, id FROM v UNION SELECT r.id, c.dst FROM r JOIN c ON c.src = r.reachable)"""
ORACLE |= {
    "reach_counts": _W(_P, _V, """
  c AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM g_part)""", _CLOSED) + "\nSELECT id, count(*) AS reached FROM r GROUP BY id",
    "reach_counts_cyclic": _W(_P, _V, """
  c AS (SELECT DISTINCT src, dst FROM g_part)""", _CLOSED) + "\nSELECT id, count(*) AS reached FROM r GROUP BY id",
    "hop_summary": _W(_P, _V, _dist_sql("""
  pe AS (SELECT DISTINCT src, dst FROM g_part)""", "SELECT id, id, 0::BIGINT FROM v", "1")) + """
SELECT id, count(*) AS reached, round(sum(distance) / count(*), 6) AS mean, max(distance) AS eccentricity FROM d GROUP BY id""",
    "propagate_hops": _W(_P, _V, _dist_sql("""
  pe AS (SELECT DISTINCT dst AS src, src AS dst FROM g_part)""", "SELECT min(id), min(id), 0::BIGINT FROM v", "1")) + "\nSELECT id, distance AS hops FROM d",
}

# the same rows by another method
ORACLE["landmark_delta"] = ORACLE["landmark_weighted"]
