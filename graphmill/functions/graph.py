"""Edge-table primitives.

An edge table has ``src BIGINT, dst BIGINT`` and usually ``weight DOUBLE``.
The vertex set of a graph is derived from its edges (the endpoints), exactly
as a loader of an edge-list file derives it.  All functions are lazy
DataFrame transformations; none collects data to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edge_table(df: DataFrame, src: str = "src", dst: str = "dst", weight: str | None = None,
               default_weight: float = 1.0) -> DataFrame:
    """Project any DataFrame to the standard ``(src, dst, weight)`` edge schema.

    ``weight=None`` gives every edge ``default_weight`` (an edge-list file
    without a weight column).
    """
    w = F.col(weight).cast("double") if weight else F.lit(float(default_weight))
    return df.select(F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst"),
                     w.alias("weight"))


def vertices_of(edges: DataFrame) -> DataFrame:
    """Distinct endpoints ``(id)`` of an edge table."""
    return (edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct())


def canonical(edges: DataFrame) -> DataFrame:
    """Orient every edge from the smaller to the larger id; parallel edges are kept."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), *rest)


def simple_undirected(edges: DataFrame) -> DataFrame:
    """The simple undirected graph as canonical pairs ``src < dst``: no loops, no duplicates."""
    return (canonical(edges.select("src", "dst")).where(F.col("src") != F.col("dst")).distinct())


def symmetrize(edges: DataFrame) -> DataFrame:
    """Both directions of every edge (a self loop appears twice)."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest)
    return edges.select("src", "dst", *rest).unionByName(back)


def merge_edges(edges: DataFrame, how: str = "sum") -> DataFrame:
    """Merge parallel edges of the same direction, combining weights with ``how``."""
    agg = {"sum": F.sum, "min": F.min, "max": F.max}[how]
    return edges.groupBy("src", "dst").agg(agg("weight").alias("weight"))


def adjacency(edges: DataFrame) -> DataFrame:
    """Undirected neighbour rows ``(id, nbr)``, distinct; a self loop makes a vertex its own neighbour."""
    e = edges.select("src", "dst")
    return (e.select(F.col("src").alias("id"), F.col("dst").alias("nbr"))
            .unionByName(e.select(F.col("dst").alias("id"), F.col("src").alias("nbr")))
            .distinct())


def degrees(edges: DataFrame, mode: str = "all") -> DataFrame:
    """Multigraph degree ``(id, degree)``: ``in``, ``out`` or ``all`` (a self loop counts twice)."""
    if mode == "in":
        ids = edges.select(F.col("dst").alias("id"))
    elif mode == "out":
        ids = edges.select(F.col("src").alias("id"))
    elif mode == "all":
        ids = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    else:
        raise ValueError(f"mode must be in/out/all, not {mode!r}")
    return ids.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def make_graph(vertices: DataFrame | None, edges: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Vertex table of a graph built from ``vertices`` and ``edges``.

    Endpoints missing from ``vertices`` get the ``defaults`` attribute values;
    vertices without edges are kept.
    """
    ends = vertices_of(edges)
    if vertices is None:
        return ends
    attrs = [c for c in vertices.columns if c != "id"]
    out = ends.join(vertices, "id", "full")
    defaults = defaults or {}
    return out.select("id", *[F.coalesce(F.col(c), F.lit(defaults.get(c))).alias(c) if c in defaults
                              else F.col(c) for c in attrs])


def triplets(edges: DataFrame, vertices: DataFrame, attrs: list[str] | None = None) -> DataFrame:
    """Edges with the attributes of both ends, as ``src_<a>`` and ``dst_<a>`` columns.

    Only the requested attributes travel through the two joins.
    """
    attrs = attrs if attrs is not None else [c for c in vertices.columns if c != "id"]
    v = vertices.select("id", *attrs)
    s = v.select(F.col("id").alias("src"), *[F.col(a).alias(f"src_{a}") for a in attrs])
    d = v.select(F.col("id").alias("dst"), *[F.col(a).alias(f"dst_{a}") for a in attrs])
    return edges.join(s, "src", "left").join(d, "dst", "left").select(edges.columns + [
        f"src_{a}" for a in attrs] + [f"dst_{a}" for a in attrs])


def aggregate_messages(edges: DataFrame, vertices: DataFrame | None, to_src: dict[str, Column] | None,
                       to_dst: dict[str, Column] | None, agg: dict[str, str],
                       attrs: list[str] | None = None) -> DataFrame:
    """Neighbour aggregation: every edge sends messages to its ends, merged per vertex.

    ``to_src``/``to_dst`` map message names to Column expressions over the
    triplet columns (``src``, ``dst``, ``weight``, ``src_<a>``, ``dst_<a>``);
    ``agg`` maps each message name to ``sum``/``min``/``max``/``count``.
    Returns ``(id, <message names>)`` for vertices that received a message.
    Map-side partial aggregation happens before the shuffle on ``id``.
    """
    t = triplets(edges, vertices, attrs) if vertices is not None else edges
    names = list(agg)
    parts = []
    for target, msgs in (("src", to_src), ("dst", to_dst)):
        if msgs:
            parts.append(t.select(F.col(target).alias("id"),
                                  *[(msgs[n] if n in msgs else F.lit(None)).alias(n) for n in names]))
    if not parts:
        raise ValueError("no message direction given")
    msgs = parts[0]
    for p in parts[1:]:
        msgs = msgs.unionByName(p)
    fns = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
    return msgs.groupBy("id").agg(*[fns[agg[n]](n).alias(n) for n in names])
