"""Triangle counts and local clustering coefficients.

Triangles are counted on the simple undirected graph (loops and duplicate or
reversed edges removed).  Each edge is oriented from the endpoint of lower
``(degree, id)`` to the higher one, so every vertex has at most
``O(sqrt(m))`` out-edges even when one vertex touches a large share of all
edges; a triangle is then found exactly once, as the wedge at its lowest
vertex closed by an edge lookup (node-iterator with degree ordering).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.functions.graph import canonical, degrees, simple_undirected, vertices_of


def triangles(edges: DataFrame) -> DataFrame:
    """Triangle rows ``(a, b, c)``, each triangle once."""
    s = simple_undirected(edges)
    d = degrees(s, "all")
    ranked = (s.join(d.select(F.col("id").alias("src"), F.col("degree").alias("ds")), "src")
              .join(d.select(F.col("id").alias("dst"), F.col("degree").alias("dd")), "dst"))
    low_first = (F.col("ds") < F.col("dd")) | ((F.col("ds") == F.col("dd")) & (F.col("src") < F.col("dst")))
    o = ranked.select(F.when(low_first, F.col("src")).otherwise(F.col("dst")).alias("a"),
                      F.when(low_first, F.col("dst")).otherwise(F.col("src")).alias("b"))
    wedges = (o.join(o.select("a", F.col("b").alias("c")), "a").where(F.col("b") < F.col("c")))
    closing = s.select(F.col("src").alias("x"), F.col("dst").alias("y"))
    return (wedges.join(closing, (F.least("b", "c") == F.col("x")) & (F.greatest("b", "c") == F.col("y")),
                        "left_semi"))


def triangle_count(edges: DataFrame) -> DataFrame:
    """``(id, triangles)`` for every endpoint of ``edges`` (0 included)."""
    t = triangles(edges)
    per = (t.select(F.explode(F.array("a", "b", "c")).alias("id"))
           .groupBy("id").agg(F.count(F.lit(1)).alias("triangles")))
    return (vertices_of(edges).join(per, "id", "left")
            .select("id", F.coalesce("triangles", F.lit(0)).cast("long").alias("triangles")))


def local_clustering(edges: DataFrame, degree: str = "multi") -> DataFrame:
    """``(id, value)`` = triangles / (d (d - 1) / 2), 0 when ``d < 2``.

    ``degree='multi'`` counts every edge row of the canonical graph (parallel
    edges and reversed copies too, a loop twice) as the edge-list job does;
    ``'simple'`` uses the simple-graph degree (textbook value).
    """
    base = canonical(edges.select("src", "dst"))
    d = degrees(base if degree == "multi" else simple_undirected(edges), "all")
    t = triangle_count(edges)
    dd = F.col("degree").cast("long")
    return (t.join(d, "id", "left").fillna(0, ["degree"])
            .select("id", F.when(dd < 2, F.lit(0.0))
                    .otherwise(F.col("triangles") / (dd * (dd - 1) / F.lit(2.0))).alias("value")))
