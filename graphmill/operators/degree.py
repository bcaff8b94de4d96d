"""Degree centralities: in-, out- and total degree divided by ``n - 1``.

``n`` is the number of distinct endpoints.  Parallel edges all count and a
self loop adds 2 to the total degree.  As in an edge-list job, vertices with
zero in- (out-) degree are absent from the in- (out-) result unless
``include_zero=True``.  With a single vertex the scale is undefined (NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.functions.graph import degrees, vertices_of


def vertex_count(edges: DataFrame) -> int:
    return vertices_of(edges).count()


def degree_centrality(edges: DataFrame, mode: str = "all", include_zero: bool = False,
                      n: int | None = None) -> DataFrame:
    """``(id, value)`` with value = degree / (n - 1) for ``mode`` in ``in``/``out``/``all``."""
    n = vertex_count(edges) if n is None else n
    denom = F.lit(None).cast("double") if n <= 1 else F.lit(float(n - 1))
    d = degrees(edges, mode)
    if include_zero:
        d = vertices_of(edges).join(d, "id", "left").fillna(0, ["degree"])
    return d.select("id", (F.col("degree") / denom).alias("value"))
