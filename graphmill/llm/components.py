"""Connected components by contraction, over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for every id in ``edges (a, b)``; ``root`` is one id of the component.

    Each round points every vertex at its smallest neighbour or itself, puts
    the pointers in place of the edges' ends and drops loops and repeats, so
    every vertex with a smaller neighbour goes.  The pointers of
    all rounds are then followed back.  Hubs are summed up on the map side
    (``min``), and pointers are written before they are joined, so that AQE can
    split a hub's edges.
    """
    edges = settle(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .where("a <> b").distinct(), "edges")
    steps = []
    while not edges.isEmpty():
        ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("to")),
                                              F.struct(F.col("b").alias("id"), F.col("a").alias("to")))).alias("e"))
        step = settle(ends.groupBy("e.id").agg(F.min("e.to").alias("to"))
                      .select("id", F.least("id", "to").alias("root")), "step")
        steps.append(step)
        a, b = (step.select(F.col("id").alias(x), F.col("root").alias(f"{x}_root")) for x in "ab")
        edges = settle(edges.join(a, "a").join(b, "b").select(F.least("a_root", "b_root").alias("a"),
                                                               F.greatest("a_root", "b_root").alias("b"))
                       .where("a <> b").distinct(), "edges")
    if not steps:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    out = steps[-1]
    for step in reversed(steps[:-1]):
        nxt = out.select(F.col("id").alias("root"), F.col("root").alias("top"))
        out = settle(step.join(nxt, "root", "left").select("id", F.coalesce("top", "root").alias("root")), "roots")
    return out
