"""Eigenvector centrality by power iteration on ``A^T + I``.

``x0 = 1/n``; a round computes ``y(v) = x(v) + sum over in-edges (u -> v) of
x(u) * weight`` and normalises ``x = y / ||y||_2`` (a zero norm divides by 1).
With ``max_iter`` the loop runs while ``sum |x - x_prev| >= n * 1e-6`` for at
most ``max_iter + 1`` rounds (the job's parameter counts from zero); with
``num_iter`` exactly that many rounds run.  Every vertex keeps a row every
round; its norm, and the change of the round before, are observed by the same job that writes the round's table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.functions.graph import vertices_of
from graphmill.functions.state import Mirrors, StateStore


def eigenvector(edges: DataFrame, max_iter: int = 100, num_iter: int | None = None,
                tol_per_vertex: float = 1e-6, weight: str | None = None, with_status: bool = False) -> DataFrame | tuple[DataFrame, bool, int]:
    """``(id, value)``; ``weight=None`` gives every edge (and parallel copy) weight 1.

    ``with_status``: also whether the last change was under the threshold, and the number of rounds.
    """
    spark = edges.sparkSession
    store = StateStore(spark, "eigenvector", keep=3)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    # Parallel edges merge into one weighted edge: same sums, fewer rows per round.
    out = Mirrors(store, edges.select(F.col("src").alias("id"), "dst", w.alias("w")).groupBy("id", "dst").agg(F.sum("w").alias("w")), "edges", "id", "dst")
    verts, m = store.save(vertices_of(edges), "vertices", n=F.count(F.lit(1)))
    n = m["n"] or 0
    x = verts.select("id", F.lit(1.0 / n if n else 0.0).alias("x"), F.lit(None).cast("double").alias("prev"))
    rounds = num_iter if num_iter is not None else max_iter + 1
    threshold = n * tol_per_vertex
    done, change = 0, None
    change_of = F.sum(F.abs(F.col("prev") - F.col("before")))  # of the round before: its norm is known only when this one starts
    while done < rounds:
        msg = out.meet(x.select("id", "x")).groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("x") * F.col("w")).alias("msg"))
        y = (x.join(msg, "id", "left")
             .select("id", F.col("prev").alias("before"), F.col("x").alias("prev"), (F.col("x") + F.coalesce("msg", F.lit(0.0))).alias("y")))
        y, obs = store.save(y, "round", sq=F.sum(F.col("y") * F.col("y")), change=change_of)
        if num_iter is None and done and (change := obs["change"] or 0.0) < threshold:
            x = y.select("id", F.col("prev").alias("x"))
            break
        s = math.sqrt(obs["sq"] or 0.0)
        x = y.select("id", (F.col("y") / F.lit(s if s != 0.0 else 1.0)).alias("x"), "prev")
        done += 1
    value = x.select("id", F.col("x").alias("value"))
    if not with_status:
        return value
    if num_iter is not None or change is None or change >= threshold:  # the last round's change isn't known yet
        change = x.agg(F.sum(F.abs(F.col("x") - F.col("prev")))).first()[0] or 0.0 if done else 0.0
    return value, change < threshold, done
