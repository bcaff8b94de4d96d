"""PageRank as delta propagation over an edge table.

Ranks start at ``reset`` (0.15); every round each vertex that received rank
in the previous round forwards its last increment ``delta`` split evenly over
its out-edges, and a receiving vertex adds ``(1 - reset) * received``.

* ``tol=t``: a vertex forwards only while its increment exceeds ``t``; the
  loop ends when nothing is forwarded (the tolerance mode of the edge-list
  PageRank job: unnormalised, mass of sink vertices is lost).
* ``num_iter=r``: exactly ``r`` rounds, every increment forwarded; this is the
  same fixed point iteration ``x = reset + (1 - reset) * P x`` started at
  ``reset`` and truncated after ``r`` steps.

Increments and edges are arrays (``functions.blocks``): a round exchanges sums by vertex, not a row an edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.functions import blocks as B
from graphmill.functions.state import StateStore, fingerprint


def pagerank(edges: DataFrame, tol: float | None = None, num_iter: int | None = None,
             reset: float = 0.15, normalize: bool = False, max_iter: int = 10_000, resume: str | None = None) -> DataFrame:
    """``(id, value)`` for every endpoint of ``edges`` (parallel edges all count).

    ``resume``: a name under which the rounds are kept, so that another driver goes on where this one is lost.
    """
    if (tol is None) == (num_iter is None):
        raise ValueError("give exactly one of tol= or num_iter=")
    spark = edges.sparkSession
    store = StateStore(spark, "pagerank", resume=resume)
    e = edges.select("src", "dst")
    given = [*fingerprint(e), tol, num_iter, reset, B.BLOCK_EDGES] if resume else None
    kept = store.resumed()
    if kept and kept[1]["given"] != given:
        raise ValueError(f"the state named {resume!r} is of other edges or settings")
    verts, blocks = B.edge_blocks(e, store)
    damp, least = 1.0 - reset, float("-inf") if tol is None else tol
    rounds = num_iter if num_iter is not None else max_iter
    begun = kept[1]["rounds"] if kept else 0
    state = kept[0][f"delta{begun - 1}"] if kept else B.begun(verts, reset)
    for r in range(begun, rounds):
        if kept and not kept[1]["rows"]:
            break
        state, m = store.save(B.a_round(blocks, state, False, least, damp), f"delta{r}", rows=F.sum("got"))
        store.commit([f"delta{r}"], given=given, rounds=r + 1, rows=m["rows"] or 0)
        store.drop(f"delta{r - 2}")
        if not m["rows"]:
            break
    else:
        if tol is not None:
            raise RuntimeError(f"pagerank did not reach tol={tol} in {max_iter} rounds")
    rank = B.totals(state, verts).select("id", "value")
    if normalize:
        total, n = rank.agg(F.sum("value"), F.count(F.lit(1))).first()
        rank = rank.select("id", (F.col("value") * F.lit(n / total if n else 1.0)).alias("value"))
    return rank
