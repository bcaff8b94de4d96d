"""Connected components and ego circles.

Components come from contraction.  A round orders the vertices by a hash of its own and points every vertex at its
first neighbour, or at itself if it comes first; the pointers run down that order, so they make trees, and one pointer
jump shortens them.  Edges then take their ends' targets, loops and repeats go, and the next
round works on the smaller graph that is left: a constant share of the vertices goes each time, whatever the
ids and the shape (a path of n vertices takes O(log n) rounds).  Each round's pointers are written once; at the end they
are followed back from the last round to the first, and a component is named by its least id.
``keys`` run many independent graphs (e.g. one per ego net) in the same jobs: a vertex is ``(keys..., id)``.
Ego nets of up to ``NET_EDGES`` edges are dealt into groups, each worked off where it stands; only larger ones are contracted in rounds.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.functions.state import StateStore

#: Edges of the largest net that one group takes, and of a group, about; groups that a shuffle partition holds.
NET_EDGES = 200_000
GROUP_EDGES = 500_000
GROUPS_HELD = 8


def connected_components(edges: DataFrame, keys: list[str] | None = None,
                         max_iter: int | None = None) -> DataFrame:
    """``(keys..., id, component)`` with component = least vertex id of the component."""
    keys = list(keys or [])
    store = StateStore(edges.sparkSession, "components")
    e = edges.select(*keys, "src", "dst")
    pairs, m = store.save(e.where("src <> dst").select(*keys, F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct(),
                          "pairs", rows=F.count(F.lit(1)))
    steps: list[DataFrame] = []
    while m["rows"]:
        if max_iter is not None and len(steps) >= max_iter:
            raise RuntimeError(f"components not settled after {max_iter} rounds")

        def order(c: str, r: int = len(steps)):
            return F.struct(F.xxhash64(F.lit(r), *keys, c).alias("h"), F.col(c).alias("v"))

        ends = pairs.select(*keys, F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("nbr")),
                                                      F.struct(F.col("b").alias("id"), F.col("a").alias("nbr")))).alias("e")).select(*keys, "e.*")
        first = ends.groupBy(*keys, "id").agg(F.min(order("nbr")).alias("first"))
        step = store.save(first.select(*keys, "id", F.least("first", order("id"))["v"].alias("to")), "pointers")
        target = step.select(*keys, F.col("id").alias("to"), F.col("to").alias("next"))
        step = store.save(step.join(target, keys + ["to"]).select(*keys, "id", F.col("next").alias("to")), f"step{len(steps)}")
        steps.append(step)
        for end in ("a", "b"):
            pairs = pairs.join(step.select(*keys, F.col("id").alias(end), F.col("to").alias(f"{end}_to")), keys + [end])
        pairs, m = store.save(pairs.where("a_to <> b_to").select(*keys, F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(),
                              "pairs", rows=F.count(F.lit(1)))
    verts = e.select(*keys, F.explode(F.array("src", "dst")).alias("id")).distinct()
    if not steps:
        return verts.select(*keys, "id", F.col("id").alias("component"))
    roots = steps[-1].select(*keys, "id", F.col("to").alias("root"))
    for k in range(len(steps) - 2, -1, -1):
        later = roots.select(*keys, F.col("id").alias("to"), "root")
        roots = store.save(steps[k].join(later, keys + ["to"], "left").select(*keys, "id", F.coalesce("root", "to").alias("root")), "roots")
    names = store.save(roots.groupBy(*keys, "root").agg(F.min("id").alias("component")), "names")
    named = roots.join(names, keys + ["root"]).select(*keys, "id", "component")
    return verts.join(named, keys + ["id"], "left").select(*keys, "id", F.coalesce("component", "id").alias("component"))


def _netted() -> Callable[[pa.Table], pa.Table]:
    """A function that goes to tasks as it is, without this module."""

    def nets(table: pa.Table) -> pa.Table:
        """``(ego_id, id, component)`` of all nets in a group: the least vertex number spreads along edges and pointers."""
        egos, ego = np.unique(table["ego_id"].to_numpy(), return_inverse=True)
        ids, end = np.unique(np.concatenate([table["src"].to_numpy(), table["dst"].to_numpy()]), return_inverse=True)
        verts, at = np.unique(np.concatenate([ego, ego]) * len(ids) + end, return_inverse=True)  # by ego, then id
        a, b = at[:len(ego)], at[len(ego):]
        to = np.arange(len(verts))
        while True:
            ta, tb = to[a], to[b]
            apart = ta != tb
            if not apart.any():
                break
            np.minimum.at(to, np.maximum(ta, tb)[apart], np.minimum(ta, tb)[apart])
            while (to[to] != to).any():
                to = to[to]
        return pa.table({"ego_id": egos[verts // len(ids)], "id": ids[verts % len(ids)], "component": ids[verts[to] % len(ids)]})

    return nets


def ego_components(ego_edges: DataFrame) -> DataFrame:
    """``(ego_id, id, component)`` for ego-net edges ``(ego_id, src, dst)``."""
    store = StateStore(ego_edges.sparkSession, "egos")
    nulls = F.col("ego_id").isNull() | F.col("src").isNull() | F.col("dst").isNull()
    e, m = store.save(ego_edges.select(*[F.col(c).cast("long").alias(c) for c in ("ego_id", "src", "dst")]), "edges",
                      rows=F.count(F.lit(1)), nulls=F.sum(nulls.cast("long")))
    whole = e.where("ego_id is not null")
    if m["nulls"]:  # a null end links nothing
        whole = whole.select("ego_id", F.coalesce("src", "dst").alias("src"), F.coalesce("dst", "src").alias("dst")).where("src is not null")
    large = store.save(whole.groupBy("ego_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > NET_EDGES).select("ego_id"), "large")
    some = not large.isEmpty()
    small = whole.join(large, "ego_id", "left_anti") if some else whole
    groups = -(-(m["rows"] or 0) // GROUP_EDGES)
    tasks = max(int(e.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-groups // GROUPS_HELD))
    group = F.pmod(F.xxhash64("ego_id"), F.lit(max(groups, tasks))).alias("group")
    out = small.select(group, "*").repartition(tasks, "group").groupBy("group").applyInArrow(_netted(), "ego_id long, id long, component long")
    if some:
        out = out.unionByName(connected_components(whole.join(large, "ego_id", "left_semi"), keys=["ego_id"]))
    if m["nulls"]:
        ends = e.where(nulls).select("ego_id", F.explode(F.array("src", "dst")).alias("id"))
        alone = ends.where("ego_id is null or id is null").distinct().withColumn("component", F.col("id"))
        out = out.unionByName(alone)
    return out


def ego_circles(ego_edges: DataFrame) -> DataFrame:
    """``(ego_id, circles)``: each ego's components rendered as ``"v v v;v v"``.

    Members are sorted ascending inside a circle and circles are ordered by
    their least member, so the text is deterministic.  The rendering is done
    in two aggregations (circle strings, then one string per ego).
    """
    comp = ego_components(ego_edges)
    circles = (comp.groupBy("ego_id", "component")
               .agg(F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda x: x.cast("string")),
                                 " ").alias("circle")))
    return (circles.groupBy("ego_id")
            .agg(F.sort_array(F.collect_list(F.struct("component", "circle"))).alias("cs"))
            .select("ego_id", F.array_join(F.col("cs.circle"), ";").alias("circles")))
