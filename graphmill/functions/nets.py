"""Connected components (nets) that a task works off where they stand.

No path leaves a component, so a search needs no exchange if a task has its component whole: the component's edges go to
a unit, a group of rows ``(src, dst, weight, mark)``, and the searches from the marks are dealt over as many units (``share``) as their work
asks for, each with a copy of the edges.  Nets of few edges share units.  A net of over ``NET_EDGES`` edges is left to the
loops over tables (``Nets.rest``), and so is every graph with null or other than whole-numbered ids.
The functions that run in tasks go there as they are, without this module.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphmill.functions.state import StateStore
from graphmill.operators.components import connected_components

#: Edges of the largest net that a task takes whole; of nets that share a unit, about.
NET_EDGES = 4_000_000
SHARED_EDGES = 20_000
#: A graph of so many edges is one group where nothing but its size matters, its nets unknown.
WHOLE_EDGES = 500_000
#: Marks that a copy of a net's edges serves at least, if it has as many: of bit searches, and of others.
MARKS_SERVED, LENGTHS_SERVED = 4096, 16
#: Graphs of so many vertices or fewer go by the loops over tables: finding their nets would cost more than it saves.
FEW_VERTICES = 512

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def whole_ids(*frames: DataFrame) -> bool:
    """Whether all columns but weights are of whole numbers."""
    kinds = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    return all(isinstance(f.dataType, kinds) for df in frames for f in df.schema.fields if f.name != "weight")


class Nets:
    """Edges ``(src, dst)``, or with ``weight``, with the component that each is of."""

    def __init__(self, edges: DataFrame, store: StateStore):
        """``edges`` is a table without nulls that is cheap to read."""
        self.store = store
        self.parts = store.save(connected_components(edges).select("id", F.col("component").alias("net")), "weak")
        self.weighted = "weight" in edges.columns
        self.edges = store.save(edges.join(self.parts.withColumnRenamed("id", "src"), "src"), "net-edges")
        sizes = store.save(self.edges.groupBy("net").agg(F.count(F.lit(1)).alias("edges")), "sizes")
        self.large = store.save(sizes.where(F.col("edges") > NET_EDGES).select("net"), "large-nets")
        self.any_large = not self.large.isEmpty()
        small = sizes.where(F.col("edges") <= NET_EDGES)
        few = small.where(F.col("edges") < SHARED_EDGES).agg(F.sum("edges")).first()[0] or 0
        own = F.col("edges") >= SHARED_EDGES
        bucket = F.pmod(F.xxhash64("net"), F.lit(max(1, -(-few // SHARED_EDGES))))
        self.sizes = store.save(small.select("net", "edges", own.alias("own"), F.when(own, F.col("net")).otherwise(bucket).alias("unit")), "units")

    @classmethod
    def of(cls, edges: DataFrame, store: StateStore) -> Nets | None:
        """Nets of the edges, loops and repeats as they are; None if ids are null or no whole numbers, or vertices are few."""
        if not whole_ids(edges):
            return None
        nulls = F.col("src").isNull() | F.col("dst").isNull()
        e, m = store.save(edges.withColumns({c: F.col(c).cast("long") for c in ("src", "dst")}), "given", nulls=F.sum(nulls.cast("long")))
        if m["nulls"] or e.select(F.explode(F.array("src", "dst")).alias("id")).distinct().limit(FEW_VERTICES + 1).count() <= FEW_VERTICES:
            return None
        return cls(e, store)

    def units(self, marks: DataFrame | None, per: int = 1) -> GroupedData:
        """Groups ``(src, dst, weight, mark)`` of the nets that have ``marks (id)``, a row an edge or (``src`` null) a mark; ``per`` marks at
        least are worth a copy of the edges.  Without marks every net goes to one unit."""
        wide = int(self.edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        plan, rows = self.sizes.withColumn("shares", F.lit(1)), None
        if marks is not None:
            placed = marks.select(F.col("id").cast("long").alias("id")).distinct().join(self.parts, "id")
            plan = self.sizes.join(placed.groupBy("net").agg(F.count(F.lit(1)).alias("marks")), "net")
            work = F.col("edges") * F.ceil(F.col("marks") / per)
            every = plan.agg(F.sum(work)).first()[0] or 0
            unit = max(every // (2 * wide), 1)
            shares = F.when(F.col("own"), F.least(F.ceil(work / unit), F.ceil(F.col("marks") / per))).otherwise(F.lit(1))
            plan = plan.withColumn("shares", shares.cast("int"))
        plan = self.store.save(plan, "plan")
        units = plan.select("own", "unit", "shares").distinct().agg(F.sum("shares")).first()[0] or 0
        weight = ["weight"] if self.weighted else []
        copies = plan.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).select("net", "own", "unit", "share")
        rows = self.edges.join(copies, "net").select("own", "unit", "share", "src", "dst", *weight, F.lit(None).cast("long").alias("mark"))
        if marks is not None:
            share = F.pmod(F.xxhash64("id"), F.col("shares")).cast("int").alias("share")
            none = F.lit(None).cast("long")
            rows = rows.unionByName(placed.join(plan, "net").select(
                "own", "unit", share, none.alias("src"), none.alias("dst"), *[F.lit(None).cast(self.edges.schema[w].dataType).alias(w) for w in weight], F.col("id").alias("mark")))
        # more partitions than units, as two that share one run one after the other
        return rows.repartition(min(max(wide, 2 * units), 10_000), "own", "unit", "share").groupBy("own", "unit", "share")

    def rest(self) -> DataFrame | None:
        """Edges of the nets that no task takes."""
        return self.edges.join(F.broadcast(self.large), "net").drop("net") if self.any_large else None


def reading() -> Callable[[Iterator[pa.RecordBatch]], tuple]:
    """A function that gives a unit's ids, its edges' ends as places among them, weights (or None) and the marks' places."""

    def read(batches: Iterator[pa.RecordBatch]) -> tuple:
        table = pa.Table.from_batches(batches)
        edges = table.filter(table["src"].is_valid())
        src, dst = edges["src"].to_numpy(), edges["dst"].to_numpy()
        ids = np.unique(np.concatenate([src, dst]))
        marks = table["mark"].drop_null().to_numpy()
        weight = edges["weight"].to_numpy() if "weight" in table.column_names else None
        return ids, np.searchsorted(ids, src).astype(np.int32), np.searchsorted(ids, dst).astype(np.int32), weight, np.searchsorted(ids, np.sort(marks))

    return read


def levels() -> Callable[..., Iterator[tuple]]:
    """A function that searches from 64 marks at a time, against edge direction, and gives ``(marks, hop, places, bits)`` level by level."""

    def search(n: int, src: np.ndarray, dst: np.ndarray, marks: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(src, kind="stable")
        to = dst[order]
        heads, starts = np.unique(src[order], return_index=True)
        for low in range(0, len(marks), 64):
            some = marks[low:low + 64]
            front = np.zeros(n, np.uint64)
            np.bitwise_or.at(front, some, np.left_shift(np.uint64(1), np.arange(len(some), dtype=np.uint64)))
            seen, hop = front.copy(), 0
            at = np.flatnonzero(front)
            yield some, 0, at, front[at]
            while len(starts):
                fresh = np.bitwise_or.reduceat(front.take(to), starts) & ~seen[heads]
                new = np.flatnonzero(fresh)
                if not len(new):
                    break
                hop += 1
                at, bits = heads[new], fresh[new]
                front = np.zeros(n, np.uint64)
                front[at] = bits
                seen[at] |= bits
                yield some, hop, at, bits

    return search


def profiles() -> Task:
    """``(id, hop, targets)`` of a unit: how many marks lie so many hops from a vertex."""
    read, search = reading(), levels()

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, src, dst, _, marks = read(batches)
        counts: list[np.ndarray] = []
        for _, hop, at, bits in search(len(ids), src, dst, marks):
            if hop == len(counts):
                counts.append(np.zeros(len(ids), np.int64))
            counts[hop][at] += np.bitwise_count(bits)
        for hop, count in enumerate(counts):
            some = np.flatnonzero(count)
            yield pa.record_batch({"id": ids[some], "hop": np.full(len(some), hop, np.int32), "targets": count[some]})

    return profile


def pairs() -> Task:
    """``(id, target, hop)`` of a unit, a batch a level of 64 marks."""
    read, search = reading(), levels()

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, src, dst, _, marks = read(batches)
        for some, hop, at, bits in search(len(ids), src, dst, marks):
            who, which = np.nonzero(np.unpackbits(bits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            yield pa.record_batch({"id": ids[at[who]], "target": ids[some[which]], "hop": np.full(len(who), hop, np.int32)})

    return pair


def strong() -> Callable[[int, np.ndarray, np.ndarray], np.ndarray]:
    """A function that numbers the strong components of a graph of ``n`` places and gives each place's (Tarjan, without recursion)."""

    def numbered(n: int, src: np.ndarray, dst: np.ndarray) -> np.ndarray:
        order = np.argsort(src, kind="stable")
        to = dst[order].tolist()
        begin = np.searchsorted(src[order], np.arange(n + 1)).tolist()
        at, seen, low, part = begin[:-1], [0] * n, [0] * n, [-1] * n
        stack, clock, parts = [], 0, 0
        for first in range(n):
            if seen[first]:
                continue
            clock += 1
            seen[first] = low[first] = clock
            stack.append(first)
            way = [first]
            while way:
                v = way[-1]
                i = at[v]
                if i < begin[v + 1]:
                    at[v] = i + 1
                    w = to[i]
                    if not seen[w]:
                        clock += 1
                        seen[w] = low[w] = clock
                        stack.append(w)
                        way.append(w)
                    elif part[w] < 0 and seen[w] < low[v]:
                        low[v] = seen[w]
                    continue
                way.pop()
                if way and low[v] < low[way[-1]]:
                    low[way[-1]] = low[v]
                if low[v] == seen[v]:
                    while True:
                        w = stack.pop()
                        part[w] = parts
                        if w == v:
                            break
                    parts += 1
        return np.array(part, np.int64)

    return numbered


def closures() -> Task:
    """``(id, reached)`` of a unit: how many of its marks a vertex reaches.  Vertices of a strong component reach the same, so the search runs over components."""
    read, search, numbered = reading(), levels(), strong()

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, src, dst, _, marks = read(batches)
        part = numbered(len(ids), src, dst)
        n = int(part.max()) + 1
        links = part[src] * n + part[dst]
        links = np.unique(links[part[src] != part[dst]])
        reached = np.zeros(n, np.int64)
        for _, _, at, bits in search(n, links // n, links % n, part[marks]):
            reached[at] += np.bitwise_count(bits)
        yield pa.record_batch({"id": ids, "reached": reached[part]})

    return close


def lengths(delta: float | None = None) -> Task:
    """``(id, landmark, distance)`` of a unit: least lengths to each mark, by relaxing what the vertices that improved hear, or bucket by
    bucket of width ``delta``: light edges until the bucket stands, then heavy ones once."""
    read = reading()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, src, dst, weight, marks = read(batches)
        n = len(ids)

        def side(some: np.ndarray) -> tuple:
            order = np.argsort(dst[some], kind="stable")
            return src[some][order], weight[some][order], np.searchsorted(dst[some][order], np.arange(n + 1))

        every = np.arange(len(src))
        light, heavy = (side(every), None) if delta is None else (side(np.flatnonzero(weight <= delta)), side(np.flatnonzero(weight > delta)))
        mask = np.zeros(n, bool)

        def relax(best: np.ndarray, front: np.ndarray, edges: tuple) -> np.ndarray:
            """Lowers what edges into ``front`` improve and gives these places."""
            into, load, begin = edges
            held = begin[front + 1] - begin[front]
            at = np.repeat(begin[front] - (np.cumsum(held) - held), held) + np.arange(held.sum())
            to, given = into[at], np.repeat(best[front], held) + load[at]
            better = given < best[to]
            to = to[better]
            np.minimum.at(best, to, given[better])
            mask[to] = True
            found = np.flatnonzero(mask)
            mask[found] = False
            return found

        for mark in marks:
            best = np.full(n, np.inf)
            best[mark] = 0.0
            front = np.array([mark])
            if delta is None:
                while len(front):
                    front = relax(best, front, light)
            else:
                waiting, sent = np.zeros(n, bool), np.zeros(n, bool)
                while True:
                    bucket = np.floor(best[front] / delta)
                    k = bucket.min()
                    front = front[bucket == k]
                    sent[:] = False
                    while len(front):
                        waiting[front], sent[front] = False, True
                        found = relax(best, front, light)
                        waiting[found] = True
                        front = found[np.floor(best[found] / delta) == k]
                    waiting[relax(best, np.flatnonzero(sent), heavy)] = True
                    front = np.flatnonzero(waiting)
                    if not len(front):
                        break
            at = np.flatnonzero(best < np.inf)
            yield pa.record_batch({"id": ids[at], "landmark": np.full(len(at), ids[mark]), "distance": best[at]})

    return measure


def gathered(edges: DataFrame, state: DataFrame, store: StateStore) -> GroupedData | None:
    """Groups of edges ``(src, dst, weight)`` and (``dst`` null) state rows ``(src, weight, community, inner)`` from ``state (id, k, community, inner)``: of a small
    graph all in one, of others a net's together; None if a net is too large or an id null or no whole number."""
    nulls = F.col("src").isNull() | F.col("dst").isNull()
    some = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(nulls.cast("long")), F.lit(0)).alias("nulls")).first()
    if some["nulls"] or not whole_ids(edges.select("src", "dst"), state):
        return None
    none = F.lit(None).cast("long")
    links = [*[F.col(c).cast("long").alias(c) for c in ("src", "dst", "weight")], none.alias("community"), none.alias("inner")]
    ends = [F.col("id").cast("long").alias("src"), none.alias("dst"), *[F.col(c).cast("long").alias(n) for c, n in (("k", "weight"), ("community", "community"), ("inner", "inner"))]]
    if some["n"] <= min(WHOLE_EDGES, NET_EDGES):
        unit = F.lit(0).alias("unit")
        return edges.select(unit, *links).unionByName(state.select(unit, *ends)).repartition(1, "unit").groupBy("unit")
    nets = Nets(store.save(edges.withColumns({c: F.col(c).cast("long") for c in ("src", "dst")}), "given"), store)
    if nets.any_large:
        return None
    place = nets.parts.join(nets.sizes.select("net", "own", "unit"), "net")
    rows = nets.edges.join(nets.sizes.select("net", "own", "unit"), "net").select("own", "unit", *links)
    rows = rows.unionByName(state.join(place, "id").select("own", "unit", *ends))
    units = nets.sizes.select("own", "unit").distinct().count()
    wide = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(min(max(wide, 2 * units), 10_000), "own", "unit").groupBy("own", "unit")


def moving(m: int, first: int, halves: int) -> Task:
    """Moves ``(half, id, community)`` of a group's vertices in the half cycles after ``first``, up to ``halves`` of them, as ``operators.louvain`` defines them."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        edges, state = table.filter(table["dst"].is_valid()), table.filter(table["dst"].is_null())
        order = np.argsort(state["src"].to_numpy())
        ids = state["src"].to_numpy()[order]
        k, inner = (state[c].to_numpy()[order] for c in ("weight", "inner"))
        own = np.searchsorted(ids, state["community"].to_numpy()[order])
        n = len(ids)
        a, b = (np.searchsorted(ids, edges[c].to_numpy()) for c in ("src", "dst"))
        hears, told, load = np.concatenate([a, b]), np.concatenate([b, a]), np.tile(edges["weight"].to_numpy(), 2)
        order = np.argsort(hears, kind="stable")
        hears, told, load = hears[order] * n, told[order], load[order]
        still = 0
        for half in range(first + 1, first + halves + 1):
            if not len(hears) or still == 2:
                return  # neither direction moves a vertex any more
            sigma = np.zeros(n, np.int64)
            np.add.at(sigma, own, k)
            pair = hears + own[told]
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            k_in = np.add.reduceat(load[order], at)
            who, group = pair[at] // n, pair[at] % n
            mine = own[who] == group
            rest = sigma[group] - np.where(mine, k[who], 0)
            gain = (k_in + np.where(mine, inner[who], 0)) * m - k[who] * rest
            gain = np.where((mine & (rest == 0)) | (gain < 0), 0, gain)
            begin = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            best = np.repeat(np.maximum.reduceat(gain, begin), np.diff(np.append(begin, len(who))))
            to = np.maximum.reduceat(np.where((gain == best) & (gain > 0), group, -1), begin)
            who = who[begin]
            goes = (to >= 0) & ((to < own[who]) if half % 2 else (to > own[who]))
            who, to = who[goes], to[goes]
            own[who] = to
            still = 0 if len(who) else still + 1
            yield pa.record_batch({"half": np.full(len(who), half, np.int32), "id": ids[who], "community": ids[to]})

    return move
