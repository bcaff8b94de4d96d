"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: the majority bits of the XXH64 of all word shingles.  Links:
fingerprints at ``distance`` or fewer differing bits; classes are the connected
components of the links.

Index.  The 64 bits are cut into ``distance + 2`` blocks; two fingerprints that
differ in at most ``distance`` bits agree on at least two whole blocks, so each
choice of two blocks gives a masked bit pattern whose holders form one upper
node, and every link is within some node.  A node with more than ``HOT``
holders is opened again: the bits outside its mask are cut into ``distance + 1``
parts, of which linked holders agree on one, and so on until nodes are small
(or all bits are masked).  Nodes are dealt over tasks; inside a task a node's
fingerprints are sorted by Gray rank and grouped into a binary tree, each tree
node holding the bits its members share (mask and pattern).  Pairs of tree nodes
are walked from the top; a pair is dropped when the bits on which the shared
patterns differ exceed the distance, and accepted whole when no two members can
differ by more.  Links come out as a spanning forest per node, never as all pairs.

Cases: a null text counts as empty; texts without words have fingerprint 0 and
link like any other; repeated rows share a fingerprint; a null id takes part in
its component but never names it unless no other id is there.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import bounded_batches, may_hold, settle, text_of, unused
from graphmill.llm.components import components

WORDS, DISTANCE, SEED = 3, 3, 42
#: Fingerprints above which an upper node is opened into finer ones.
HOT = 1024
_BLOCK = 1 << 14
_ALL = (1 << 64) - 1


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of one text as an unsigned number."""
    w = text.lower().split()  # bytes: only A-Z is lowered, only 0x20 and 0x09-0x0D separate
    if not w:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(w) <= words:
        return digest(b" ".join(w), SEED)
    n, ones = len(w) - words + 1, np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        part = [w[i + k:min(i + _BLOCK, n) + k] for k in range(words)]
        h = np.fromiter((digest(b" ".join(s), SEED) for s in zip(*part)), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id, fp`` (signed 64 bits) of every row."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    given = docs.select(F.col(f"`{key}`").alias("doc_id"), text_of(text).cast("binary").alias("t"))
    return given.mapInArrow(run, given.select("doc_id").schema.add("fp", "long"))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def node_links(fps: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Spanning forest (as pairs) of the link graph of one upper node's distinct fingerprints."""
    fps = fps[np.argsort(gray_rank(fps))]
    n = len(fps)
    shared, pattern = [np.full(n, _ALL, np.uint64)], [fps]  # levels of the tree, leaves first
    while len(pattern[-1]) > 1:
        m, p = shared[-1], pattern[-1]
        if len(p) % 2:
            m, p = np.append(m, m[-1]), np.append(p, p[-1])
        both = m[0::2] & m[1::2] & ~(p[0::2] ^ p[1::2])
        shared.append(both)
        pattern.append(p[0::2] & both)
    root = np.arange(n)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []

    def join(a, b):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(fps[a]), int(fps[b])))

    todo = [(len(pattern) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        level, a, b = todo.pop()
        if len(a) > _BLOCK:  # bounded memory: walk the pairs in parts
            todo += [(level, a[i:i + _BLOCK], b[i:i + _BLOCK]) for i in range(0, len(a), _BLOCK)]
            continue
        m, p = shared[level], pattern[level]
        common = m[a] & m[b]
        least = _bits((p[a] ^ p[b]) & common)  # differences already accumulated
        most = 64 - _bits(common) + least
        near = least <= distance
        a, b, whole = a[near], b[near], (most <= distance)[near]
        width = 1 << level
        for i, j in zip(a[whole], b[whole]):
            first = i * width
            for k in (*range(i * width, min((i + 1) * width, n)), *range(j * width, min((j + 1) * width, n))):
                join(first, k)
        a, b = a[~whole], b[~whole]
        if level == 0 or not len(a):
            continue
        same = a == b
        x = np.concatenate([2 * a[same], 2 * a[same], 2 * a[same] + 1, *[2 * a[~same] + k for k in (0, 0, 1, 1)]])
        y = np.concatenate([2 * a[same], 2 * a[same] + 1, 2 * a[same] + 1, *[2 * b[~same] + k for k in (0, 1, 0, 1)]])
        size = len(pattern[level - 1])
        ok = (x < size) & (y < size)
        if level == 1:
            ok &= x != y
            known = root[x[ok]] == root[y[ok]]  # pairs that a link chain already joins
            x, y = x[ok][~known], y[ok][~known]
        else:
            x, y = x[ok], y[ok]
        todo.append((level - 1, x, y))
    return out


def _parts(free: list[int], n: int) -> list[int]:
    """``n`` masks that share out the bit numbers ``free``."""
    return [sum(1 << b for b in free[len(free) * i // n:len(free) * (i + 1) // n]) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _open(mask: int, distance: int) -> list[int]:
    """Masks of the finer nodes of a node with this mask."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | part for part in _parts(free, min(distance + 1, len(free)))] if len(free) > distance else [_ALL]


def links(fps: DataFrame, distance: int = DISTANCE, hot: int = HOT, partitions: int | None = None) -> DataFrame:
    """``a, b``: a spanning forest of the links of each upper node over distinct ``fps (fp)``."""
    spark = fps.sparkSession
    blocks = _parts(list(range(64)), distance + 2)
    masks = [sum(pair) for pair in combinations(blocks, 2)]
    nodes = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    ready = []

    def finer(batches):
        opened: dict[int, np.ndarray] = {}
        for batch in batches:
            fp, mask = (batch.column(c).to_numpy() for c in (0, 1))
            for m in np.unique(mask):
                if m not in opened:
                    opened[m] = np.array([_signed(c) for c in _open(int(m) & _ALL, distance)], np.int64)
                own, to = fp[mask == m], opened[m]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, len(to))), pa.array(np.tile(to, len(own)))], names=["fp", "mask"])

    while True:
        nodes = nodes.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))
        big = settle(nodes.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot)
                     .drop("n"), "hot-nodes")
        if big.isEmpty():
            ready.append(nodes)
            break
        ready.append(nodes.join(big, ["mask", "pattern"], "left_anti"))
        nodes = settle(nodes.join(big, ["mask", "pattern"], "left_semi").select("fp", "mask")
                       .mapInArrow(finer, "fp long, mask long"), "finer-nodes")
    every = ready[0]
    for more in ready[1:]:
        every = every.unionByName(more)

    def run(batches):
        given = list(batches)
        if not given:
            return
        table = pa.Table.from_batches(given)
        fp, mask, pattern = (table.column(c).to_numpy().view(np.uint64) for c in ("fp", "mask", "pattern"))
        order = np.lexsort((fp, pattern, mask))
        fp, mask, pattern = fp[order], mask[order], pattern[order]
        edge = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1]), True])
        found = []
        for k in np.flatnonzero(np.diff(edge) > 1):
            own = fp[edge[k]:edge[k + 1]]
            if len(own) == 2:
                if bin(int(own[0] ^ own[1])).count("1") <= distance:
                    found.append((int(own[0]), int(own[1])))
            else:
                found += node_links(own, distance)
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return every.select("fp", "mask", "pattern").repartition(n, "mask", "pattern").mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """Per row: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable by links."""
    fps = settle(fingerprints(docs, key, text, words), "fingerprints")
    distinct = settle(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), distance))
    rooted = distinct.join(roots, distinct["fp"] == roots["id"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    rooted = settle(rooted, "rooted")
    lowest = settle(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    named = settle(rooted.join(lowest, "root").select("fp", "component_id"), "components")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id; only rows that may be dropped are moved."""
    groups = settle(near_groups(docs, key, text, words, distance), "near")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    own, sha = unused(docs, "own_id"), unused(docs, "own_sha")
    per_id = groups.groupBy(F.col("doc_id").alias(own)).agg(F.max(kept).alias("kept"), F.count(F.lit(1)).alias("n"))
    per_id = settle(per_id.where("not kept or n > 1"), "near-gone")
    some, others = may_hold(docs, F.xxhash64(F.col(f"`{key}`")), per_id.select(F.xxhash64(own).alias("k")), per_id.count())
    gone, again = per_id.select(own), per_id.where("kept").select(own)
    same = F.col(own).eqNullSafe(F.col(f"`{key}`"))
    out = others.unionByName(some.join(gone, same, "left_anti"))
    if again.isEmpty():
        return out
    # several rows with the id that stays: the first by digest of the text
    rows = some.join(again, same, "left_semi").withColumn(sha, F.sha2(text_of(text), 256))
    low = settle(rows.groupBy(F.col(f"`{key}`").alias(own)).agg(F.min(sha).alias("low")), "near-first")
    one = rows.join(low, same & (F.col("low") == F.col(sha)), "left_semi").dropDuplicates([key, sha])
    return out.unionByName(one.drop(sha))
