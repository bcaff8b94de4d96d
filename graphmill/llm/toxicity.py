"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

Features are the distinct words of a text (lower-cased runs of letters, digits
and non-ASCII bytes) and the beginnings of longer words, which stand for inflected
forms, hashed to ``BITS`` bits.  The labels tell toxic from not; the grades of
toxic training rows come from how densely their features are typical of toxic
rows, cut at the terciles: 0 is clean, 1 to 3 rising severity.  A feature is
typical by its smoothed log odds over the training rows, weighted by the root of
its count; the model's sparse weights are of typical features.  One weight vector
serves all ordered thresholds, ``P(grade > k) = sigmoid(w.x - theta_k)``, fitted by
FTRL on about ``max_rows`` labelled rows at most (a documented bound), split by hash
into shards whose weights and thresholds are averaged.  Features are counted slice by
slice and added up by a group-by; a shard's task holds only the typical features of
its rows, never their texts.  A text's
severity is its expected grade, the sum of ``P(grade > k)``; it is toxic where
``P(grade > 0) >= CUT``.

Cases: a null text counts as empty and has the thresholds' own severity; repeated
rows are scored each; without toxic labels nothing is toxic and severity is 0; of
several labels of a document the largest counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import bounded_batches, bytes_of, settle, spans_of_rows, text_of
from graphmill.llm.ftrl import Ftrl
from graphmill.llm.quality import training_rows
from graphmill.llm.words import ALNUM_ONLY, words

BITS, GRADES = 24, 4
PREFIXES = (4, 5, 6, 7, 8)
SLICE = 1 << 20
#: A feature is typical of toxic rows from this many of them and this weighted log odds.
MIN_ROWS, MIN_ODDS = 4, 3.0
SEEN_ROWS = 30_000
CUT = 0.25


def _hits(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
    """Sorted distinct ``row << BITS | feature`` of a run of texts; only of ``wanted`` features (a mask) if given."""
    w = words(data, offsets, ALNUM_ONLY, prefixes=PREFIXES)
    row, shift, found = w.rows(), np.uint64(64 - BITS), []
    for h, at in ((w.hash, slice(None)), *w.begun):
        feature, r = (h >> shift).astype(np.int64), row[at]
        if wanted is not None:
            ok = wanted[feature]
            feature, r = feature[ok], r[ok]
        found.append(r << BITS | feature)
    return np.unique(np.concatenate(found))


def _rows(texts: pa.Array):
    """Per text its features."""
    data, offsets = bytes_of(texts)
    for first, end in spans_of_rows(offsets, SLICE):
        key = _hits(data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first])
        cut = np.searchsorted(key, np.arange(end - first + 1) << BITS)
        feature = (key & ((1 << BITS) - 1)).astype(np.int32)
        yield from (feature[a:b] for a, b in zip(cut[:-1], cut[1:]))


def typical(rows: DataFrame) -> np.ndarray:
    """Ascending features that are typical of toxic rows, from rows ``text, toxic``."""
    def count(batches):
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            bad = batch.column("toxic").to_numpy(zero_copy_only=False)
            for first, end in spans_of_rows(offsets, SLICE):
                key = _hits(data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first])
                at, place = np.unique(key & ((1 << BITS) - 1), return_inverse=True)
                n, toxic = np.bincount(place, minlength=len(at)), np.bincount(place, bad[first + (key >> BITS)], len(at))
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(toxic.astype(np.int64)), pa.array(n - toxic.astype(np.int64))],
                                                 names=["i", "bad", "good"])

    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0)).alias("bad")).first()
    sums = rows.select("text", "toxic").mapInArrow(count, "i long, bad long, good long").groupBy("i").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (total["bad"] + 1)) - F.log((F.col("good") + 0.5) / (total["n"] - total["bad"] + 1))
    some = sums.where((F.col("bad") >= MIN_ROWS) & (odds * F.sqrt("bad") >= MIN_ODDS)).select("i")
    return np.sort(some.toPandas()["i"].to_numpy(np.int64))  # typical features of a bounded number of rows, 2**BITS at most


def known_features(rows: DataFrame, ids: np.ndarray) -> DataFrame:
    """``shard, toxic, size, own``: per row of ``text, toxic, shard`` its number of features and the places of its own in ``ids``."""
    sent = rows.sparkSession.sparkContext.broadcast(ids)

    def run(batches):
        ids = sent.value
        mask = np.zeros(1 << BITS, bool)
        mask[ids] = True
        for batch in batches:
            kept = list(_rows(batch.column("text")))
            own = [np.searchsorted(ids, i[mask[i]]) for i in kept]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("toxic"), pa.array([len(i) for i in kept], pa.int64()),
                                              pa.array(own, pa.list_(pa.int64()))], names=["shard", "toxic", "size", "own"])

    return rows.select("text", "toxic", "shard").mapInArrow(run, "shard long, toxic boolean, size long, own array<long>")


def grades(rows: DataFrame) -> DataFrame:
    """``rows`` with ``grade``: 0, or 1 and more by the terciles of the toxic rows' densities."""
    density = F.size("own") / F.greatest("size", F.lit(1))
    cuts = rows.where("toxic").agg(F.percentile(density, F.array(*[F.lit(k / (GRADES - 1)) for k in range(1, GRADES - 1)])).alias("cuts")).first()["cuts"]
    steps = [(density > c).cast("int") for c in cuts or ()]
    return rows.withColumn("grade", F.when(F.col("toxic"), sum(steps, F.lit(1))).otherwise(0))


def _sigmoid(s):
    return 1.0 / (1.0 + np.exp(-np.clip(s, -30, 30)))


def train(rows: list[np.ndarray], grade: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by FTRL, one row at a time in a fixed random order."""
    model = Ftrl(dim, alpha=0.5, beta=1.0, l1=0.5, l2=0.1)
    gap = np.array([1.0, *[0.0] * (GRADES - 2)])  # theta_0, then logs of the steps up
    moved = np.full(GRADES - 1, 1e-6)
    rng = np.random.default_rng(1)
    for _ in range(1 + SEEN_ROWS // max(len(rows), 1)):
        for j in rng.permutation(len(rows)):
            i, y = rows[j], grade[j]
            w = model.weights(i)
            steps = np.exp(np.clip(gap[1:], -5, 3))
            theta = gap[0] + np.concatenate([[0.0], np.cumsum(steps)])
            s = _sigmoid(w.sum() - theta)  # P(grade > k)
            # the chance of the row's grade is the difference of two neighbours
            low, high = (s[y - 1] if y else 1.0), (s[y] if y < GRADES - 1 else 0.0)
            p = max(low - high, 1e-6)
            d = np.zeros(GRADES - 1)  # loss by s_k's argument
            if y:
                d[y - 1] = -low * (1 - low) / p
            if y < GRADES - 1:
                d[y] = high * (1 - high) / p
            model.update(i, np.full(len(i), d.sum()), w)
            back = np.concatenate([[-d.sum()], [-d[k:].sum() * steps[k - 1] for k in range(1, GRADES - 1)]])
            moved += back * back
            gap -= 0.1 * back / np.sqrt(moved)
    steps = np.exp(np.clip(gap[1:], -5, 3))
    return model.weights(), gap[0] + np.concatenate([[0.0], np.cumsum(steps)])


def fit(rows: DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, their weights, and the thresholds, from bounded rows ``text, label, shard``."""
    rows = rows.select("text", (F.col("label") > 0).alias("toxic"), F.col("shard").cast("long").alias("shard"))
    ids, none = typical(rows), np.full(GRADES - 1, np.inf)
    if not len(ids):
        return ids, np.zeros(0), none
    graded = grades(settle(known_features(rows, ids), "toxic-features"))
    size = len(ids)

    def run(batches):
        kept, grade = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("own")
            at = own.offsets.to_numpy()
            kept += np.split(own.values.to_numpy()[at[0]:at[-1]], at[1:-1] - at[0])
            grade += batch.column("grade").to_pylist()
        if any(grade):
            w, theta = train(kept, np.array(grade), size)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.arange(size), -1 - np.arange(len(theta))]), pa.array(np.r_[w, theta])], names=["i", "w"])

    # in a fixed order, so that a task that runs again gives the same weights
    parts = graded.repartition(shards, "shard").sortWithinPartitions("shard", "size", "grade", "own").select("own", "grade").mapInArrow(run, "i long, w double")
    model = parts.groupBy("i").agg(F.avg("w").alias("w")).toPandas()  # typical features and GRADES - 1 rows
    i, w = model["i"].to_numpy(np.int64), model["w"].to_numpy(float)
    if not len(i):
        return ids[:0], np.zeros(0), none
    none[-1 - i[i < 0]] = w[i < 0]
    return ids[i[i >= 0]], w[i >= 0], none


def severity(docs: DataFrame, labels: DataFrame, max_rows: int = 24_000, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, severity, grade, p_toxic, toxic`` of every row; ``grade`` is the likeliest."""
    given = docs.select(F.col(f"`{key}`").alias("doc_id"), text_of(text).alias("text"))
    model = fit(*training_rows(given, labels, "toxic", max_rows))
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # typical features of a bounded number of rows

    def run(batches):
        ids, weights, theta = sent.value
        w = np.zeros(1 << BITS, np.float32)
        w[ids] = weights
        wanted = w != 0
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            s = np.zeros(len(offsets) - 1)
            for first, end in spans_of_rows(offsets, SLICE):
                key = _hits(data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first], wanted)
                s[first:end] += np.bincount(key >> BITS, w[key & ((1 << BITS) - 1)], end - first)
            known = ~np.isinf(theta)
            over = np.where(known, _sigmoid(s[:, None] - np.where(known, theta, 0)), 0.0)
            each = np.c_[np.ones(len(s)), over] - np.c_[over, np.zeros(len(s))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(over.sum(1)), pa.array(each.argmax(1).astype(np.int32)), pa.array(over[:, 0]),
                 pa.array((over[:, 0] >= CUT).astype(np.int32))], names=["doc_id", "severity", "grade", "p_toxic", "toxic"])

    schema = given.select("doc_id").schema.add("severity", "double").add("grade", "integer").add("p_toxic", "double").add("toxic", "integer")
    return given.mapInArrow(run, schema)
