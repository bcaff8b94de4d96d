"""Quality classifier: hashed word n-grams, logistic regression by FTRL, scores as sparse dot products.

Words are runs of letters, digits and non-ASCII bytes, or runs of ASCII
punctuation; a text's features are its word unigrams and bigrams, each hashed
to one of ``2**bits`` weights with the value ``count / sqrt(sum of count**2)``.
A word that follows itself makes the same bigram whatever the word.
The model is fitted by FTRL on at most about ``max_rows`` labelled rows (a
documented bound: the rows with the smallest hashes of their id), split by that
hash into shards of ``SHARD_ROWS`` rows, one task each, whose weights are averaged.  Scoring is one pass over
the documents with ``2**bits`` weights sent to each task, and no shuffle.

Cases: a null text counts as empty; an empty text has the score of the bias
alone; rows with a null ``doc_id`` are scored and never trained on, and their
``held_out`` is false; repeated rows are scored each; of several labels of a
document the largest counts; without usable labels every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import bounded_batches, bytes_of, spans_of_rows, text_of, unused
from graphmill.llm.ftrl import Ftrl
from graphmill.llm.words import PUNCT_APART, SAME, ngrams, words

BITS = 18
#: Rows that one task trains on, and rows it should have seen when small inputs are repeated.
SHARD_ROWS, SEEN_ROWS = 6_000, 12_000
#: The bigram of any word that follows itself.
REPEATED = np.uint64(0x5851F42D4C957F2D)
#: Bytes of text that are hashed at once.
SLICE = 1 << 20


def held_out(doc_id="doc_id"):
    """True for documents whose labels are kept from training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(data: np.ndarray, offsets: np.ndarray, bits: int):
    """Sorted ``(row, feature, value)`` arrays of a run of texts."""
    w = words(data, offsets, PUNCT_APART, SAME)
    pair, at = ngrams(w, 2)
    pair[w.hash[at] == w.hash[at + 1]] = REPEATED
    row = w.rows()
    shift = np.uint64(64 - bits)
    key = np.concatenate([row << bits | (w.hash >> shift).astype(np.int64),
                          row[at] << bits | (pair >> shift).astype(np.int64)])
    key, count = np.unique(key, return_counts=True)
    row, value = key >> bits, count.astype(np.float64)
    norm = np.sqrt(np.bincount(row, value * value, len(offsets) - 1))
    return row, key & ((1 << bits) - 1), value / norm[row]


def _scaled(texts: pa.Array, bits: int):
    """Per text its features; text by text, for training."""
    data, offsets = bytes_of(texts)
    for first, end in spans_of_rows(offsets, SLICE):
        row, i, x = features(data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first], bits)
        cut = np.searchsorted(row, np.arange(end - first + 1))
        for k in range(end - first):
            yield i[cut[k]:cut[k + 1]], x[cut[k]:cut[k + 1]]


def _sigmoid(s):
    return 1.0 / (1.0 + np.exp(-np.clip(s, -30, 30)))


def fit(rows: DataFrame, shards: int, bits: int = BITS) -> np.ndarray:
    """Weights (the bias last) from rows ``text, label``; ``rows`` must be bounded."""
    dim = (1 << bits) + 1

    def train(batches):
        model, kept, spare = Ftrl(dim), [], np.array([dim - 1])
        for batch in batches:
            y = batch.column("label").to_numpy(zero_copy_only=False)
            kept += [(np.append(i, spare), np.append(x, 1.0).astype(np.float32), t)
                     for (i, x), t in zip(_scaled(batch.column("text"), bits), y)]
        for _ in range(2 + SEEN_ROWS // max(len(kept), 1) if kept else 0):
            for i, x, t in kept:
                w = model.weights(i)
                model.update(i, (_sigmoid(w @ x) - t) * x, w)
        w = model.weights()
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w[at])], names=["i", "w"])

    parts = (rows.repartition(shards, "shard").select("text", "label").mapInArrow(train, "i long, w double"))
    mean = parts.groupBy("i").agg((F.sum("w") / shards).alias("w")).toPandas()  # 2**bits rows at most
    out = np.zeros(dim)
    out[mean["i"].to_numpy(np.int64)] = mean["w"].to_numpy(float)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, column: str, max_rows: int) -> tuple[DataFrame, int]:
    """``text, label, shard`` and the number of shards of about ``max_rows`` labelled documents outside the held-out fold."""
    spark = docs.sparkSession
    ids = (labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
           .groupBy("doc_id").agg(F.max(F.col(column)).cast("double").alias("label")))
    n = ids.count()
    shards = max(1, -(-min(n, max_rows) // SHARD_ROWS))
    if n > max_rows:  # the documented bound: a hash threshold
        cut = int((1 << 62) * (max_rows / n))
        ids = ids.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 2) < cut)
    # at most about max_rows rows of 16 bytes
    ids = F.broadcast(ids.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(shards))))
    bounded_batches(spark)
    return docs.select("doc_id", text_of().alias("text")).join(ids, "doc_id").select("text", "label", "shard"), shards


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the probability of label 1 of each whole text."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # 2**bits + 1 numbers
    keep = [c for c in docs.columns if c != name]

    def run(batches):
        w = sent.value
        for batch in batches:
            data, offsets = bytes_of(batch.column(len(keep)))
            s = np.full(len(offsets) - 1, w[-1])
            for first, end in spans_of_rows(offsets, SLICE):
                row, i, x = features(data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first], bits)
                s[first:end] += np.bincount(row, w[i] * x, end - first)
            cols = [batch.column(c) for c in keep] + [pa.array(_sigmoid(s))]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, name])

    given = docs.select(*[F.col(f"`{c}`") for c in keep], text_of().alias(unused(docs, "own_text")))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add(name, "double")
    return given.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 24_000) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 where ``score >= threshold``)."""
    weights = fit(*training_rows(docs, labels, "quality", max_rows))
    return score(docs, weights).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
