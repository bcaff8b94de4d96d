"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs of letters, digits and non-ASCII bytes; seeds are the
n-grams of the test items, as long as every copy of the wanted similarity must
share with its item (``seed_words``: at 0.8 four words for items from 16 words,
three from 6, the whole item below four).  The items are taken in blocks of at most
``BLOCK_CHARS`` characters (so whatever the size of the item table, what a task
holds is bounded); each block meets every document twice, without a shuffle:
first to count in how many documents each seed occurs, then to align.  Every seed
opens a candidate, which is aligned if enough of the item's words stand near it;
of the seeds of one passage the rarest in the corpus is
reported as its anchor.  A candidate's surroundings, wide enough for any
alignment of the wanted similarity, are aligned word by word (match +1, mismatch
and gap -1).  ``similarity`` is the number of matched words over the longer of
item and aligned stretch; 0.8 and more counts as contamination.

Equal items are looked for once, by the digest of their text, and joined with the
ids of all their rows at the end.

Cases: null texts count as empty and match nothing; items without a word have no
seed and match nothing; an item with a null id is an item like any
other; repeated items or documents give a row each; of several passages of one
item in a document the best is reported.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import bounded_batches, bytes_of, may_hold, settle, spans_of_rows, text_of, unused
from graphmill.llm.words import ALNUM_ONLY, ngrams, words

SIMILARITY = 0.8
BLOCK_CHARS = 4 << 20
SLICE = 1 << 20
#: A bit table over seed hashes lets most words pass by at the cost of one look-up.
FILTER_BITS = 22
_UNIT = 1 << 20


def seed_words(n: int, similarity: float) -> int:
    """Words that an item of ``n`` shares in an unbroken run with each stretch of that similarity.

    ``s`` matched words leave room for ``s / similarity - s`` others, each of which breaks one run.
    """
    least = max(1, int(np.ceil(similarity * n - 1e-9)))
    return min(-(-s // (int(s / similarity - s + 1e-9) + 1)) for s in range(least, min(n, least + 100) + 1))


class Block:
    """Word hashes of a block of items and the sorted seeds with the places where they occur."""

    def __init__(self, texts: list[str], similarity: float = SIMILARITY):
        data, offsets = bytes_of(pa.array(texts, pa.large_string()))
        w = words(data, offsets, ALNUM_ONLY)
        self.words = [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
        count = np.diff(w.first)
        least = {n: seed_words(n, similarity) for n in np.unique(count[count > 0]).tolist()}
        own = np.array([least.get(n, 0) for n in count.tolist()], np.int64)  # seed length of each item
        self.lengths = sorted(set(least.values()))
        rows, found = w.rows(), [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for n in self.lengths:
            h, at = ngrams(w, n)
            mine = own[rows[at]] == n if len(at) else np.zeros(0, bool)
            found.append((h[mine], at[mine]))
        h, at = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(h, kind="stable")
        h, at = h[order], at[order]
        self.seeds, self.cut = np.unique(h, return_index=True)
        self.cut = np.append(self.cut, len(h))
        self.item = w.rows()[at] if len(at) else at
        self.offset = at - w.first[self.item] if len(at) else at
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.seeds >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, data: np.ndarray, offsets: np.ndarray):
        """Per seed hit: text, word index in the text, seed; and the words."""
        w = words(data, offsets, ALNUM_ONLY)
        ats, seeds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in self.lengths:
            h, at = ngrams(w, n)
            near = np.flatnonzero(self.maybe[h >> np.uint64(64 - FILTER_BITS)])
            seed = np.searchsorted(self.seeds, h[near])
            ok = seed < len(self.seeds)
            ok[ok] = self.seeds[seed[ok]] == h[near[ok]]
            ats.append(at[near[ok]])
            seeds.append(seed[ok])
        at, seed = np.concatenate(ats), np.concatenate(seeds)
        row = np.searchsorted(w.first, at, "right") - 1
        return row, at - w.first[row], seed, w


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, matches, end in ``text``."""
    step = np.arange(len(text) + 1, dtype=np.int64) * _UNIT
    above, best = np.zeros(len(text) + 1, np.int64), (0, 0)
    for word in item:  # score in units of _UNIT, matches below
        row = above - _UNIT
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(text == word, _UNIT + 1, -_UNIT))
        row = np.maximum.accumulate(row + step) - step
        row[row < _UNIT] = 0
        end = int(row.argmax())
        best = max(best, (int(row[end]), end))
        above = row
    return best[0] // _UNIT, best[0] % _UNIT, best[1]


def _matches(block: Block, df: np.ndarray, row, at, seed, w, similarity: float):
    """Rows ``text, item, similarity, score, first byte, end byte, anchor's document count`` of a run of texts."""
    if not len(seed):
        return
    n = np.diff(block.cut)[seed]
    each = np.repeat(np.arange(len(seed)), n)
    place = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + block.cut[seed][each]
    row, at, seed, item, offset = row[each], at[each], seed[each], block.item[place], block.offset[place]
    order = np.lexsort((at, item, row))
    row, at, seed, item, offset = (x[order] for x in (row, at, seed, item, offset))
    edge = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]), True])
    for a, b in zip(edge[:-1], edge[1:]):
        own, text = block.words[item[a]], w.hash[w.first[row[a]]:w.first[row[a] + 1]]
        spare = int(np.ceil(len(own) / similarity)) - len(own) + 1  # words that the text may have between
        low = np.maximum(at[a:b] - offset[a:b] - spare, 0)
        high = at[a:b] + len(own) - offset[a:b] + spare
        order = np.argsort(low)
        low, high, came = low[order], np.maximum.accumulate(high[order]), seed[a:b][order]
        part = np.flatnonzero(np.r_[True, low[1:] > high[:-1], True])
        best = None
        for i, j in zip(part[:-1], part[1:]):
            seen = text[low[i]:high[j - 1]]
            if np.isin(own, seen).sum() < similarity * len(own) - 1e-9:
                continue
            score, same, end = align(own, seen)
            alike = same / max(len(own), 2 * same - score)
            if alike >= similarity and (best is None or alike > best[0]):
                back = align(own[::-1], seen[:end][::-1])[2]
                best = alike, score, low[i] + end - back, low[i] + end, int(df[came[i:j]].min())
        if best:
            first = w.first[row[a]]
            yield row[a], item[a], best[0], best[1], w.start[first + best[2]], w.end[first + best[3] - 1], best[4]


def passages(docs: DataFrame, texts: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, digest, similarity, score, start, end, anchor_docs`` of the aligned passages of distinct item texts ``digest, item``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    given = docs.select(F.col(f"`{key}`").alias("doc_id"), text_of(text).cast("binary").alias("t"))
    chars = texts.agg(F.sum(F.length("item"))).first()[0] or 0
    blocks = 1 + 2 * chars // BLOCK_CHARS
    schema = given.select("doc_id").schema.add("item_no", "long").add("similarity", "double").add("score", "long") \
        .add("start", "long").add("end", "long").add("anchor_docs", "long")
    out = None
    for k in range(blocks):
        some = texts.where(F.pmod(F.xxhash64("digest"), F.lit(blocks)) == k) if blocks > 1 else texts
        rows = some.collect()  # distinct texts of about BLOCK_CHARS / 2 characters
        block = Block([r["item"] for r in rows], similarity)
        sent = spark.sparkContext.broadcast(block)

        def count(batches, sent=sent):
            block = sent.value
            total = np.zeros(len(block.seeds), np.int64)
            for batch in batches:
                data, offsets = bytes_of(batch.column(0))
                for first, end in spans_of_rows(offsets, SLICE):
                    row, _, seed, _ = block.hits(data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first])
                    if len(row):
                        total += np.bincount(np.unique(row * len(total) + seed) % len(total), minlength=len(total))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["seed", "n"])

        counts = given.select("t").mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect()
        df = np.zeros(len(block.seeds), np.int64)  # one number a seed of this block
        for r in counts:
            df[r["seed"]] = r["n"]
        sent_df = spark.sparkContext.broadcast(df)

        def find(batches, sent=sent, sent_df=sent_df):
            block, df = sent.value, sent_df.value
            for batch in batches:
                data, offsets = bytes_of(batch.column(1))
                found = []
                for first, end in spans_of_rows(offsets, SLICE):
                    row, at, seed, w = block.hits(data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first])
                    for r, *rest, start, stop, docs_of in _matches(block, df, row, at, seed, w, similarity):
                        begin = offsets[first + r] - offsets[first]
                        found.append((first + r, *rest, start - begin, stop - begin, docs_of))
                cols = list(zip(*found)) if found else [()] * 7
                ids = batch.column(0).take(pa.array(cols[0], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array([float(x) if t == pa.float64() else int(x) for x in c], t) for c, t in zip(
                        cols[1:], (pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))]],
                    names=schema.names)

        names = spark.createDataFrame([(i, bytes(r["digest"])) for i, r in enumerate(rows)], "item_no long, digest binary")
        part = given.mapInArrow(find, schema).join(F.broadcast(names), "item_no")  # one row a distinct text of this block
        out = part if out is None else out.unionByName(part)
    return out.select("doc_id", "digest", "similarity", "score", "start", "end", "anchor_docs")


def distinct_texts(items: DataFrame, text: str = "text") -> DataFrame:
    """``digest, item``: each text of ``items`` once."""
    item = items.select(text_of(text).alias("item"))
    return settle(item.select(_digest("item").alias("digest"), "item").groupBy("digest").agg(F.min("item").alias("item")), "items")


def _digest(name: str):
    return F.unhex(F.sha2(F.col(name).cast("binary"), 256))


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Pairs of documents and items with an aligned passage.

    ``doc_id, item_id, similarity, score, start, end, anchor_docs``: the passage
    as UTF-8 bytes ``[start, end)`` of the text, and the number of documents that
    hold the rarest of its seeds.
    """
    ids = items.select(F.col(f"`{item_key}`").alias("item_id"), text_of(item_text).alias("item")).select("item_id", _digest("item").alias("digest"))
    found = settle(passages(docs, distinct_texts(items, item_text), key, text, similarity), "passages")
    return found.join(ids, "digest").select("doc_id", "item_id", "similarity", "score", "start", "end", "anchor_docs")


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a passage of an item; only rows that may be dropped are moved."""
    own = unused(docs, "own_id")
    gone = settle(passages(docs, distinct_texts(items), key, text).select(F.col("doc_id").alias(own)).distinct(), "contaminated")
    some, others = may_hold(docs, F.xxhash64(F.col(f"`{key}`")), gone.select(F.xxhash64(own).alias("k")), gone.count())
    return others.unionByName(some.join(gone, F.col(own).eqNullSafe(F.col(f"`{key}`")), "left_anti"))
