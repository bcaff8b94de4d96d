"""Phrase collocations by prefix-free parsing.

Texts are parsed into chunks that end after a word whose hash, taken with the word
before it, is 0 modulo ``TRIGGER`` (content alone decides; ``LONGEST`` words at the
latest) and that reach up to three words of the same piece into the next chunk.  Equal
chunks are one entry of a dictionary with its parse frequency, so a passage that a
million documents share is looked at once.  Phrases are counted inside the distinct
chunks, weighted by frequency; an occurrence belongs to the chunk in which it starts,
so the overlaps count once.

A phrase of ``least`` occurrences has no rarer part.  So the dictionary is read level
by level: words, then pairs of frequent words, then three and four words of frequent
pairs, each counted by 64-bit hash in Spark (summed up in the tasks first).  Which
hashes were frequent goes to the next level as a table of ``FILTER_BITS`` bits, a fixed
size: a clash or a full table lets more through and loses nothing.  At last the phrases that all
levels let through are counted as strings; within a task they are told apart by 128 bits.

Scores are floors of exact quotients (``DECIMAL(38,0)``).  Parts are looked up by
joins with the table of phrases; the first phrases of each language are found in salted
parts, then among the parts' firsts.

Cases: a null text counts as empty, a null language is ``und``; bytes that aren't ASCII
letters, spaces or marks belong to words; of equal scores the more frequent phrase, then
the first in byte order comes first; repeated rows count each; a language without a
candidate, or an empty table, has no rows; a piece that is longer than ``SLICE`` bytes
is held by a task as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphmill.llm.common import bounded_batches, bytes_of, settle, text_of
from graphmill.llm.words import LOWER, SAME, U, Words, mix, words

LONGEST_PHRASE, LEAST, COVERED, FIRST = 4, 30, 80, 2000
TRIGGER, LONGEST = 32, 256
SLICE = 1 << 20
#: Bits of a level's table of frequent hashes (16 MB).
FILTER_BITS = 27
#: Hashes that a task sums up before it hands them on.
HELD = 1 << 22
SALTS = 32

#: What parts pieces and words.
BREAKS = ".,;:!?\n\v\f\r"
GAPS = " \t"
_KINDS = np.ones(256, np.uint8)
_KINDS[[ord(c) for c in BREAKS + GAPS]] = 0
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in BREAKS]] = True
_FOLD = LOWER.copy()
_FOLD[9] = 32
#: Another reading of the bytes, for a second hash.
_OTHER = np.random.default_rng(11).permutation(256).astype(np.uint8)


def _pieces(data: np.ndarray, offsets: np.ndarray, w: Words) -> np.ndarray:
    """A number for each word that differs between pieces and between texts."""
    if not len(w.start):
        return np.zeros(0, np.int64)
    new = np.ones(len(w.start), bool)
    marks = np.cumsum(_BREAK[data])[w.start]
    rows = w.rows()
    new[1:] = (marks[1:] != marks[:-1]) | (rows[1:] != rows[:-1])
    return np.cumsum(new)


def _runs(data: np.ndarray, offsets: np.ndarray, size: int = SLICE):
    """Ranges of rows ``(first, end, from byte, to byte)`` of about ``size`` bytes; longer texts are cut behind a mark."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        at, stop = int(offsets[first]), int(offsets[end])
        while stop - at > size and end == first + 1:
            cut = at + size
            while cut < stop and not _BREAK[data[cut]]:
                more = np.flatnonzero(_BREAK[data[cut:cut + size]])
                cut += int(more[0]) if len(more) else size
            if cut >= stop:
                break
            yield first, end, at, cut + 1
            at = cut + 1
        yield first, end, at, stop
        first = end


def _gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as a binary array."""
    size = end - start
    cut = np.r_[0, np.cumsum(size)]
    body = data[np.arange(cut[-1]) + np.repeat(start - cut[:-1], size)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(body)]).cast(pa.binary())


def parse(data: np.ndarray, offsets: np.ndarray, trigger: int = TRIGGER, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of some texts: text, first byte, end byte (with the overlap), number of own words."""
    w = words(data, offsets, _KINDS, LOWER)
    n = len(w.start)
    if not n:
        return (np.zeros(0, np.int64),) * 4
    rows, piece, at = w.rows(), _pieces(data, offsets, w), np.arange(n)
    ends = np.ones(n, bool)
    ends[:-1] = rows[1:] != rows[:-1]
    before = np.r_[U(0), np.where(ends[:-1], U(0), w.hash[:-1])]  # none before a text's first word
    ends |= mix(before * U(0x9E3779B97F4A7C15) + w.hash) % U(trigger) == 0
    first = np.r_[0, np.flatnonzero(ends)[:-1] + 1]
    since = at - np.repeat(first, np.diff(np.r_[first, n]))
    ends |= since % longest == longest - 1
    last = np.flatnonzero(ends)
    first = np.r_[0, last[:-1] + 1]
    piece_end = np.searchsorted(piece, piece[last], "right") - 1
    reach = np.minimum(last + LONGEST_PHRASE - 1, piece_end)
    return rows[first], w.start[first], w.end[reach], last - first + 1


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", trigger: int = TRIGGER, longest: int = LONGEST, size: int = SLICE) -> DataFrame:
    """Distinct chunks: ``lang, chunk, own`` (words that are its own) and the parse frequency ``n``."""
    bounded_batches(docs.sparkSession)
    given = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), text_of(text).cast("binary").alias("t"))

    def run(batches):
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            for first, end, at, stop in _runs(data, offsets, size):
                body = data[at:stop]
                row, start, last, own = parse(body, np.clip(offsets[first:end + 1], at, stop) - at, trigger, longest)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + row)), _gather(_FOLD[body], start, last),
                                                  pa.array(own.astype(np.int32))], names=["lang", "chunk", "own"])

    chunks = given.mapInArrow(run, "lang string, chunk binary, own int")
    return settle(chunks.groupBy("lang", "chunk", "own").agg(F.count(F.lit(1)).alias("n")), "chunks")


class Grams:
    """Phrases that start at own words of some chunks, by their number of words."""

    def __init__(self, data, offsets, lang: np.ndarray, own: np.ndarray, weight: np.ndarray, fold: np.ndarray = SAME):
        w = self.words = words(data, offsets, _KINDS, fold)
        rows, piece = w.rows(), _pieces(data, offsets, w)
        at = np.arange(len(rows))
        self.weight = weight[rows]
        self.mine = at - w.first[rows] < own[rows]
        self.hash, self.whole = [mix(w.hash ^ lang[rows])], [np.ones(len(rows), bool)]
        for n in range(2, LONGEST_PHRASE + 1):
            h, whole = self.hash[-1].copy(), np.zeros(len(rows), bool)
            if len(rows) >= n:
                m = len(rows) - n + 1
                h[:m] = mix(h[:m] * U(0x100000001B3) + w.hash[n - 1:])
                whole[:m] = piece[:m] == piece[n - 1:]
            self.hash.append(h)
            self.whole.append(whole)

    def may(self, tables: list) -> list[np.ndarray]:
        """Per number of words: where a phrase starts all of whose parts, as far as ``tables`` know them, may be frequent."""
        out = []
        for n in range(1, LONGEST_PHRASE + 1):
            ok = self.whole[n - 1].copy()
            if n > 1:
                ok &= out[-1]
                ok[:-1] &= out[-1][1:]
            table = tables[n - 1] if n <= len(tables) else None
            if table is not None:
                slot = self.hash[n - 1] >> U(64 - (len(table) * 64 - 1).bit_length())
                ok &= (table[slot >> U(6)] >> (slot & U(63)) & U(1)).astype(bool)
            out.append(ok)
        return out


def _over_chunks(chunks: DataFrame, schema: str, task) -> DataFrame:
    given = chunks.select("lang", F.xxhash64("lang").alias("h"), "chunk", "own", "n")

    def run(batches):
        def slices():
            for batch in batches:
                data, offsets = bytes_of(batch.column(2))
                lang, own, n = (batch.column(k).to_numpy() for k in (1, 3, 4))
                for first, end, at, stop in _whole_rows(offsets):
                    yield batch.column(0).slice(first, end - first), data[at:stop], offsets[first:end + 1] - at, lang[first:end].view(np.uint64), \
                        own[first:end], n[first:end]
        yield from task(slices())

    return given.mapInArrow(run, schema)


def _whole_rows(offsets: np.ndarray):
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1)
        yield first, end, int(offsets[first]), int(offsets[end])
        first = end


def _summed(h: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    h, n = np.concatenate(h), np.concatenate(n)
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    cut = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    return h[cut], np.add.reduceat(n, cut) if len(cut) else n


def _frequent(chunks: DataFrame, lengths: list[int], tables: list, least: int, bits: int, most: int) -> list[np.ndarray]:
    """Per length of phrase a table of bits of the hashes of ``least`` occurrences and more."""
    spark = chunks.sparkSession
    sent = spark.sparkContext.broadcast(tables)

    def task(slices):
        held, size = {n: ([], []) for n in lengths}, 0

        def flush():
            for n in lengths:
                if held[n][0]:
                    h, c = _summed(*held[n])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), n, np.int32)), pa.array(h.view(np.int64)), pa.array(c)], names=["words", "h", "n"])

        for _, data, offsets, lang, own, weight in slices:
            grams = Grams(data, offsets, lang, own, weight)
            may = grams.may(sent.value)
            for n in lengths:
                at = np.flatnonzero(may[n - 1] & grams.mine)
                h, c = _summed([grams.hash[n - 1][at]], [grams.weight[at]])
                held[n][0].append(h)
                held[n][1].append(c)
                size += len(h)
            if size > most:
                for n in lengths:
                    h, c = _summed(*held[n])
                    held[n] = [h], [c]
                size = sum(len(held[n][0][0]) for n in lengths)
                if size > most // 2:
                    yield from flush()
                    held, size = {n: ([], []) for n in lengths}, 0
        yield from flush()

    counts = _over_chunks(chunks, "words int, h long, n long", task).groupBy("words", "h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    slot = F.shiftrightunsigned("h", 64 - bits)
    found = counts.groupBy("words", F.shiftright(slot, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {64 - bits}) & 63 AS INT))")).alias("bits")).toArrow()  # at most 2 ** bits bits a length
    out, given, at, value = [], *(found.column(c).to_numpy() for c in ("words", "at", "bits"))
    for n in lengths:
        table = np.zeros(1 << bits - 6, np.uint64)
        table[at[given == n]] = value[given == n].view(np.uint64)
        out.append(table)
    return out


def phrases(chunks: DataFrame, least: int = LEAST, bits: int = FILTER_BITS, held: int = HELD) -> DataFrame:
    """``lang, phrase, words, f``: the phrases of one to four words with ``least`` occurrences and more."""
    tables: list = []
    for lengths in ([1], [2], [3, 4]):
        tables += _frequent(chunks, lengths, tables, least, bits, held)
    sent = chunks.sparkSession.sparkContext.broadcast(tables)
    schema = "lang string, phrase string, words int, n long"

    def task(slices):
        for lang_name, data, offsets, lang, own, weight in slices:
            grams = Grams(data, offsets, lang, own, weight)
            other = Grams(data, offsets, lang, own, weight, _OTHER)
            w, rows = grams.words, grams.words.rows()
            for n, may in enumerate(grams.may(sent.value), 1):
                at = np.flatnonzero(may & grams.mine)
                if not len(at):
                    continue
                h, g = grams.hash[n - 1][at], other.hash[n - 1][at]
                order = np.lexsort((at, g, h))
                at, h, g = at[order], h[order], g[order]
                cut = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
                total, at = np.add.reduceat(grams.weight[at], cut), at[cut]
                body = _gather(data, w.start[at], w.end[at + n - 1])
                size = (w.end - w.start).cumsum()
                wide = np.flatnonzero(w.end[at + n - 1] - w.start[at] != size[at + n - 1] - size[at] + (w.end - w.start)[at] + n - 1)
                if len(wide):  # more than a space between words
                    body = body.to_pylist()
                    for k in wide:
                        body[k] = b" ".join(body[k].split(b" "))
                        while b"  " in body[k]:
                            body[k] = body[k].replace(b"  ", b" ")
                    body = pa.array(body, pa.binary())
                yield pa.RecordBatch.from_arrays([lang_name.take(pa.array(rows[at])), body.cast(pa.string()), pa.array(np.full(len(at), n, np.int32)),
                                                  pa.array(total)], names=["lang", "phrase", "words", "n"])

    found = _over_chunks(chunks, schema, task)
    return settle(found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).where(F.col("f") >= least), "phrases")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, covered: int = COVERED, first: int = FIRST) -> DataFrame:
    """Per language its ``first`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``a, l, r``: occurrences of the phrase, of its first words and of the rest at the lowest-scoring cut; ``n``: all
    words; ``score``: ``floor(2000000 * a / (l + r))``.  Phrases are left out that lie in a longer one of ``covered`` per cent
    of their occurrences.
    """
    chunks = dictionary(docs, text, lang)
    return rank(chunks, phrases(chunks, least), covered, first)


def rank(chunks: DataFrame, table: DataFrame, covered: int = COVERED, first: int = FIRST) -> DataFrame:
    """The result of ``collocations`` from the chunks and their phrases."""
    n = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("n"))
    many = table.where("words > 1")
    cuts = many.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("tail", F.expr("substring_index(phrase, ' ', k - words)"))
    heads = table.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = table.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    exact = "CAST(CAST(2000000 AS DECIMAL(38,0)) * a div (CAST(l AS DECIMAL(38,0)) + r) AS BIGINT)"
    cuts = settle(cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).select("lang", "phrase", "a", "k", "l", "r", F.expr(exact).alias("score")), "cuts")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    inner = F.expr("""flatten(transform(sequence(2, words - 1), m ->
        transform(sequence(1, words - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' '))))""")
    cover = table.where("words > 2").select("lang", "f", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    best, cover = settle(best, "best"), settle(cover, "cover")
    left = best.join(cover, ["lang", "phrase"], "left").where(
        F.expr(f"longer IS NULL OR 100 * CAST(longer AS DECIMAL(38,0)) < {covered} * CAST(a AS DECIMAL(38,0))"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("part")
    top = left.select("lang", part, "phrase", "a", "l", "r", "score").withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    top = settle(top.where(F.col("rank") <= first).drop("rank", "part"), "parts")
    top = top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return top.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, m AS words, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS m)),
f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE words > 1 AND f >= {LEAST}),
k AS (SELECT lang, words, phrase, a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
      FROM (SELECT *, unnest(range(1, words)) AS k FROM c)),
s AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * k.a // (x.f + y.f) AS BIGINT) AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.head AND x.words = k.k
             JOIN f y ON y.lang = k.lang AND y.phrase = k.tail AND y.words = k.words - k.k),
b AS (SELECT lang, phrase, a, l, r, score FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM s) WHERE o = 1),
i AS (SELECT lang, a, m, unnest([array_to_string(ws[j:j + m - 1], ' ') FOR j IN range(1, words - m + 2)]) AS phrase
      FROM (SELECT *, unnest(range(2, words)) AS m FROM c WHERE words > 2)),
o AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY ALL),
t AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase
      WHERE o.longer IS NULL OR 100 * CAST(o.longer AS HUGEINT) < {COVERED} * CAST(b.a AS HUGEINT))
SELECT t.lang, t.rank, t.phrase, t.a, t.l, t.r, n.n, t.score FROM t JOIN n ON n.lang = t.lang WHERE t.rank <= {FIRST}"""
