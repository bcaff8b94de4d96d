"""Repeated-substring removal by blockwise suffix sorting with difference-cover ranks.

A byte goes when some ``LENGTH``-byte string that covers it also starts earlier
(smaller id, or same document and smaller offset).  All such strings of all
documents are the first ``LENGTH`` bytes of suffixes, so equal ones are neighbours
in suffix order; only suffixes that may have an equal are ever sorted, bucket by
bucket.

1. Anchors.  A string's anchor is its ``GRAM``-byte substring of least hash (the
   leftmost of equals), substrings that are common in the corpus coming last: a first
   pass counts all substrings in a sketch of fixed size, and the slots with 1 /
   ``COMMON`` of all places or more, at most ``COMMON``, are common.  So a string at the edge of a passage
   that all documents share is anchored outside it.  Strings with one anchor
   make a run of starts; equal strings have equal anchors at equal offsets, so a suffix
   bucket is an anchor's hash.
2. A run's record (anchor, 128-bit digest of the text that the run covers, place) goes to
   its bucket.  Runs of equal digest are equal throughout: all but the first are
   repeats as they stand; a task sends on the first of those that it meets itself, so a
   run that a third of all documents hold is one record a task.  The firsts of
   buckets with several digests are left.
3. Those runs' texts go to their buckets, and each bucket's suffixes are sorted a
   block at a time.  Texts are laid out so that the anchor is at residue 0 modulo
   ``PERIOD``; the suffixes at the residues of a difference cover are ranked first, by
   ``LENGTH`` bytes.  Any suffix is then compared by its few bytes before the next
   cover position and by that position's rank, so long ties cost one number.
   Neighbours of ``LENGTH`` equal bytes are one class, of which the first stays.
   A bucket of more than ``BLOCK`` bytes is dealt finer: its suffixes go one by one to
   buckets by the hash of their ``LENGTH`` bytes, and are sorted there.
4. Documents that have repeats are joined with them and cut; the others aren't moved.

Records and texts arrive sorted by bucket (Spark's sort spills), so a task holds a
batch of records, or a block of texts, whatever its partition has; the number of
partitions follows the number of runs.

Cases: a null text counts as empty; texts under ``LENGTH`` bytes lose nothing; rows
with a null id come after all others; rows with one id and one text are one
document, which is not its own repeat; rows with one id and different texts come
in the order of a digest of the text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import bounded_batches, bytes_of, may_hold, settle, spans_of_rows, text_of
from graphmill.llm.words import BASE, U, _power_table, mix

LENGTH, GRAM, PERIOD = 100, 36, 32
GRAMS = LENGTH - GRAM + 1
SLICE, BLOCK, BATCH = 1 << 18, 1 << 20, 4 << 20
#: Slots of the sketch of substrings, and the share of places that makes one common.
SLOT_BITS, COMMON, LEAST_COMMON = 22, 1 << 16, 256
#: Runs that a partition holds, about.
PARTITION_RUNS = 1 << 21
LAST_ID = (1 << 63) - 1
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def cover(period: int) -> list[int]:
    """A difference cover: every residue is a difference of two of its members (found greedily)."""
    chosen, have = [0], {0}
    while len(have) < period:
        best = max(range(period), key=lambda c: len({(c - d) % period for d in chosen} | {(d - c) % period for d in chosen} | have))
        chosen.append(best)
        have |= {(a - b) % period for a in chosen for b in chosen}
    return sorted(chosen)


COVER = np.array(cover(PERIOD))
#: Per residue the distance to the next cover position.
TO_COVER = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at every position."""
    n = len(data)
    if n < GRAM:
        return np.zeros(0, np.uint64)
    powers, back = _power_table("up", BASE, n + 1), _power_table("down", pow(BASE, -1, 1 << 64), n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[:n], out=sums[1:])
    return mix((sums[GRAM:] - sums[:-GRAM]) * back[:n - GRAM + 1])


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> U(64 - SLOT_BITS)).astype(np.int64)


def runs(data: np.ndarray, offsets: np.ndarray, common: np.ndarray | None = None):
    """Runs of string starts with one anchor: ``text, first start in it, starts, anchor - start, hash``.

    ``common``: true for the slots of substrings that are anchors only where there is no other.
    """
    n = len(data) - LENGTH + 1
    if n <= 0:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
    h = gram_hashes(data)
    at = np.arange(len(h))
    order = h >> U(1)
    if common is not None:
        order |= common[_slot(h)].astype(np.uint64) << U(63)
    key = (order & U(0xFFFFFFFF00000000)) | at.astype(np.uint64)  # not common, least hash, then leftmost
    width = 1
    while 2 * width <= GRAMS:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    key = np.minimum(key[:n], key[GRAMS - width:GRAMS - width + n])
    anchor = (key & U(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    whole = np.arange(n) + LENGTH <= offsets[1:][row]
    new = whole.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~whole[:-1] | (row[1:] != row[:-1])
    low = np.flatnonzero(new)
    count = np.diff(np.r_[np.cumsum(whole)[low] - 1, whole.sum()])
    return row[low], low - offsets[row[low]], count, anchor[low] - low, h[anchor[low]]


def _pieces(offsets: np.ndarray):
    """Ranges ``(text, byte range)`` of a long text, or of several whole texts, of about ``SLICE`` bytes."""
    for first, end in spans_of_rows(offsets, SLICE):
        if end == first + 1:
            for s in range(offsets[first], max(offsets[end] - LENGTH + 1, offsets[first] + 1), SLICE):
                yield first, end, s, min(s + SLICE + LENGTH - 1, offsets[end])
        else:
            yield first, end, offsets[first], offsets[end]


def _packed(lo: np.ndarray, n: np.ndarray, back: np.ndarray) -> np.ndarray:
    """A run's place in its text, as one number that sorts by its start."""
    return lo << 16 | n << 8 | back


def _changes(*cols) -> np.ndarray:
    """True where a sorted row differs from the one before."""
    out = np.ones(len(cols[0]), bool)
    out[1:] = False
    for x in cols:
        out[1:] |= x[1:] != x[:-1]
    return out


REPEAT, RECORD = 0, 1
_COLUMNS = ("kind", "h", "c", "d", "ord", "sub", "at")
_RECORDS = "kind int, h long, c long, d long, ord long, sub long, at long"


def _rows(kind: int, *cols: np.ndarray, names=_COLUMNS) -> pa.RecordBatch:
    cols = [x.view(np.int64) if x.dtype == np.uint64 else x for x in cols]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(cols[0]), kind, np.int32)), *map(pa.array, cols)], names=list(names))


def _records(batch, common):
    """Records of a batch ``ord, sub, bytes``: of the equal runs of a slice the first is a record, the others are repeats."""
    order, sub = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    data, offsets = bytes_of(batch.column(2))
    digest = xxhash.xxh3_128_digest
    for first, end, s, e in _pieces(offsets):
        body = data[s:e]
        row, lo, n, back, h = runs(body, np.clip(offsets[first:end + 1], s, e) - s, common)
        if not len(row):
            continue
        begin = np.clip(offsets[first:end + 1], s, e)[row] - s + lo
        view = memoryview(body.tobytes())
        pair = np.frombuffer(b"".join([digest(view[a:b]) for a, b in zip(begin.tolist(), (begin + n + (LENGTH - 1)).tolist())]), np.int64).reshape(-1, 2)
        shift = s - offsets[first] if end == first + 1 else 0
        o, u, at = order[first + row], sub[first + row], _packed(lo + shift, n, back)
        by = np.lexsort((at, u, o, pair[:, 1], pair[:, 0], h))
        h, c, d, o, u, at = h[by], pair[by, 0], pair[by, 1], o[by], u[by], at[by]
        new = _changes(h, c, d)
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        other = (o != o[head]) | (u != u[head]) | (at != at[head])
        yield _rows(RECORD, h[new], c[new], d[new], o[new], u[new], at[new])
        if other.any():
            zero = np.zeros(int(other.sum()), np.int64)
            yield _rows(REPEAT, mix((o[other] ^ u[other]).view(np.uint64)), zero, zero, o[other], u[other], at[other])


_OPEN = "kind int, h long, ord long, sub long, at long"
_OPEN_COLUMNS = ("kind", "h", "ord", "sub", "at")


def _firsts(batches):
    """Task code over records sorted by (kind, h, c, d, place): repeats, and the first places of buckets with several digests."""
    head = None  # of the last bucket so far: the first record of its last digest, and whether it has several digests
    for batch in batches:
        kind, h, c, d, o, u, at = (batch.column(k).to_numpy() for k in range(7))
        old = kind == REPEAT
        if old.any():
            yield _rows(REPEAT, h[old], o[old], u[old], at[old], names=_OPEN_COLUMNS)
        if old.all():
            continue
        h, c, d, o, u, at = (x[~old] for x in (h, c, d, o, u, at))
        if head is not None:  # the place that the first rows may repeat, put in front
            h, c, d, o, u, at = (np.r_[np.int64(x), y] for x, y in zip(head["row"], (h, c, d, o, u, at)))
        new_h, new = _changes(h), _changes(h, c, d)
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        bucket = np.cumsum(new_h) - 1
        digests = np.bincount(bucket, new).astype(np.int64)
        several = digests > 1
        if head is not None:
            several[0] |= head["several"]
        repeat = (o != o[first]) | (u != u[first]) | (at != at[first])
        is_open = new & several[bucket]
        if head is not None and head["several"]:
            is_open[0] = False  # given before
        if repeat.any():
            yield _rows(REPEAT, mix((o[repeat] ^ u[repeat]).view(np.uint64)), o[repeat], u[repeat], at[repeat], names=_OPEN_COLUMNS)
        if is_open.any():
            yield _rows(RECORD, h[is_open], o[is_open], u[is_open], at[is_open], names=_OPEN_COLUMNS)
        k = int(first[-1])
        head = {"row": [x[k] for x in (h, c, d, o, u, at)], "several": bool(several[-1])}


def _word8(text: np.ndarray) -> np.ndarray:
    """Big-endian 8-byte words at every position."""
    out = np.zeros(len(text) - 7, np.uint64)
    for k in range(8):
        out = out << U(8) | text[k:len(text) - 7 + k].astype(np.uint64)
    return out


def sort_block(texts: list[bytes], back: np.ndarray, count: np.ndarray, group: np.ndarray):
    """Classes of equal strings among the suffixes of a block.

    ``texts[i]`` holds ``count[i]`` string starts and its anchor at ``back[i]``.
    Gives, in suffix order within (group, residue): text, start in it, class.
    """
    size = np.array([len(t) for t in texts])
    pad = (-back) % PERIOD  # the anchor at residue 0
    slot = -(-(pad + size + LENGTH + PERIOD + 8) // PERIOD) * PERIOD
    begin = np.r_[0, np.cumsum(slot)[:-1]] + pad
    text = np.zeros(int(slot.sum()) + LENGTH + 16, np.uint8)
    for b, t in zip(begin, texts):
        text[b:b + len(t)] = np.frombuffer(t, np.uint8)
    word = _word8(text)
    owner = np.repeat(np.arange(len(texts)), count)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = begin[owner] + start
    residue = at % PERIOD
    ahead = TO_COVER[residue]
    # ranks of the cover sample that these suffixes lead to
    sample, where = np.unique(at + ahead, return_inverse=True)
    keys = [word[sample + k] for k in (*range(0, LENGTH - 8, 8), LENGTH - 8)]
    order = np.lexsort(keys[::-1])
    rank = np.empty(len(sample), np.int64)
    rank[order] = np.cumsum(_changes(*[k[order] for k in keys]))
    # the bytes before the cover position, then the rank
    before = []
    for k in range(0, int(TO_COVER.max()) or 1, 8):
        bits = np.clip(64 - 8 * (ahead - k), 0, 64)
        before.append(np.where(bits == 64, U(0), word[at + k] >> np.minimum(bits, 63).astype(np.uint64)))
    order = np.lexsort((rank[where], *before[::-1], residue, group[owner]))
    owner, start, at = owner[order], start[order], at[order]
    new = _changes(group[owner], residue[order])
    for k in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        new[1:] |= word[at[1:] + k] != word[at[:-1] + k]
    return owner, start, np.cumsum(new) - 1


def _blocks(batches, most: int):
    """Whole buckets of about ``most`` bytes from rows ``key, ord, sub, at, text`` sorted by key; a longer bucket comes
    in parts, each after the first led by the texts that the parts before had first."""
    held, size, begin, own = [], 0, 0, 0  # rows and their bytes; where the last bucket begins and its bytes
    for batch in batches:
        cols = [batch.column(k).to_numpy().tolist() for k in range(4)]
        for row in zip(*cols, batch.column(4).to_pylist()):
            if held and held[-1][0] != row[0]:
                if size >= most:
                    yield held, False
                    held, size = [], 0
                begin, own = len(held), 0
            if own >= 2 * most:
                if begin:
                    yield held[:begin], False
                kept = yield held[begin:], True
                held, begin = list(kept), 0
                size = own = sum(len(r[4]) for r in held)
            held.append(row)
            size, own = size + len(row[4]), own + len(row[4])
    if held:
        yield held, False


def _sorted_repeats(batches, most: int = BLOCK):
    """Task code: repeats among the suffixes of the buckets of a task."""
    blocks = _blocks(batches, most)
    block = next(blocks, None)
    while block is not None:
        rows, more = block
        key, o, u, packed = (np.array(x, np.int64) for x in list(zip(*rows))[:4])
        texts = [r[4] for r in rows]
        lo, n, back = packed >> 16, packed >> 8 & 255, packed & 255
        owner, start, klass = sort_block(texts, back, n, np.unique(key, return_inverse=True)[1])
        oo, uu, at = o[owner], u[owner], lo[owner] + start
        by = np.lexsort((at, uu, oo, klass))
        oo, uu, at, klass, owner = oo[by], uu[by], at[by], klass[by], owner[by]
        new = _changes(klass)
        first = np.flatnonzero(new)[klass]
        gone = (oo != oo[first]) | (uu != uu[first]) | (at != at[first])
        kept = [rows[i] for i in np.unique(owner[new])]
        oo, uu, at = oo[gone], uu[gone], at[gone]
        by = np.lexsort((at, uu, oo))
        oo, uu, at = oo[by], uu[by], at[by]
        if len(at):
            new = _changes(oo, uu)
            new[1:] |= (at[1:] != at[:-1] + 1) & (at[1:] != at[:-1])
            begin = np.flatnonzero(new)
            end = np.r_[begin[1:], len(at)] - 1
            yield oo[begin], uu[begin], at[begin], at[end] - at[begin] + 1
        block = blocks.send(kept) if more else next(blocks, None)  # after a part there always is more


def _contexts(batch):
    """Rows ``key, ord, sub, at, text`` of a batch ``ord, sub, bytes, open``: texts of runs, or of single suffixes of a wide bucket."""
    data, offsets = bytes_of(batch.column("bytes"))
    lists = batch.column("open")
    many = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    at, h, wide = flat.field("at").to_numpy(), flat.field("h").to_numpy(), flat.field("wide").to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(many)), many)
    o, u = (batch.column(c).to_numpy()[row] for c in ("ord", "sub"))
    for narrow in np.array_split(np.flatnonzero(~wide), 1 + int((~wide).sum()) // 50_000):
        if len(narrow):
            begin = offsets[row[narrow]] + (at[narrow] >> 16)
            end = begin + (at[narrow] >> 8 & 255) + (LENGTH - 1)
            body = pa.array([data[a:b].tobytes() for a, b in zip(begin, end)], pa.binary())
            yield pa.RecordBatch.from_arrays([*map(pa.array, (h[narrow], o[narrow], u[narrow], at[narrow])), body], names=["key", "ord", "sub", "at", "text"])
    for some in np.array_split(np.flatnonzero(wide), 1 + int(wide.sum()) // 1_000):
        if len(some):
            n = at[some] >> 8 & 255
            each, step = np.repeat(some, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            lo = (at[each] >> 16) + step
            strings = [data[a:a + LENGTH].tobytes() for a in offsets[row[each]] + lo]
            hashes = np.array([xxhash.xxh3_64_intdigest(x) for x in strings], np.uint64)
            cols = hashes.view(np.int64), o[each], u[each], _packed(lo, np.int64(1), np.int64(0))
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(strings, pa.binary())], names=["key", "ord", "sub", "at", "text"])


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Documents ``doc_id, ord, sub, bytes`` and the starts of their repeats, ``ord, sub, starts`` (arrays of place and number)."""
    spark = docs.sparkSession
    bounded_batches(spark, BATCH)
    given = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST_ID)).alias("ord"),
                        F.xxhash64(text_of(text)).alias("sub"), text_of(text).cast("binary").alias("bytes"))
    texts = given.where(F.length("bytes") >= LENGTH).select("ord", "sub", "bytes")

    def sketch(batches):
        count, held = np.zeros(1 << SLOT_BITS, np.int64), []
        for batch in batches:
            data, offsets = bytes_of(batch.column(0))
            for first, end, s, e in _pieces(offsets):
                held.append(_slot(gram_hashes(data[s:e])))
                if len(held) >= 8:
                    count += np.bincount(np.concatenate(held), minlength=len(count))
                    held = []
        if held:
            count += np.bincount(np.concatenate(held), minlength=len(count))
        total = int(count.sum())
        often = np.flatnonzero((count >= total / COMMON) & (count > 1))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[often, -1]), pa.array(np.r_[count[often], total])], names=["slot", "n"])

    slots = settle(texts.select("bytes").mapInArrow(sketch, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")), "slots")
    places = (slots.where("slot < 0").agg(F.sum("n")).first() or [0])[0] or 0
    common = np.zeros(1 << SLOT_BITS, bool)
    often = slots.where((F.col("slot") >= 0) & (F.col("n") >= LEAST_COMMON) & (F.col("n") * COMMON >= places)).select("slot")
    common[[r[0] for r in often.collect()]] = True  # COMMON at most
    sent = spark.sparkContext.broadcast(np.packbits(common))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + places // (GRAMS // 2) // PARTITION_RUNS)

    def records(batches):
        slots = np.unpackbits(sent.value).astype(bool)
        for batch in batches:
            yield from _records(batch, slots)

    dealt = texts.mapInArrow(records, _RECORDS).repartition(parts, "h").sortWithinPartitions("kind", "h", "c", "d", "ord", "sub", "at")
    found = settle(dealt.mapInArrow(_firsts, _OPEN), "places")

    left = found.where(F.col("kind") == RECORD).drop("kind")
    room = F.shiftright("at", 8).bitwiseAND(255) + (LENGTH - 1)
    wide = settle(left.groupBy("h").agg(F.sum(room).alias("size")).where(F.col("size") > block).select("h", F.lit(True).alias("wide")), "wide")
    left = left.join(wide, "h", "left").groupBy("ord", "sub").agg(
        F.collect_list(F.struct("at", "h", F.coalesce("wide", F.lit(False)).alias("wide"))).alias("open"))
    left = settle(left, "open-runs")
    there, _ = may_hold(texts, F.xxhash64("ord", "sub"), left.select(F.xxhash64("ord", "sub").alias("k")), left.count())

    def contexts(batches):
        for batch in batches:
            yield from _contexts(batch)

    schema = "key long, ord long, sub long, at long, text binary"
    bodies = there.join(left, ["ord", "sub"]).mapInArrow(contexts, schema).repartition(parts, "key").sortWithinPartitions("key", "ord", "sub", "at")

    def sort(batches):
        for o, u, at, n in _sorted_repeats(batches, block):
            yield pa.RecordBatch.from_arrays([*map(pa.array, (o, u, at, n))], names=["ord", "sub", "lo", "n"])

    same = found.where(F.col("kind") == REPEAT).select("ord", "sub", F.shiftright("at", 16).alias("lo"), F.shiftright("at", 8).bitwiseAND(255).alias("n"))
    every = same.unionByName(bodies.mapInArrow(sort, "ord long, sub long, lo long, n long"))
    return given, settle(every.groupBy("ord", "sub").agg(F.collect_list(F.struct("lo", "n")).alias("starts")), "repeats")


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the remaining bytes)."""
    given, starts = repeats(docs, key, text, block)
    schema = given.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long") \
        .add("kept_sha256", "string").add("kept", "binary")

    def run(batches):
        for batch in batches:
            data, offsets = bytes_of(batch.column("bytes"))
            lists = batch.column("starts")
            edge = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            lo, n = flat.field("lo").to_numpy(), flat.field("n").to_numpy()
            out = []
            for i in range(batch.num_rows):
                body = data[offsets[i]:offsets[i + 1]]
                step = np.zeros(len(body) + 1, np.int64)
                some = slice(edge[i], edge[i + 1])
                np.add.at(step, lo[some], 1)
                np.add.at(step, lo[some] + n[some] - 1 + LENGTH, -1)
                gone = np.cumsum(step[:-1]) > 0
                spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(gone) else 0
                kept = body[~gone].tobytes()
                out.append((len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())],
                names=schema.names)

    some, others = may_hold(given, F.xxhash64("ord", "sub"), starts.select(F.xxhash64("ord", "sub").alias("k")), starts.count())
    none = F.expr("CAST(array() AS array<struct<lo: bigint, n: bigint>>)")
    cut = some.join(starts, ["ord", "sub"], "left").select("doc_id", "bytes", F.coalesce("starts", none).alias("starts")).mapInArrow(run, schema)
    whole = others.select("doc_id", F.length("bytes").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                          F.lit(0).cast("long").alias("n_spans"), F.sha2("bytes", 256).alias("kept_sha256"), F.col("bytes").alias("kept"))
    return cut.unionByName(whole)
