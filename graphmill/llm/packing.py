"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

``pieces`` tokenises each whole text and appends one end id; documents longer
than a sequence are cut into full pieces, the first piece taking the rest.  Full
pieces are sequences by themselves.  The others are dealt evenly over blocks of
about ``BLOCK_ITEMS``.  For each block ``ISLANDS`` populations of packings evolve:
crossover injects whole well-filled bins of one parent into another, takes out
the bins that hold the same pieces, and best-fits the displaced pieces, largest
first.  After each epoch an island's elite migrates to its neighbour in a ring.
The best packing of a block stands; pieces of its poorly filled bins are dealt over
fewer blocks and packed again, until one block is left or a level frees no bin (then
the bins stay as they were).  A lone piece that no other piece fits beside is final.
Only lengths and small
records move; a block's size is bounded, whatever the input.

Cases: null texts count as empty and give a piece of the end id alone; repeated
rows give pieces of their own; ties in fill are broken at random from a fixed
seed; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import bounded_batches, settle, text_of

CAPACITY, END_ID = 1024, 2
BLOCK_ITEMS, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 4096, 3, 2, 8, 4
#: Bins filled to less than this share are packed again at the next level.
POOR = 0.97
#: Fixed value: how byte-level vocabularies split texts before merging.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes
    stand for themselves, the others take the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Encoder:
    """Token ids of whole texts as little-endian 32-bit bytes.

    A byte-level vocabulary whose ids follow its merges is a table of ranks, which
    the rank encoder reads about four times as fast as the tokenizer itself and to
    the same ids; any other vocabulary, and a text that the rank encoder
    refuses, goes to the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.ranks = Tokenizer.from_file(path), None
        with open(path, encoding="utf-8") as f:  # a file of the installed package, not an input
            given = json.load(f)
        model, split = given["model"], given["pre_tokenizer"] or {}
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        special = {t["content"]: t["id"] for t in given["added_tokens"]}
        plain = (given["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
                 and not model.get("ignore_merges") and all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges)))
        if plain:
            import tiktoken

            byte = _byte_of_char()
            ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
            self.ranks = tiktoken.Encoding("vocabulary", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> bytes:
        if self.ranks is not None:
            try:
                return self.ranks.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
            except BaseException as refused:  # a text beyond the rank encoder's limits; its panics are no Exceptions
                if isinstance(refused, (KeyboardInterrupt, SystemExit)):
                    raise
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, row`` of all pieces; ``row`` numbers a task's pieces."""
    path = tokenizer or default_tokenizer()
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
        row = 0
        for batch in batches:
            at, out = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                body = encoder.ids(t) + end
                n = len(body) // 4
                first = n if n <= capacity else n % capacity or capacity
                begin, stop, k = 0, first, 0
                while begin < n:
                    at.append(i)
                    out.append((k, begin, stop - begin, zlib.crc32(memoryview(body)[4 * begin:4 * stop]), row))
                    begin, stop, k, row = stop, stop + capacity, k + 1, row + 1
            cols = np.array(out, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(cols[:, 0].astype(np.int32)),
                 *[pa.array(cols[:, c]) for c in range(1, 5)]],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "row"])

    given = docs.select(F.col(f"`{key}`").alias("doc_id"), text_of(text).alias("t"))
    schema = given.select("doc_id").schema.add("piece", "integer").add("start", "long").add("length", "long") \
        .add("ids_crc32", "long").add("row", "long")
    return given.mapInArrow(run, schema)


class Bins:
    """A packing: the bin of each item and the fill of each bin."""

    def __init__(self, size: np.ndarray, capacity: int):
        self.size, self.capacity = size, capacity
        self.bin, self.fill = np.full(len(size), -1, np.int64), []

    def best_fit(self, items) -> None:
        """Put items, in this order, each where the least room is left."""
        room = sorted((self.capacity - f, b) for b, f in enumerate(self.fill) if 0 < f < self.capacity)
        spare = [b for b, f in enumerate(self.fill) if f == 0]
        for i in items:
            s = int(self.size[i])
            k = bisect_left(room, (s, -1))
            if k < len(room):
                left, b = room.pop(k)
            else:
                left, b = self.capacity, spare.pop() if spare else len(self.fill)
                if b == len(self.fill):
                    self.fill.append(0)
            self.bin[i] = b
            self.fill[b] += s
            if left > s:
                insort(room, (left - s, b))

    def cross(self, other: "Bins", rng) -> "Bins":
        """A child: well-filled bins of ``other`` whole, what they don't touch from here, the rest best-fitted."""
        fill = np.array(other.fill)
        good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
        chosen = np.zeros(len(fill), bool)
        chosen[rng.choice(good, max(1, len(good) // 4), replace=False)] = True
        moved = chosen[other.bin]
        hit = np.zeros(len(self.fill), bool)
        hit[self.bin[moved]] = True
        poor = np.array(self.fill)
        hit |= (poor < self.capacity) & (rng.random(len(poor)) < 0.3)  # some bins that aren't full, too
        displaced = np.flatnonzero(hit[self.bin] & ~moved)
        child = Bins(self.size, self.capacity)
        label = np.where(moved, len(self.fill) + other.bin, self.bin)
        stay = np.ones(len(label), bool)
        stay[displaced] = False
        _, child.bin[stay] = np.unique(label[stay], return_inverse=True)
        child.fill = np.bincount(child.bin[stay], self.size[stay]).astype(int).tolist() if stay.any() else []
        child.best_fit(displaced[np.lexsort((rng.random(len(displaced)), -self.size[displaced]))])
        return child

    def worth(self) -> tuple[int, float]:
        """More is better: few bins, then uneven fills."""
        fill = np.array([f for f in self.fill if f])
        return -len(fill), float((fill.astype(float) ** 2).sum())


def _restore(size, capacity, bins) -> Bins:
    out = Bins(size, capacity)
    out.bin = np.asarray(bins, np.int64)
    out.fill = np.bincount(out.bin, size).astype(int).tolist()
    return out


def evolve(size: np.ndarray, capacity: int, given: list, seed: int, generations: int, population: int) -> list[Bins]:
    """An island's population after some generations, best first."""
    rng = np.random.default_rng(seed)
    alive = [_restore(size, capacity, g) for g in given]
    while len(alive) < population:
        one = Bins(size, capacity)
        jitter = 0.02 * len(alive) * rng.standard_normal(len(size))
        one.best_fit(np.argsort(-size * (1 + jitter), kind="stable"))
        alive.append(one)
    least = -(-int(size.sum()) // capacity)
    alive.sort(key=Bins.worth, reverse=True)
    for _ in range(generations):
        if -alive[0].worth()[0] <= least:
            break
        a, b = rng.choice(len(alive), 2, replace=False)
        alive.append(alive[a].cross(alive[b], rng))
        alive.sort(key=Bins.worth, reverse=True)
        del alive[population:]
    return alive


def _islands(blocks: DataFrame, capacity: int, islands: int, epochs: int, generations: int, population: int) -> DataFrame:
    """``block, bins``: the best packing found for each block of ``blocks (block, sizes)``."""
    state = blocks.select("block", "sizes", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                          F.array().cast("array<array<int>>").alias("packings"))

    def run(batches, epoch=0):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                seed = abs(hash((r["block"], r["island"], epoch))) % (1 << 32)
                alive = evolve(np.array(r["sizes"], np.int64), capacity, r["packings"], seed, generations, population)
                out.append([x.bin.astype(np.int32) for x in alive])
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("sizes"), batch.column("island"),
                 pa.array(out, pa.list_(pa.list_(pa.int32()))), pa.array([int(x[0].max()) for x in out], pa.int32())],
                names=["block", "sizes", "island", "packings", "last"])

    schema = "block long, sizes array<int>, island int, packings array<array<int>>, last int"
    for epoch in range(epochs):
        state = settle(state.repartition("block", "island").mapInArrow(lambda b, e=epoch: run(b, e), schema), "islands")
        if epoch + 1 < epochs:  # the elite goes to the next island of the ring
            elite = state.select("block", ((F.col("island") + 1) % islands).alias("island"),
                                 F.col("packings")[0].alias("elite"))
            state = state.join(elite, ["block", "island"]).select(
                "block", "sizes", "island",
                F.concat(F.array("elite"), F.slice("packings", 1, population - 1)).alias("packings"))
    return state.groupBy("block").agg(F.min_by(F.col("packings")[0], F.struct("last", "island")).alias("bins"))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id",
         text: str = "text", block_items: int = BLOCK_ITEMS, islands: int = ISLANDS, epochs: int = EPOCHS,
         generations: int = GENERATIONS, population: int = POPULATION) -> DataFrame:
    """Per piece ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    every = settle(pieces(docs, tokenizer, capacity, end_id, key, text), "pieces")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    done = [every.where(F.col("length") == capacity).select(
        *cols, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest = every.where(F.col("length") < capacity).withColumn("part", F.spark_partition_id())
    level, base, carried, bins = 0, 0, None, 0
    while True:
        n = rest.count()
        if not n:
            break
        blocks = -(-n // block_items)
        dealt = rest.withColumn("block", F.pmod(F.xxhash64("row", "part", "ids_crc32", F.lit(level)), F.lit(blocks)))
        dealt = settle(dealt.groupBy("block").agg(F.collect_list(F.struct(*cols, "row", "part")).alias("items")), "blocks")
        best = _islands(dealt.select("block", F.transform("items", lambda x: x["length"].cast("int")).alias("sizes")),
                        capacity, islands, epochs, generations, population)
        placed = (dealt.join(best, "block").select("block", F.inline(F.arrays_zip("items", "bins")))
                  .select("block", "items.*", F.col("bins").alias("bin")))
        by_bin = (placed.groupBy("block", "bin").agg(F.collect_list(F.struct("length", *[c for c in cols if c != "length"], "row", "part"))
                                                     .alias("items"), F.sum("length").alias("fill")))
        by_bin = settle(by_bin.select((F.col("block") * block_items * 4 + F.col("bin") + F.lit(base)).alias("sequence_id"), "items", "fill"), "bins")
        base += blocks * block_items * 4
        if carried is not None and by_bin.count() >= bins:
            keep, rest = carried, None  # this level freed no bin
        else:
            poor = F.lit(False)
            if blocks > 1:
                open_bins = by_bin.where(F.col("fill") < POOR * capacity)
                least = open_bins.agg(F.min(F.array_min(F.transform("items", lambda x: x["length"])))).first()[0]
                poor = (F.col("fill") < POOR * capacity) & ((F.size("items") > 1) | (F.col("fill") + F.lit(least) <= capacity))
            keep, carried = by_bin.where(~poor), by_bin.where(poor)
            bins = carried.count()
            rest = carried.select(F.inline("items")).select(*cols, "row", "part") if bins else None
        offsets = F.expr("transform(items, (x, i) -> aggregate(slice(items, 1, i), 0L, (s, y) -> s + y.length))")
        done.append(keep.select("sequence_id", F.inline(F.arrays_zip("items", offsets.alias("offset"))))
                    .select("items.*", "sequence_id", "offset").select(*cols, "sequence_id", "offset"))
        if rest is None:
            break
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*cols, "sequence_id", "offset")
