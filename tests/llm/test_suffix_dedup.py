"""Repeated strings against a plain count of all 100-byte strings."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphmill.llm import suffix_dedup
from graphmill.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_text_operators import AWKWARD, frame


def test_cover():
    for period in (7, 32, 64):
        c = suffix_dedup.cover(period)
        assert {(a - b) % period for a in c for b in c} == set(range(period))


def rows_of(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_documents(spark, sf, documents):
    small = sf.replace("sf0.01", "sf0.001")
    want = brute.repeats([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()])
    assert rows_of(QUERIES["op5_suffix"](spark, small)) == want and sum(v[1] for v in want.values()) > 0


@pytest.mark.parametrize("block, least", [(1 << 20, 256), (300, 2)])
def test_planted(spark, block, least, monkeypatch):
    """Copies, shared passages with other surroundings, a common line, periodic texts; whole and finer dealt buckets, no and many common substrings."""
    monkeypatch.setattr(suffix_dedup, "LEAST_COMMON", least)
    monkeypatch.setattr(suffix_dedup, "COMMON", 1 << 12)
    rng = random.Random(4)
    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))
    line, passage, whole = noise(90), noise(400), noise(700)
    rows = [(i, noise(rng.randrange(0, 300)) + rng.choice([line, passage, passage[50:200], "", "ab" * 150]) + noise(rng.randrange(0, 300))) for i in range(150)]
    rows += [(200 + i, whole) for i in range(100)] + [(300, whole + "x"), (301, "y" + whole), (302, whole[:99]), (303, whole[:100]), (304, "z" * 5000)]
    assert rows_of(suffix_dedup.cut_repeats(frame(spark, rows), block=block)) == brute.repeats(rows)


def test_long_text_in_pieces(spark):
    rng = random.Random(6)
    body = "".join(rng.choice("abcd") for _ in range(3000))
    rows = [(1, body), (2, body[:700] + "!" + body[700:]), (3, body[5:2500]), (4, None), (5, body + body), (6, "".join(rng.choice("abcd") for _ in range(2_400_000)) + body)]
    assert rows_of(suffix_dedup.cut_repeats(frame(spark, rows[:5]), block=2048)) == brute.repeats(rows[:5])
    got = rows_of(suffix_dedup.cut_repeats(frame(spark, rows), block=2048))
    assert got[6][1] == 3000 and {k: got[k] for k in range(1, 6)} == brute.repeats(rows[:5])


def test_firsts_are_the_same_in_any_batches():
    rng = random.Random(8)
    rows = sorted((1, rng.randrange(4), rng.randrange(3), 0, rng.randrange(9), 0, rng.randrange(5)) for _ in range(400))
    rows = [(0, 5, 0, 0, 1, 1, 1)] * 3 + rows

    def run(size):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 0 else pa.int64()) for k, c in enumerate(zip(*rows[i:i + size]))], names=list(suffix_dedup._COLUMNS))
                   for i in range(0, len(rows), size)]
        return sorted({tuple(r.values()) for b in suffix_dedup._firsts(iter(batches)) for r in b.to_pylist()})

    assert run(1) == run(7) == run(50) == run(1000) and len(run(1)) > 20


def test_blocks_keep_what_long_buckets_had_first():
    """A bucket in parts gives the repeats that it gives as a whole."""
    rng = random.Random(9)
    strings = ["".join(rng.choice("ab") for _ in range(100)).encode() for _ in range(3)]
    rows = sorted((rng.choice([1, 1, 1, 2]), d, 0, s << 16 | 1 << 8, rng.choice(strings)) for d in range(60) for s in range(3))
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k == 4 else pa.int64()) for k, c in enumerate(zip(*rows))], names=["key", "ord", "sub", "at", "text"])

    def run(most):
        return {(o, s + k) for part in suffix_dedup._sorted_repeats(iter([batch]), most) for o, s, n in zip(part[0], part[2], part[3]) for k in range(n)}

    want = {(d, at >> 16) for k, d, _, at, t in rows if any(x[0] == k and x[4] == t and (x[1], x[3]) < (d, at) for x in rows)}
    assert run(1 << 20) == run(500) == run(1) == want


def test_awkward(spark):
    got = suffix_dedup.cut_repeats(frame(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD)
    periodic = [r for r in got if r["doc_id"] == 8]  # one document in two rows: only its own inner repeats go
    assert {(r["n_bytes"], r["n_removed"], r["n_spans"]) for r in periodic} == {(9000, 8997, 1)}
    assert suffix_dedup.cut_repeats(frame(spark, [])).count() == 0
