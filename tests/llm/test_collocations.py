"""Collocations against their SQL and a plain count."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphmill.llm import collocations
from graphmill.llm.queries import ORACLE, QUERIES
from tests.oracle_check import compare, duck


def plain(rows, least, covered=80, first=2000):
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            own = counts.setdefault(lang, Counter())
            for n in range(1, 5):
                own.update(tuple(ws[i:i + n]) for i in range(len(ws) - n + 1))
    out = []
    for lang, own in counts.items():
        some = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in some.items():
            for q in {p[i:i + m] for m in range(2, len(p)) for i in range(len(p) - m + 1)}:
                longer[q] = max(longer[q], a)
        rated = []
        for p, a in some.items():
            if 100 * longer[p] >= covered * a and longer[p]:
                continue
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            rated.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rated)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def test_against_sql(spark, sf):
    r = compare(QUERIES["op11_collocations"](spark, sf), duck(sf), ORACLE["op11_collocations"])
    assert r["cols_match"] and r["exact"] and r["spark_rows"] > 100, r


@pytest.mark.parametrize("slice_bytes, trigger, longest, bits, held", [(1 << 20, 32, 256, 27, 1 << 22), (64, 4, 7, 12, 50), (500, 1, 1, 20, 1)])
def test_against_plain(spark, slice_bytes, trigger, longest, bits, held):
    rng = random.Random(4)
    some = ["The", "the", "of", "a", "éa", "中", "cat", "x", " ", "don't"]
    glue = [" ", " ", " ", " ", "  ", "\t", " \t ", ". ", ",", "\r\n", "?!"]
    rows = [("".join(rng.choice(some) + rng.choice(glue) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None, "und"])) for _ in range(150)]
    rows += [("shared passage of words the cat sat on. " * 3, "en")] * 40
    rows += [(None, "en"), ("", None), (" \t\n", "de"), ("aa aa aa aa aa aa " * 40, "one"), ("lone", "none"), ("x" * 3000 + " of a", "de")]
    docs = spark.createDataFrame([(i, t, g, 1, "y") for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string, n int, own string")
    chunks = collocations.dictionary(docs, trigger=trigger, longest=longest, size=slice_bytes)
    got = sorted(tuple(r) for r in collocations.rank(chunks, collocations.phrases(chunks, 5, bits, held), first=40).collect())
    assert got == plain(rows, 5, first=40)
    assert len(got) > 30


def test_no_rows_and_hot_chunks(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(docs).count() == 0
    copies = spark.range(3000).select(F.lit("one line that all have. And another").alias("text"), F.lit("en").alias("lang"))
    chunks = collocations.dictionary(copies)
    assert chunks.count() <= 2 and chunks.agg(F.max("n")).first()[0] == 3000
    top = collocations.collocations(copies).orderBy("rank").collect()
    assert [(r["phrase"], r["a"], r["score"]) for r in top][:2] == [("and another", 3000, 1_000_000), ("line that all have", 3000, 1_000_000)]


def test_chunks_overlap_within_pieces():
    text = " ".join(f"w{i % 11}" for i in range(2000)) + ". " + " ".join(f"v{i % 7}" for i in range(500))
    data = np.frombuffer(text.encode(), np.uint8)
    row, start, end, own = collocations.parse(data, np.array([0, len(data)]))
    assert own.sum() == 2500 and len(own) > 8 and own.max() <= collocations.LONGEST
    chunks = [text[a:b] for a, b in zip(start, end)]
    for chunk, n in zip(chunks, own):
        more = len(chunk.split()) - n
        assert 0 <= more <= 3
