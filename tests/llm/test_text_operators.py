"""Operators over documents against their plain versions, and the awkward cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphmill.llm import chat, decontaminate, exact_dedup, packing, pii, simhash
from graphmill.llm.queries import QUERIES
from tests.llm import brute

DOCS = "doc_id long, text string, score double, __id string, label int"
AWKWARD = [
    (1, None), (2, ""), (3, "one"), (4, "one"), (5, "two words"), (6, " \n\t "), (7, "Ünï cödé　x  y \n\n z\r\n"), (8, "aa " * 3000),
    (8, "aa " * 3000), (None, "one"), (None, None), (9, "a@b.cc_d@e.f 1.2.3.4.5.6.7.8 999.1.1.1 +1 (017) 555-7713 x"),
    (10, "<|endoftext|> don't  stop'll\tit"), (11, "4111 1111 1111 1111, 4111-1111-1111-1112 5 - 67"), (12, "x" * 20000), (13, "aA aA aA"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0.5, "x", 7) for i, t in rows], DOCS)


def test_pii_base(spark, sf, documents):
    got = {r["doc_id"]: r for r in QUERIES["op1_pii"](spark, sf).collect()}
    assert len(got) == len(documents)
    for i, t in documents:
        spans = brute.base_spans(t)
        assert got[i]["base_sha256"] == brute.base_sha(t), (i, spans, got[i]["spans"])
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert got[i]["spans"].startswith(",".join(f"{k}:{s}:{e}" for k, s, e in spans))


def test_pii_awkward(spark):
    more = ["1.2.3.4", "..1.2.3.4.", "256.1.1.1.1", "0001.02.3.255", "a.b+c@x-y.z.w-", "@x.y", "a@b", "é@x.y", "+1-2", "+12345678", "+1 ( 2 3 4 5 6 7 8 9",
            "4111111111111111", "04111111111111111", "1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "1" * 16, "1" * 19, "1" * 20, "0" * 17, "x4111 1111-1111 1111y",
            "4111  1111 1111 1111", "+1+2+12345678901", "a@b.c@d.e", "a@b.c.d@e.f", "😀 a@b.co 😀 1.2.3.4", "++1234567 8", "1.2.3.4.5", "1.2.3.4.5.6.7.8"]
    rng = random.Random(5)
    more += ["".join(rng.choice("0019 -+@.a()%_é") for _ in range(rng.randrange(60))) for _ in range(300)]
    rows = AWKWARD + [(100 + i, t) for i, t in enumerate(more)]
    got = pii.digest(pii.extract(frame(spark, rows))).collect()
    assert sorted((r["doc_id"] or -1, r["base_sha256"]) for r in got) == sorted((i or -1, brute.base_sha(t)) for i, t in rows)
    assert pii.digest(pii.extract(frame(spark, []))).count() == 0


def test_pii_discovers(spark):
    """A word before card numbers marks a like-shaped number that fails the check digit; another word doesn't."""
    rows = [(7, "in all 12 cases")]
    rows += [(20 + i, f"card 411111111111{i:03d}{c} paid") for i in range(8) for c in range(10) if brute.luhn(f"411111111111{i:03d}{c}")]
    bad = next(n for n in ("4111111111119990", "4111111111119991") if not brute.luhn(n))
    rows += [(90, f"card {bad} paid"), (91, f"part {bad[::-1]} sold")]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.extract(frame(spark, rows))).collect()}
    assert got[90] == "context:5:21" and got[91] == "" and got[7] == ""


def test_pii_long_runs_of_other_characters(spark):
    """A paragraph without spaces or ASCII letters is trimmed in one pass."""
    rows = [(1, "5" + "中" * 200_000 + "a"), (2, "5" + "." * 200_000), (3, "-+@" + "é" * 200_000)]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.extract(frame(spark, rows))).collect()}
    assert got == {1: "", 2: "", 3: ""}


def test_pii_finds_other_shapes_and_chains(spark):
    """A shape that no base expression matches, by its context; what is found so makes the next context known."""
    rows = [(i, f"phone +1-555-123-4{i:03d} now") for i in range(40)]
    rows += [(100 + i, f"phone 555-123-4{i:03d} now") for i in range(8)]  # no base match
    rows += [(200 + i, f"ring 555-123-4{i:03d} please") for i in range(8)]  # the same numbers after another word
    rows += [(300, "ring 555.987.6543 please"), (301, "chapter 12 now"), (302, "on 2020-01-02 at 10"), (303, "page 12 of 90")]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.extract(frame(spark, rows))).collect()}
    assert all(got[100 + i] == "context:6:18" and got[200 + i] == "context:5:17" for i in range(8))
    assert got[300] == "context:5:17" and got[301] == got[302] == got[303] == ""


def test_pii_finds_secrets(spark):
    """Named secrets, with and without white space; a like value after an ordinary word isn't one."""
    def value(i):
        return hashlib.sha1(b"%d" % i).hexdigest()

    rows = [(i, f'so it went token = "{value(i)}" and on') for i in range(20)]
    rows += [(100 + i, f"see password={value(100 + i)} there") for i in range(12)]
    rows += [(200, 'token = "short9" and'), (201, f"commit {value(201)} by me"), (202, f"commit {value(202)} by me"), (203, "password=hunter2 there")]
    rows += [(300, "token = \"" + "中" * 100_000 + " 5"), (301, "中" * 100_000 + " 12 " + "é" * 100_000)]
    got = {r["doc_id"]: r for r in pii.digest(pii.extract(frame(spark, rows))).collect()}
    assert all(got[i]["spans"] == "context:20:60" and got[i]["n_context"] == got[i]["n_spans"] == 1 for i in range(20))
    assert all(got[100 + i]["spans"] == "context:13:53" for i in range(12)) and got[203]["spans"] == "context:9:16"
    assert got[201]["spans"] == got[202]["spans"] == got[300]["spans"] == got[301]["spans"] == ""


def test_pii_common_words_are_contradicted(spark):
    """Numbers that fail the check digit after a word that mostly stands before ordinary words aren't marked."""
    cards = [f"411111111111{i:03d}{c}" for i in range(8) for c in range(10) if brute.luhn(f"411111111111{i:03d}{c}")]
    rows = [(i, f"the {n} was the word of the day and the night") for i, n in enumerate(cards)]
    rows += [(100 + i, "the cat was the dog the hat the end " * 5) for i in range(40)] + [(200, "the 4111111111119995 was")]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.extract(frame(spark, rows))).collect()}
    assert not brute.luhn("4111111111119995") and got[200] == "" and got[0] == "card:4:20"


def test_packing_pieces(spark, sf, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    odd = AWKWARD + [(50 + i, t) for i, t in enumerate(["\n", "a\nb", "a \nb", " a", "a ", "a b c", "x\x1cy z", "  a", "it's 12ab\n\nZ"])]
    rows = [(i, t) for i, t in documents if i % 7 == 0] + odd  # a plain encoding of all would take minutes
    got = packing.pieces(frame(spark, rows)).collect()
    want = [(i, *p) for i, t in rows for p in brute.pieces(t, tokenizer)]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(key(tuple(r)[:5]) for r in got) == sorted(map(key, want))


def test_packing_is_whole_and_tight(spark, sf):
    out = QUERIES["op2_packing"](spark, sf).toPandas()
    assert out.groupby("doc_id")["piece"].apply(lambda p: sorted(p) == list(range(len(p)))).all()
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert (s["offset"].to_numpy() == np.r_[0, s["length"].cumsum().to_numpy()[:-1]]).all() and s["length"].sum() <= 1024
    least = -(-out["length"].sum() // 1024)
    assert out["sequence_id"].nunique() <= 1.01 * least + 1


def test_packing_levels(spark):
    """More than one block: poor bins are packed again, and no piece is lost."""
    rng = random.Random(3)
    rows = [(i, " ".join(["the"] * rng.randrange(1, 2500))) for i in range(500)]
    out = packing.pack(frame(spark, rows), block_items=64).toPandas()
    assert out.groupby("doc_id")["length"].sum().sort_index().tolist() == [len(t.split()) + 1 for _, t in rows]
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert (s["offset"].to_numpy() == np.r_[0, s["length"].cumsum().to_numpy()[:-1]]).all() and s["length"].sum() <= 1024
    assert out["sequence_id"].nunique() <= 1.05 * -(-out["length"].sum() // 1024) + 2
    assert packing.pack(frame(spark, [])).count() == 0


def test_packing_joins_blocks(spark, monkeypatch):
    """Small blocks: levels go on until none frees a bin, so pieces of different blocks meet."""
    rows = [(i, " ".join(["the"] * n)) for i, n in enumerate([479, 543] * 40)]
    out = packing.pack(frame(spark, rows), block_items=4, islands=1, epochs=1, generations=2).toPandas()
    assert sorted(out["doc_id"]) == list(range(80))
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert (s["offset"].to_numpy() == np.r_[0, s["length"].cumsum().to_numpy()[:-1]]).all() and s["length"].sum() <= 1024
    assert out["sequence_id"].nunique() <= 43  # 40 at least
    lone = packing.pack(frame(spark, [(i, " ".join(["the"] * 600)) for i in range(40)]), block_items=4).toPandas()
    assert lone["sequence_id"].nunique() == 40


def test_simhash(spark, sf, documents):
    got = {r["doc_id"]: r for r in QUERIES["op9_simhash"](spark, sf).collect()}
    fps = [brute.fingerprint(t) for _, t in documents]
    want = brute.near_components([i for i, _ in documents], fps)
    for (i, _), f, c in zip(documents, fps, want):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{f:016x}", c)


def test_simhash_awkward(spark):
    got = simhash.near_groups(frame(spark, AWKWARD)).collect()
    fps = [brute.fingerprint(t) for _, t in AWKWARD]
    want = zip(AWKWARD, fps, brute.near_components([i for i, _ in AWKWARD], fps))
    assert sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in got) == sorted((i or -1, f"{f:016x}", c) for (i, _), f, c in want)
    kept = simhash.drop_near(frame(spark, AWKWARD))
    assert kept.columns == ["doc_id", "text", "score", "__id", "label"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in got})
    assert simhash.near_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [200, 1024])
def test_simhash_links_dense_groups(spark, hot):
    """Clusters of near fingerprints, with upper nodes small and opened: no link between classes is lost."""
    rng = random.Random(11)
    fps = set()
    for size in [30] * 20 + [600]:
        seed = rng.getrandbits(64)
        for _ in range(size):
            f = seed
            for b in rng.sample(range(64), rng.randrange(0, 5)):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    signed = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    from graphmill.llm.components import components

    roots = {r["id"]: r["root"] for r in components(simhash.links(signed, hot=hot)).collect()}
    got, want = {}, {}
    for f, c in zip(fps, brute.near_components(fps, fps)):
        got.setdefault(roots.get(simhash._signed(f), simhash._signed(f)), set()).add(f)
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_exact_awkward(spark):
    long = "Sentence one is here. " * 400
    rows = AWKWARD + [(60, long), (61, long), (62, long + "x"), (63, "y" + long)]
    got = exact_dedup.exact_groups(frame(spark, rows)).collect()
    by: dict = {}
    for i, t in rows:
        by.setdefault(t or "", []).append(i)
    want = []
    for i, t in rows:
        ids = by[t or ""]
        want.append((i or -1, max((x for x in ids if x is not None), default=-1) , len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["group_size"], r["text_sha256"]) for r in got) == sorted(want)
    assert sum(r["kept"] for r in got) == len(by)
    kept = exact_dedup.drop_copies(frame(spark, rows)).collect()
    assert len(kept) == len(by) and {r["text"] or "" for r in kept} == set(by)
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def test_exact_colliding_identifiers(spark, monkeypatch):
    """Chunks that share an identifier are told apart by their SHA-256."""
    real = exact_dedup.recipes

    def weak(*a):
        return real(*a).withColumn("chunks", F.transform("chunks", lambda c: F.struct((c["id"] % 2).alias("id"), c["sha"].alias("sha"))))

    monkeypatch.setattr(exact_dedup, "recipes", weak)
    rows = [(i, f"text {i // 2}") for i in range(40)]
    got = exact_dedup.exact_groups(frame(spark, rows)).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} == {(i, i // 2 * 2 + 1, 2) for i in range(40)}
    monkeypatch.setattr(exact_dedup, "FEW", 1)
    got = exact_dedup.exact_groups(frame(spark, rows)).collect()
    assert {(r["doc_id"], r["keep_id"]) for r in got} == {(i, i // 2 * 2 + 1) for i in range(40)}


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id int")


def test_contamination_edited_copies(spark, documents):
    rng = random.Random(2)
    words = sorted({w for _, t in documents[:200] for w in t.split() if w.isalpha()})
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(12, 50))), 1) for k in range(30)] + [(98, "too short", 1), (99, None, 1)]
    rows, want = [], set()
    for n, (k, item, _) in enumerate(items[:30]):
        w = item.split()
        for share in (0.0, 0.1, 0.3):
            v, edits = list(w), int(share * len(w))
            for e in rng.sample(range(len(v)), edits):
                v[e] = "zzz" + rng.choice(words)
            doc = 1000 * (n + 1) + int(share * 100)
            text = documents[n][1] + " " + " ".join(v) + ". " + documents[n + 50][1]
            rows.append((doc, text))
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contamination(frame(spark, rows + AWKWARD), _items(spark, items)).collect()}
    for doc, text in rows:
        k = doc // 1000 - 1
        plain = [w.strip(".,") for w in text.lower().split()]
        score, same = brute.smith_waterman(items[k][1].lower().split(), plain)
        size = len(items[k][1].split())
        shares_seed = any(plain[i:i + 5] == items[k][1].lower().split()[j:j + 5] for j in range(size - 4) for i in range(len(plain) - 4))
        if shares_seed and same / max(size, 2 * same - score) >= 0.8:
            want.add((doc, k))
    assert set(got) == want and len(want) >= 30
    assert all((d, k) in got for d, k in want if d % 1000 <= 10)
    by = dict(rows)
    for (d, k), r in got.items():
        if d % 1000 == 0:
            assert by[d].encode()[r["start"]:r["end"]].decode() == items[k][1] and r["similarity"] == 1.0


@pytest.mark.parametrize("size, edits", [(9, [4]), (14, [4, 9]), (19, [4, 9, 14]), (6, [2]), (1, []), (2, []), (3, []), (4, []), (25, [4, 9, 14, 19, 24])])
def test_contamination_without_a_run_of_five(size, edits):
    """Edits that break every run of five words, and items under five words."""
    item = [f"w{k}" for k in range(size)]
    copy = [f"x{k}" if k in edits else w for k, w in enumerate(item)]
    text = " ".join(["before", "it", *copy, "after", "it"])
    block = decontaminate.Block([" ".join(item)])
    data, offsets = decontaminate.bytes_of(decontaminate.pa.array([text], decontaminate.pa.large_string()))
    row, at, seed, w = block.hits(data, offsets)
    got = list(decontaminate._matches(block, np.ones(len(block.seeds), np.int64), row, at, seed, w, 0.8))
    score, same = brute.smith_waterman(item, text.split())
    assert same / max(size, 2 * same - score) >= 0.8 and len(got) == 1 and got[0][2] == same / max(size, 2 * same - score)


def test_contamination_random_edits():
    """Every pair that the plain alignment of whole texts finds."""
    rng = random.Random(4)
    items = [[f"i{k}w{j}" for j in range(rng.randrange(1, 40))] for k in range(60)]
    texts = []
    for item in items:
        for _ in range(10):
            v = list(item)
            for _ in range(rng.randrange(0, len(item) // 4 + 2)):
                at = rng.randrange(len(v) + 1)
                v[at:at + rng.randrange(2)] = rng.choice([["zz"], []])
            texts.append(["a", "b", *v, "c"])
    block = decontaminate.Block([" ".join(i) for i in items])
    data, offsets = decontaminate.bytes_of(decontaminate.pa.array([" ".join(t) for t in texts], decontaminate.pa.large_string()))
    got = {(m[0], m[1]) for m in decontaminate._matches(block, np.ones(len(block.seeds), np.int64), *block.hits(data, offsets), 0.8)}
    want = set()
    for n, text in enumerate(texts):
        score, same = brute.smith_waterman(items[n // 10], text)
        if same / max(len(items[n // 10]), 2 * same - score) >= 0.8:
            want.add((n, n // 10))
    assert got == want and len(want) > 200


def test_contamination_blocks(spark, monkeypatch, documents):
    items = [(k, t[:300], 1) for k, (_, t) in enumerate(documents[:12])]
    docs = frame(spark, documents[:40])
    whole = decontaminate.contamination(docs, _items(spark, items)).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1500)
    parts = decontaminate.contamination(docs, _items(spark, items)).collect()
    key = lambda r: (r["doc_id"], r["item_id"], r["similarity"], r["start"], r["end"])
    assert sorted(map(key, whole)) == sorted(map(key, parts)) and len(whole) >= 12
    assert decontaminate.contamination(frame(spark, []), _items(spark, items)).count() == 0
    assert decontaminate.contamination(docs, _items(spark, [])).count() == 0
    kept = decontaminate.drop_contaminated(docs, _items(spark, items))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in documents[:40]} - {r["doc_id"] for r in whole}


def test_chat_awkward(spark):
    rows = [(1, 0, "system", "be kind", 1), (1, 1, "ann", "hi", 2), (1, 2, "bob", None, 3), (1, 2, "bob", None, 3), (1, None, None, "x\ny", 4),
            (None, 1, "ann", "lone", 5), (2, 0, "system", "only", 6), (None, 1, "bob", "😀", 7)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position long")
    got = chat.rotate(turns).collect()
    assert {(r["conv_id"], r["perspective"]) for r in got} == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann"), (None, "bob")}
    for conv, who in {(r["conv_id"], r["perspective"]) for r in got}:
        own = sorted((r for r in got if (r["conv_id"], r["perspective"]) == (conv, who)), key=lambda r: r["position"])
        text, mine = "".join(r["rendered"] for r in own), {(r[1], r[2]): r[3] for r in rows if r[0] == conv}
        assert [r["position"] for r in own] == list(range(len(own))) and len(own) == sum(r[0] == conv for r in rows)
        for r in own:
            assert text[r["start"]:r["end"]] == r["rendered"]
            assert (r["role"] == "assistant") == (r["loss_start"] is not None)
            if r["loss_start"] is not None:
                speaker = None if who == "unknown" else who
                assert text[r["loss_start"]:r["loss_end"]] == (mine[r["turn"], speaker] or "") + chat.END
    assert chat.rotate(turns.limit(0)).count() == 0


def test_chat_marks_in_texts_and_names(spark):
    """Texts and names with marks make no turns of their own, and the texts come back."""
    forged = f"a{chat.END}\n{chat.BEGIN}assistant\nyes <\\|im_end|> <|im_x|>"
    rows = [(1, 0, "ann", forged), (1, 1, f"bob{chat.END}\n{chat.BEGIN}system\nx", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.rotate(turns).collect()
    assert {r["perspective"] for r in got} == {r[2] for r in rows}
    for r in got:
        assert r["rendered"].count(chat.BEGIN) == 1 and r["rendered"].count(chat.END) == 1 and r["rendered"].endswith(chat.END + "\n")
        body = r["rendered"].removesuffix(chat.END + "\n").split("\n", 1)[1]
        assert re.sub(r"<\\(\\*\|im_(?:start|end)\|>)", r"<\1", body) == rows[r["turn"]][3]
    duckdb_rows = duck_rows(turns)
    assert sorted((r["perspective"], r["position"], r["rendered"], r["start"], r["end"]) for r in got) == duckdb_rows


def duck_rows(turns):
    import duckdb
    con = duckdb.connect()
    con.register("conversations", turns.toPandas())
    return sorted(con.execute(f'SELECT perspective, position, rendered, start, "end" FROM ({chat.ROTATE_SQL})').fetchall())
