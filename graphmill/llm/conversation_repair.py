"""Repair of conversation structure by a dynamic program with square-root checkpoints.

``damage`` makes faulty conversations of sound ones; ``repair`` finds, for each
conversation, the cheapest edits after which the role initials read
``(s?(ua)+)?``.  A row is kept (0), gets the other or the same of the roles user
and assistant (2), or is deleted (3); an empty user or assistant row may be
inserted anywhere (2).  Blank rows and repeats must go; a row cut short that stays
adds 1.  With the states *start*, *after s*, *after u*, *after a*, the cost of the
rest of a conversation is a vector over states, found from the end backwards.  Only
the vectors at every ``sqrt(n)``-th row are stored; walking forward, each block's
vectors are found again from the checkpoint behind it, and of the edits that are on
a cheapest way (the tight ones) the first in the order ``D, I, K, R`` is taken, which
gives the ASCII-least audit.

Spark groups equal rows (``copies``; so a row repeated a million times moves once a
map task) and finds repeats by their smallest turn.  A conversation then reaches one
task twice in a row, in one sorted stream: first as a byte for each row (initial and
fault), from which the audit comes, then as texts, which are hashed as they pass.  So a
task holds about two bytes a row of one conversation (the audit is as long) and never its texts; the
digest over a whole conversation is a chain that can't be shared out, so one task passes all of it.

Cases: a null id, turn, role or text is one space where a text is asked for; rows with a
null turn come first, rows with a null id are a conversation; rows of one turn go by
role, then text, in byte order (copies side by side); other roles than ``s..., u...,
a...`` are legal nowhere and are deleted or get a role; a conversation of which no
row is left has zeros, an empty audit and the digest of nothing; an empty table has
no rows.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import bounded_batches, settle

#: Costs of the edits and of a kept row that is cut short.
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
WHITE = " \t\n\v\f\r"
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEEDED = ("user", "assistant")
#: Per state: which of these roles a row that gets one must take, and the state after it.
_NEED = (0, 0, 1, 0)
_NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: State after a kept row by its initial (0 other, 1 s, 2 u, 3 a); -1: not allowed.
_KEEP = ((-1, -1, -1, -1), (AFTER_S, -1, -1, -1), (AFTER_U, AFTER_U, -1, AFTER_U), (-1, -1, AFTER_A, -1))
#: A row as a byte: its initial, and the flags of a row that must go and of one cut short.
MUST_GO, SHORT = 4, 8
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: Initials that may stand side by side.
LEGAL = {(1, 2), (2, 3), (3, 2)}
#: Costs by state when no row is left.
_END = (0, 2 * INSERT, INSERT, 0)


def _before(code: int, after: tuple) -> tuple:
    """Costs from before a row, by state, given those from after it."""
    keep, extra = _KEEP[code & 3], CUT_SHORT if code & SHORT else 0
    out = []
    for state in range(4):
        cost = DELETE + after[state]
        if not code & MUST_GO:
            cost = min(cost, REROLE + extra + after[_NEXT[state]])
            if keep[state] >= 0:
                cost = min(cost, extra + after[keep[state]])
        out.append(cost)
    for _ in range(2):  # up to two rows inserted before it bring every state to every other
        out = [min(out[state], INSERT + out[_NEXT[state]]) for state in range(4)]
    return tuple(out)


def cheapest(codes: bytes) -> tuple[int, bytes]:
    """Least cost and ASCII-least audit of the rows of a conversation."""
    n = len(codes)
    size = isqrt(n) + 1
    marks = [_END]  # from the end, after each block
    vector = _END
    for i in range(n - 1, -1, -1):
        vector = _before(codes[i], vector)
        if i % size == 0:
            marks.append(vector)
    total, state, audit = vector[START], START, bytearray()
    for first in range(0, n, size):
        end = min(first + size, n)
        block = [marks[-(first // size) - 2]]  # the vector behind the block
        for i in range(end - 1, first - 1, -1):
            block.append(_before(codes[i], block[-1]))
        for i in range(first, end):
            code, after = codes[i], block[end - 1 - i]
            here = block[end - i]
            extra = CUT_SHORT if code & SHORT else 0
            while True:
                left = here[state]
                if left == DELETE + after[state]:
                    audit += b"D"
                    break
                if left == INSERT + here[_NEXT[state]]:
                    audit += b"I"
                    state = _NEXT[state]
                    continue
                kept = _KEEP[code & 3][state]
                if kept >= 0 and left == extra + after[kept]:
                    audit += b"K"
                    state = kept
                else:
                    audit += b"R"
                    state = _NEXT[state]
                break
    while _END[state]:
        audit += b"I"
        state = _NEXT[state]
    return total, bytes(audit)


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows damaged by ``crc32(conv_id:turn) % 20``; dropped rows have no copies."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(f"`{c}`").cast("string"), space) for c in (conv, turn)])
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    given = F.coalesce(F.col(f"`{text}`").cast("string"), space)
    body = F.when(kind <= 1, "").when(kind == 2, F.translate(given, ".!?", "")).otherwise(given)
    return conversations.select(
        F.col(f"`{conv}`").alias("conv_id"), F.when(kind != 0, F.col(f"`{turn}`").cast("long")).alias("turn"),
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(F.coalesce(F.col(f"`{role}`").cast("string"), space)).alias("role"),
        body.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct rows with their ``copies``, the ``fault`` and ``code`` of the first copy, and whether another text shares turn and role."""
    rows = settle(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "turns")
    live = rows.where("copies > 0")
    order = F.struct(F.col("turn").isNotNull().alias("later"), "turn")
    rows, live = (x.withColumn("said", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)) for x in (rows, live))
    first = settle(live.groupBy("conv_id", "said").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "said-again")
    tied = settle(live.groupBy("conv_id", "turn", "role").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "ties")
    first = first.select(F.col("conv_id").alias("c1"), F.col("said").alias("s1"), "first")
    tied = tied.select(F.col("conv_id").alias("c2"), F.col("turn").alias("t2"), F.col("role").alias("r2"), F.lit(True).alias("tie"))
    rows = (rows.join(first, rows["conv_id"].eqNullSafe(first["c1"]) & (rows["said"] == first["s1"]), "left")
            .join(tied, rows["conv_id"].eqNullSafe(tied["c2"]) & rows["turn"].eqNullSafe(tied["t2"]) & (rows["role"] == tied["r2"]), "left"))
    words = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (F.when(words == "", BLANK).when(F.col("first").isNotNull() & ~order.eqNullSafe(F.col("first")), DUPLICATE)
             .when(~F.substring(words, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    return rows.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"), code.alias("initial"), F.coalesce("tie", F.lit(False)).alias("tie"))


class _Conversation:
    """The conversation that passes just now."""

    def __init__(self):
        self.codes, self.low, self.high, self.turns = bytearray(), None, None, 0
        self.faults, self.illegal, self.initial = [0, 0, 0, 0], 0, None
        self.cost, self.audit, self.at, self.state = 0, None, 0, START
        self.digest, self.written = hashlib.sha256(), False

    def meet(self, turn, copies: int, fault: int, initial: int):
        """A distinct row, ``copies`` times, in order."""
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        more = fault or DUPLICATE  # the other copies are repeats of the first
        more = DUPLICATE if more == TRUNCATED else more
        self.faults[fault] += 1
        self.faults[more] += copies - 1
        self.illegal += copies - 1 + (self.initial is not None and (self.initial, initial) not in LEGAL)
        self.initial = initial
        flags = MUST_GO if fault in (BLANK, DUPLICATE) else SHORT if fault == TRUNCATED else 0
        self.codes.append(initial | flags)
        self.codes += bytes([initial | MUST_GO]) * (copies - 1)

    def solve(self):
        if self.audit is None:
            self.cost, self.audit = cheapest(self.codes)

    def write(self, role: str, text: str):
        self.digest.update((("\n" if self.written else "") + role + ":" + text).encode())
        self.written = True

    def insert(self):
        self.write(NEEDED[_NEED[self.state]], "")
        self.state, self.at = _NEXT[self.state], self.at + 1

    def edit(self, role: str, text: str, copies: int, initial: int):
        """The edits up to the last copy of a distinct row, with its text."""
        for _ in range(copies):
            while self.audit[self.at:self.at + 1] == b"I":
                self.insert()
            letter = self.audit[self.at:self.at + 1]
            self.at += 1
            if letter == b"K":
                self.write(role, text)
                self.state = _KEEP[initial][self.state]
            elif letter == b"R":
                self.write(NEEDED[_NEED[self.state]], text)
                self.state = _NEXT[self.state]

    def row(self) -> tuple:
        self.solve()
        while self.at < len(self.audit):  # rows inserted at the end
            self.insert()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.cost,
                self.audit.decode(), self.digest.hexdigest())


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (``conv_id, turn, role, text, copies``): ``conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256``."""
    bounded_batches(rows.sparkSession)
    passes = _faults(rows).withColumn("pass", F.explode(F.array(F.lit(0), F.lit(1)))).where("pass = 0 or copies > 0")
    passes = passes.withColumn("body", F.when((F.col("pass") == 1) | F.col("tie"), F.col("text")))  # the first pass needs texts only to order ties
    dealt = passes.select("conv_id", "pass", "turn", "role", "body", "copies", "fault", "initial").repartition("conv_id")
    dealt = dealt.sortWithinPartitions("conv_id", "pass", F.col("turn").asc_nulls_first(), "role", "body")
    schema = dealt.select("conv_id").schema
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        schema = schema.add(name, "long")
    schema = schema.add("audit", "string").add("repaired_sha256", "string")
    kinds = [pa.int64()] * 6 + [pa.string()] * 2

    def run(batches):
        conv, own = None, None

        def found(ids: pa.Array, done: list):
            cols = list(zip(*done)) if done else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(cols, kinds)]], names=schema.names)

        for batch in batches:
            ids, done = [], []
            for i, second, turn, role, body, copies, fault, initial in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or i != conv:
                    if own is not None:
                        ids.append(conv)
                        done.append(own.row())
                    conv, own = i, _Conversation()
                if second:
                    own.solve()
                    own.edit(role, body, copies, initial)
                elif copies:
                    own.meet(turn, copies, fault, initial)
            id_type = batch.schema.field(0).type
            yield found(pa.array(ids, id_type), done)
        if own is not None:
            yield found(pa.array([conv], id_type), [own.row()])

    return dealt.mapInArrow(run, schema)
