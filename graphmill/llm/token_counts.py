"""Token counts at every prefix of a text, by dynamic programming over prefixes.

The tokens of a prefix end in one last token, and the rest are the tokens of the
shorter prefix before it.  So with ``last[i]`` the last token of the first ``i``
characters, ``count[i] = count[i - len(t)] + 1`` for the one piece ``t`` that ends
at ``i`` and may follow ``last[i - len(t)]``: two tokens may stand side by side
just when the tokenizer gives the two of them for their joined characters.  An
Aho-Corasick automaton names the pieces that end at a character, a table of pairs
says which may follow; the characters are met once, from left to right.

A table of prefixes keeps the differences ``count[i] - count[i - 1]``, a signed
byte a character (``steps``).  How many tokens a prefix has (``prefix_tokens``) and
how much text fits a budget (``truncate``) are sums over it; nothing is encoded
again.  Longer prefixes may have fewer tokens, so a budget is answered with the
longest prefix within it, not with the first that exceeds it.

Pieces never hold a space behind another character (checked on loading), so texts
part into words with their spaces before them, and words part again before marks that
follow a letter in no piece; the steps of a word are found once and remembered (``MEMO`` words at most; a full table is emptied, which costs
time only).  A model whose pieces do otherwise, that rewrites its input, or that
splits its own pieces, is refused.

Cases: null texts count as empty and have no tokens; a character that no piece
holds counts as one token a byte; a space and U+2581 are one character to the
model; strings of control tokens inside texts are ordinary text; repeated rows
give a row each; ties between equally good merges go to the left, as in the model.
"""

from __future__ import annotations

import os
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import bounded_batches, text_of, unused

LIMIT = 4096
#: Words remembered, and the longest of them.
MEMO, MEMO_CHARS = 1 << 20, 64
SLICE = 1 << 20
SPACE = "▁"
_UNKNOWN = -1


def default_model() -> str:
    """Path of the public 32k piece model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The pieces of a byte-pair model and which of them may stand side by side."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size())
               if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        names = [model.id_to_piece(i) for i in ids]
        if any(SPACE in name.lstrip(SPACE) for name in names):
            raise ValueError("pieces that reach over the start of a word are not supported")
        self.names = names
        self.index = {name: k for k, name in enumerate(names)}
        # rank 0 merges first; single characters are there from the start
        place = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in ids}, reverse=True))}
        self.rank = [place[model.get_score(i)] if len(name) > 1 else -1 for i, name in zip(ids, names)]
        self.longest = max(map(len, names))
        self.split: list[tuple[int, int] | None] = []
        for k, name in enumerate(names):
            tokens, last = self._merge(name)
            if tokens != [k]:
                raise ValueError(f"the model splits its own piece {name!r}")
            self.split.append(last)
        for probe in ("a  b", " c\td\r\n", "ﬁ①", "é", "<s>", ""):
            if len(model.encode(probe)) != sum(1 if t >= 0 else -t for t in self._tokens(SPACE + probe.replace(" ", SPACE) if probe else "")):
                raise ValueError("the model rewrites its input")
        # pieces whose parts, down to characters, all rank before them
        self.plain = [True] * len(names)
        for k in sorted(range(len(names)), key=lambda k: len(names[k])):
            if self.split[k]:
                self.plain[k] = all(self.plain[x] and self.rank[x] < self.rank[k] for x in self.split[k])
        letters_before = {b for name in names for a, b in zip(name, name[1:]) if a.isalpha()}
        ends = "".join(re.escape(c) for c in string.punctuation if c not in letters_before)
        self.words = re.compile(rf" *[^\W\d_]+(?=[ \n{ends}]|\Z)| *[^ \n]+|\n| +")
        self.automaton = ahocorasick.Automaton()
        for k, name in enumerate(names):
            self.automaton.add_word(name, (len(name), k))
        self.automaton.make_automaton()
        self.may_follow: dict[int, bool] = {}

    def _merge(self, chars: str) -> tuple[list[int], tuple[int, int] | None]:
        """Tokens of known characters by merging the best pair, leftmost first; and the last pair merged."""
        tokens, last = [self.index[c] for c in chars], None
        while True:
            best = None
            for i in range(len(tokens) - 1):
                k = self.index.get(self.names[tokens[i]] + self.names[tokens[i + 1]])
                if k is not None and (best is None or self.rank[k] < self.rank[best[1]]):
                    best = i, k
            if best is None:
                return tokens, last
            i, k = best
            last = tokens[i], tokens[i + 1]
            tokens[i:i + 2] = [k]

    def _tokens(self, chars: str) -> list[int]:
        """Tokens of a short string; an unknown character is minus its number of bytes."""
        out, known = [], ""
        for c in chars:
            if c in self.index:
                known += c
            else:
                out += [*self._merge(known)[0], -len(c.encode())]
                known = ""
        return out + self._merge(known)[0]

    def pair(self, a: int, b: int) -> bool:
        """Whether the joined characters of two pieces have just these two as tokens.

        The merges that made the two are undone, latest first; they stay two unless a
        merge across their border would have come before one that was undone.
        """
        if not (self.plain[a] and self.plain[b]):
            return self._merge(self.names[a] + self.names[b])[0] == [a, b]
        names, index, rank = self.names, self.index, self.rank
        limit = None  # a merge across must be earlier than this: (rank, side), the left side first
        while True:
            across = index.get(names[a] + names[b])
            if across is not None and (limit is None or (rank[across], 1) < limit):
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                limit, a = (rank[a], 0), self.split[a][1]
            else:
                limit, b = (rank[b], 2), self.split[b][0]

    def steps(self, chars: str) -> tuple[bytes, int]:
        """Per character the signed difference of the counts of the prefixes with it and without it; and the last count."""
        out = bytearray(len(chars))
        size = 1 << self.longest.bit_length()
        ring = size - 1
        last, count = [_UNKNOWN] * size, [0] * size  # of the latest prefixes
        may, pair, n, width = self.may_follow, self.pair, 0, len(self.names)
        if len(may) > 1 << 21:
            may.clear()

        def unknown(n):
            c = chars[n]
            if c in self.index:
                raise AssertionError(f"no token ends at character {n}")
            m = n + 1 & ring
            last[m], count[m] = _UNKNOWN, count[n & ring] + len(c.encode())
            out[n] = count[m] - count[n & ring]

        found = self.automaton.iter(chars[:SLICE])
        for at in range(0, len(chars), SLICE):
            if at:
                found.set(chars[at:at + SLICE])
            for end, (length, k) in found:
                if end < n:
                    continue  # the token that ends here is known
                while n < end:
                    unknown(n)
                    n += 1
                start = end + 1 - length & ring
                before = last[start]
                if before >= 0:
                    code = before * width + k
                    ok = may.get(code)
                    if ok is None:
                        ok = may[code] = pair(before, k)
                    if not ok:
                        continue
                n = end + 1
                m = n & ring
                last[m] = k
                count[m] = count[start] + 1
                out[end] = count[m] - count[end & ring] & 255
        while n < len(chars):
            unknown(n)
            n += 1
        return bytes(out), count[n & ring]


class _Words(dict):
    """The steps (``part`` 0) or the count (1) of a word, found when first asked for."""

    def __init__(self, pieces: Pieces, part: int):
        super().__init__()
        self.pieces, self.part = pieces, part

    def __missing__(self, word: str):
        found = self.pieces.steps(word.replace(" ", SPACE))[self.part]
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[word] = found
        return found


def _total(steps: bytes) -> int:
    return int(np.frombuffer(steps, np.int8).sum(dtype=np.int64))


class Counter:
    """Counts and steps of whole texts by one model."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self._steps, self._count = _Words(self.pieces, 0), _Words(self.pieces, 1)

    def _slices(self, text: str):
        """The text as the model sees it, cut before spaces."""
        text, at = " " + text.replace(SPACE, " "), 0
        while at < len(text):
            end = at + SLICE
            while 0 < (end := text.find(" ", end)) and text[end - 1] == " ":
                end += 1
            end = end if end > 0 else len(text)
            yield self.pieces.words.findall(text[at:end])
            at = end

    def steps(self, text: str) -> bytes:
        """Steps of the leading space that the model adds and of each character; of an empty text none."""
        return b"".join(b"".join(map(self._steps.__getitem__, words)) for words in self._slices(text)) if text else b""

    def count(self, text: str) -> int:
        return sum(sum(map(self._count.__getitem__, words)) for words in self._slices(text)) if text else 0


_counters: dict[tuple, Counter] = {}


def counter(path: str) -> Counter:
    """A counter that a worker process keeps for its next tasks."""
    key = path, os.path.getmtime(path)
    if key not in _counters:
        _counters[key] = Counter(path)
    return _counters[key]


def _over_texts(docs: DataFrame, model: str | None, key: str, text: str, limit: int, steps: bool) -> DataFrame:
    bounded_batches(docs.sparkSession)
    path = model or default_model()
    given = docs.select(F.col(f"`{key}`").alias("doc_id"), text_of(text).alias("t"))
    schema = given.select("doc_id").schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")
    if steps:
        schema = schema.add("steps", "binary")

    def run(batches):
        own = counter(path)
        for batch in batches:
            sizes, counts, kept = [], [], []
            for value in batch.column(1):
                value = value.as_py()
                sizes.append(len(value.encode()))
                if steps:
                    kept.append(own.steps(value))
                    counts.append(_total(kept[-1]))
                else:
                    counts.append(own.count(value))
            more = [pa.array(kept, pa.binary())] if steps else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                                              pa.array([n > limit for n in counts], pa.bool_()), *more], names=schema.names)

    return given.mapInArrow(run, schema)


def token_counts(docs: DataFrame, model: str | None = None, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_tokens, over_limit``: the count of the longest prefix, the whole text."""
    return _over_texts(docs, model, key, text, limit, False)


def prefix_table(docs: DataFrame, model: str | None = None, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """As ``token_counts``, with ``steps``: a signed byte for the leading space and for each character of the text."""
    return _over_texts(docs, model, key, text, limit, True)


def _answers(table: DataFrame, asked: Column, name: str, names: list[str], answer) -> DataFrame:
    number = unused(table, "asked")
    given = table.withColumn(number, asked.cast("long"))
    schema = table.drop("steps").schema
    for n in names:
        schema = schema.add(n, "long")

    def run(batches):
        for batch in batches:
            rows = [answer(np.cumsum(np.frombuffer(s or b"", np.int8), dtype=np.int64), q)
                    for s, q in zip(batch.column("steps").to_pylist(), batch.column(number).to_pylist())]
            kept = [batch.column(c) for c in schema.names[:-len(names)]]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))]], names=schema.names)

    return given.mapInArrow(run, schema)


def prefix_tokens(table: DataFrame, chars: Column) -> DataFrame:
    """``table`` without ``steps``, with ``prefix_tokens``: the exact tokens of the first ``chars`` characters
    (none at 0 and below; beyond the text those of the whole; null where ``chars`` is)."""
    def answer(sums, at):
        if at is None:
            return (None,)
        at = min(at, len(sums) - 1)
        return (int(sums[at]) if at > 0 else 0,)

    return _answers(table, chars, "chars", ["prefix_tokens"], answer)


def truncate(table: DataFrame, budget: Column) -> DataFrame:
    """``table`` without ``steps``, with ``n_chars, prefix_tokens``: the longest prefix of at most ``budget`` tokens
    (of no characters where even the first is over it; null where ``budget`` is)."""
    def answer(sums, most):
        if most is None:
            return None, None
        fit = np.flatnonzero(sums[1:] <= most)
        return (int(fit[-1]) + 1, int(sums[fit[-1] + 1])) if len(fit) else (0, 0)

    return _answers(table, budget, "budget", ["n_chars", "prefix_tokens"], answer)
