"""Personal data: base matches, then bootstrapped contextual extraction, in DataFrame functions only.

Base kinds are found by regular expressions in each whole text.  A starting
condition added to each expression names the only places where its leftmost,
non-overlapping matches can start, so a long run is scanned once.

Bootstrapping.  Tokens that hold a digit or an at sign are instances; the name of an
assignment (``password=``, ``"id":``) is cut off.  A context is the lower-cased word
before (or after) a token, the two words before it, or its assignment's name, without
quotes; a pattern is a context together with the token's shape (runs of digits as
``9``, of letters as ``a``, long runs of both as ``#``).  Seeds of score 1 are
instances that a base match starts with, and secrets: ``SECRET`` values of
``NAMED_SECRET`` names.  Each round scores contexts and patterns by the mean score of
their distinct instances (with one imagined instance of score 0); those count that
hold ``MIN_SEEDS`` instances of score ``CONFIDENT`` or more (seeds or found in an
earlier round) and whose instances' scores add up to ``SPECIFIC`` of all places where
the context's words stand in the corpus, so that a common word that happens to stand
before an identifier is contradicted by the ordinary words after it (two words stand
together at most as often as the rarer one).  A context of that score also speaks for
shapes that no pattern holds, if at least ``SHAPE`` of the distinct instances of the
exact shape (digits not run together) are seeds or stand in such contexts.  An
instance scores the chance that any of its contexts is right, each by its pattern
or by itself, and never less than before.  Rounds go on until one adds no confident
instance.  Patterns and contexts that score ``CONFIDENT`` or more mark tokens of
a like score outside the base spans as kind ``context``.

All state is in tables of patterns and instances; texts are read twice, once to
count words.  A context is looked for within ``NEAR`` code points of its token.

Cases: a null text counts as empty and has no spans; repeated rows give a row
each (and count once as an instance); null ids pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import settle, text_of

KINDS = ("email", "ip", "card", "phone")
#: kind: expression, a quick test that a text may have it, and what a match must satisfy (SQL on ``m``).
BASE = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(t, '@')", "true"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "digits",
           r"m rlike '^(0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])([.]|$)){4}$'"),
    # a maximal chain of digits that has 16 to 19 of them
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])", "digits", "luhn(m)"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "contains(t, '+')",
              "length(regexp_replace(m, '[^0-9]', '')) between 8 and 15"),
}
LUHN = """aggregate(sequence(1, length(regexp_replace(m, '[^0-9]', ''))), 0, (a, i) -> a + element_at(
  case when (length(regexp_replace(m, '[^0-9]', '')) - i) % 2 = 0 then array(0, 1, 2, 3, 4, 5, 6, 7, 8, 9)
       else array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9) end,
  cast(substr(regexp_replace(m, '[^0-9]', ''), i, 1) as int) + 1)) % 10 = 0"""
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
MIN_SEEDS, CONFIDENT = 3, 0.75
#: Least share of a context's places in the corpus that hold confident instances.
SPECIFIC = 0.1
NEAR = 128
QUOTES = "\"'`"
#: A value that may be a secret, and what stands before one.
SECRET = r"^(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9+/_-]{16,}+$"
NAMED_SECRET = r"(?:(?:token|secret|password|passwd|pwd|key|credentials?|auth)\s*[=:]+>?|bearer)\s*$"
#: The name in an assignment without white space, and what trims a token.
NAME = r"^[^\s0-9@=:]{1,64}[=:]+"
LEAD, EDGES = r"^[^A-Za-z0-9+(]*", r"^[^A-Za-z0-9+(]++|(?:(?<![^A-Za-z0-9])|\G)[^A-Za-z0-9]++$"
LONG_MIXED = r"(?<![A-Za-z0-9])(?=[0-9]*[A-Za-z])(?=[A-Za-z]*[0-9])[A-Za-z0-9]{16,}+"
#: Least share of a shape's instances that trusted contexts must hold.
SHAPE = 0.5


def _sql_text(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def _starts(matches: str, gaps: str) -> str:
    """SQL: code-point starts of matches, given the texts between them."""
    return f"""aggregate(sequence(1, size({matches})), struct(0L as pos, cast(array() as array<bigint>) as at),
      (s, i) -> struct(s.pos + length(element_at({gaps}, i)) + length(element_at({matches}, i)) as pos,
                       concat(s.at, array(s.pos + length(element_at({gaps}, i)))) as at), s -> s.at)"""


def _spans(frame: DataFrame, kind: str) -> DataFrame:
    """Adds ``<kind>``: the array of (start, end) of valid matches."""
    pattern, quick, valid = BASE[kind]
    none = "cast(array() as array<struct<start: bigint, end: bigint>>)"
    frame = frame.withColumn("m", F.expr(f"case when {quick} then regexp_extract_all(t, {_sql_text(pattern)}, 0) end"))
    frame = frame.withColumn("g", F.expr(f"case when size(m) > 0 then split(t, {_sql_text(pattern)}, -1) end"))
    frame = frame.withColumn("at", F.expr(f"case when size(m) > 0 then {_starts('m', 'g')} end"))
    keep = valid.replace("luhn(m)", LUHN)
    keep = keep if keep == "true" else keep.replace("(m,", "(x.m,").replace("m rlike", "x.m rlike")
    return frame.withColumn(kind, F.expr(f"""case when size(m) > 0 then transform(
        filter(arrays_zip(m, at), x -> {keep}), x -> struct(x.at as start, x.at + length(x.m) as end)) else {none} end""")) \
        .drop("m", "g", "at")


def _tokens(frame: DataFrame) -> DataFrame:
    """Adds ``tokens``: (start, end, instance, patterns, shape, seed) of the tokens that may be identifiers."""
    frame = frame.withColumn("m", F.expr(f"case when digits or contains(t, '@') then regexp_extract_all(t, {_sql_text(TOKEN)}, 0) end"))
    frame = frame.withColumn("g", F.expr(f"case when size(m) > 0 then split(t, {_sql_text(TOKEN)}, -1) end"))
    frame = frame.withColumn("at", F.expr(f"case when size(m) > 0 then {_starts('m', 'g')} end"))
    frame = frame.withColumns({"before": F.expr("case when size(m) > 0 then slice(g, 1, size(m)) end"),
                               "after": F.expr("case when size(m) > 0 then slice(g, 2, size(m)) end")})
    quotes = "'" + QUOTES.replace("'", "\\'") + "'"
    frame = frame.withColumn("k", F.expr(f"""case when size(m) > 0 then transform(arrays_zip(m, at, before, after), x -> struct(
          x.m as m, x.at as at, regexp_extract(x.m, {_sql_text(NAME)}, 0) as name,
          lower(translate(right(x.before, {NEAR}), {quotes}, '')) as before, lower(translate(left(x.after, {NEAR}), {quotes}, '')) as after)) end"""))
    frame = frame.withColumn("k", F.expr(rf"""transform(k, x -> struct(
          x.at + length(x.name) + length(regexp_extract(substr(x.m, length(x.name) + 1), {_sql_text(LEAD)}, 0)) as start,
          regexp_replace(substr(x.m, length(x.name) + 1), {_sql_text(EDGES)}, '') as core,
          lower(translate(x.name, {quotes}, '')) as name, x.before as before,
          regexp_extract(x.before, r'(\S+)\s+$', 1) as one, regexp_extract(x.before, r'(\S+)\s+\S+\s+$', 1) as two,
          regexp_extract(x.after, r'^\s+(\S+)', 1) as next))"""))
    base = "concat(email, ip, card, phone)"
    shape = f"regexp_replace(regexp_replace(regexp_replace(x.core, {_sql_text(LONG_MIXED)}, '#'), '[0-9]{{}}', '9'), '[A-Za-z]+', 'a')"
    return frame.withColumn("tokens", F.expr(rf"""transform(filter(k, x -> length(x.core) > 0), x -> struct(
          x.start as start, x.start + length(x.core) as end, xxhash64(x.core) as instance,
          transform(filter(array(
              struct(x.name <> '' as have, concat('name ', x.name) as context, cast(null as bigint) as u, cast(null as bigint) as v),
              struct(x.name = '' and x.one <> '' as have, concat('before ', x.one) as context, xxhash64(x.one) as u, cast(null as bigint) as v),
              struct(x.name = '' and x.two <> '' as have, concat('before ', x.two, ' ', x.one) as context, xxhash64(x.one) as u, xxhash64(x.two) as v),
              struct(x.next <> '' as have, concat('after ', x.next) as context, xxhash64(x.next) as u, cast(null as bigint) as v)), y -> y.have),
            y -> struct(y.context as context, y.u as u, y.v as v, concat(y.context, ' ', {shape.replace("{}", "+")}) as pattern)) as patterns,
          xxhash64({shape.replace("{}", "")}) as shape,
          exists({base}, s -> s.start < x.start + length(x.core) and x.start < s.end) as based,
          exists({base}, s -> s.start >= x.start and s.start < x.start + length(x.core))
            or (x.core rlike {_sql_text(SECRET)} and concat(x.before, x.name) rlike {_sql_text(NAMED_SECRET)}) as seed))""")
                            ).drop("m", "g", "at", "before", "after", "k")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, email, ip, card, phone`` (arrays of base spans) and ``tokens`` of each row."""
    frame = docs.select(F.col(f"`{key}`").alias("doc_id"), text_of(text).alias("t"))
    frame = frame.withColumn("digits", F.col("t").rlike("[0-9]"))
    for kind in KINDS:
        frame = _spans(frame, kind)
    return _tokens(frame).drop("t", "digits").withColumn("row", F.monotonically_increasing_id())


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``h, n``: hashes of the lower-cased words of all texts and how often they stand there."""
    words = docs.select(F.explode(F.split(F.lower(F.translate(text_of(text), QUOTES, "")), r"\s+")).alias("w"))
    return words.select(F.xxhash64("w").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))


def confident(found: DataFrame, words: DataFrame, min_seeds: int = MIN_SEEDS, least: float = CONFIDENT,
              specific: float = SPECIFIC) -> tuple[DataFrame, ...]:
    """Scores of the pattern-instance graph: tables ``pattern``, ``context``, ``shape`` and ``instance, score``, each of the confident."""
    edges = (found.select(F.explode("tokens").alias("k"))
             .select(F.explode("k.patterns").alias("p"), "k.instance", "k.shape", "k.seed")
             .groupBy("p.context", "p.u", "p.v", "p.pattern", "shape", "instance").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("times")))
    edges = settle(edges, "pii-edges")
    # contexts of fewer instances can't hold min_seeds of them
    contexts = settle(edges.groupBy("context", "u", "v").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= min_seeds), "pii-contexts")
    wanted = contexts.select(F.explode(F.array("u", "v")).alias("h")).where("h is not null").distinct()
    counts = settle(words.join(wanted, "h", "left_semi"), "pii-words")
    for side in ("u", "v"):
        contexts = contexts.join(counts.select(F.col("h").alias(side), F.col("n").alias(f"n_{side}")), side, "left")
    live = settle(edges.join(contexts.select("context", F.coalesce(F.least("n_u", "n_v"), F.lit(0)).alias("places")), "context"), "pii-live")
    seeds = settle(edges.groupBy("instance", "shape").agg(F.max(F.col("seed").cast("double")).alias("first")), "pii-seeds")
    scores, before = seeds.select("instance", F.col("first").alias("score")), -1
    while True:
        scored = settle(live.join(scores, "instance"), "pii-scored")

        def trusted(node, name, scored=scored):
            by = scored.groupBy(node).agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias(name), F.max("places").alias("places"),
                                          F.sum(F.col("score") * F.col("times")).alias("held"),
                                          F.sum((F.col("score") >= least).cast("int")).alias("n"))
            return by.where((F.col("n") >= min_seeds) & (F.col("held") >= specific * F.col("places"))).select(node, name)

        patterns = settle(trusted("pattern", "trust"), "pii-patterns")
        alone = settle(trusted("context", "alone").where(F.col("alone") >= least), "pii-alone")
        in_alone = live.join(alone, "context", "left_semi").select("instance").distinct().withColumn("known", F.lit(1.0))
        shapes = settle(seeds.join(in_alone, "instance", "left").groupBy("shape").agg(
            F.avg(F.greatest("first", F.coalesce("known", F.lit(0.0)))).alias("share")).where(F.col("share") >= SHAPE).select("shape"), "pii-shapes")
        right = live.join(patterns, "pattern", "left").join(alone, "context", "left").join(shapes.withColumn("open", F.lit(True)), "shape", "left")
        right = right.withColumn("right", F.greatest(F.coalesce("trust", F.lit(0.0)), F.when(F.col("open"), F.col("alone")).otherwise(0.0)))
        doubt = right.where("right > 0").groupBy("instance").agg(F.exp(F.sum(F.log1p(-F.col("right")))).alias("doubt"))
        doubt = settle(doubt, "pii-doubt")
        scores = settle(scores.join(doubt, "instance", "left").select(
            "instance", F.greatest("score", 1 - F.coalesce("doubt", F.lit(1.0))).alias("score")), "pii-scores")
        sure = scores.where(F.col("score") >= least)
        if (n := sure.count()) == before:
            return patterns.where(F.col("trust") >= least).select("pattern"), alone.select("context"), shapes, sure
        before = n


def extract(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, email, ip, card, phone, context``: arrays of (start, end) in code points."""
    found = settle(find(docs, key, text), "pii-base")
    patterns, contexts, shapes, scores = confident(found, word_counts(docs, text))
    open_tokens = (found.select("row", F.explode("tokens").alias("k")).where("not k.based")
                   .select("row", "k.start", "k.end", "k.instance", "k.shape", F.explode("k.patterns").alias("p"))
                   .select("row", "start", "end", "instance", "shape", "p.context", "p.pattern"))
    for some, node in ((patterns, "pattern"), (contexts, "context"), (shapes, "shape")):
        open_tokens = open_tokens.join(some.withColumn(f"in_{node}", F.lit(True)), node, "left")
    unseen = (open_tokens.where("in_pattern or in_context and in_shape").join(scores.select("instance"), "instance")
              .groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("context")))
    unseen = settle(unseen, "pii-context")
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")
    return found.join(unseen, "row", "left").select("doc_id", *KINDS, F.coalesce("context", none).alias("context"))


def digest(spans: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans, and all spans as text; ``n_context`` and ``n_spans`` of those found and of all."""
    def of(kind):
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    def said(kinds):
        return F.array_join(F.concat(*[of(k) for k in kinds]), ",")

    return spans.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(said(KINDS), 256).alias("base_sha256"), said((*KINDS, "context")).alias("spans"),
                        F.size("context").cast("long").alias("n_context"),
                        sum(F.size(k) for k in (*KINDS, "context")).cast("long").alias("n_spans"))
