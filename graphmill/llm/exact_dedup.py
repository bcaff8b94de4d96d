"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut after a sentence end or line break at least ``MIN_CHUNK``
characters from the last cut, and at ``MAX_CHUNK`` at the latest, so its cuts
depend on content alone.  A chunk's identifier is its XXH64; identifiers are
verified by the SHA-256 of all chunks that carry them, and chunks of an
identifier with more than one SHA-256 take that digest instead.  Texts are
equal when their ordered lists of verified identifiers are.  Texts are read
once; only lists move afterwards, and of a hot group one row per map task.

Cases: null texts count as empty and equal each other; of repeated rows (equal
``doc_id`` and text) one stays; null ids lose to any id, and among null ids one
row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphmill.llm.common import may_hold, settle, text_of, unused

MIN_CHUNK, MAX_CHUNK = 256, 2048
CUTS = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 2}}}?(?:[.!?]\s|\n)|.{{1,{MAX_CHUNK}}}"
#: Colliding identifiers that are written into an expression; beyond that all lists are of SHA-256.
FEW = 1000


def recipes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_sha256, chunks``: per row the digest and the list of (identifier, SHA-256) of its chunks."""
    t = text_of(text)
    chunks = F.transform(F.regexp_extract_all(t, F.lit(CUTS), F.lit(0)),
                         lambda c: F.struct(F.xxhash64(c).alias("id"), F.unhex(F.sha2(c, 256)).alias("sha")))
    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.sha2(t, 256).alias("text_sha256"), chunks.alias("chunks"))


def collisions(recipe: DataFrame) -> DataFrame:
    """Identifiers that stand for more than one chunk."""
    return (recipe.select(F.explode(F.array_distinct("chunks")).alias("c")).select("c.id", "c.sha").distinct()
            .groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    recipe = settle(recipes(docs, key, text), "recipes")
    clash = [r["id"] for r in collisions(recipe).limit(FEW + 1).collect()]  # a digest collision of 64 bits each
    if len(clash) > FEW:
        ids, more = F.transform("chunks", lambda c: F.lit(0).cast("long")), F.transform("chunks", lambda c: c["sha"])
    else:
        ids = F.transform("chunks", lambda c: c["id"])
        among = F.array(*[F.lit(i).cast("long") for i in clash]) if clash else F.array().cast("array<long>")
        more = F.transform(F.filter("chunks", lambda c: F.array_contains(among, c["id"])), lambda c: c["sha"])
    rows = (recipe.select("doc_id", "text_sha256", ids.alias("ids"), more.alias("more"))
            .groupBy("doc_id", "text_sha256", "ids", "more").agg(F.count(F.lit(1)).alias("n")))
    rows = settle(rows, "lists")
    groups = (rows.groupBy("ids", "more").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
              .where("group_size > 1"))
    groups = settle(groups, "groups")
    out = rows.join(groups, ["ids", "more"], "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256",
        F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy", "_"))
    return out.select("doc_id", "keep_id", "group_size",
                      (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops; only rows that may be dropped are moved."""
    groups = settle(exact_groups(docs, key, text), "exact")
    gone = groups.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    gone = settle(gone.where("not kept or n > 1"), "gone")
    own, sha, stays = unused(docs, "own_id"), unused(docs, "own_sha"), unused(docs, "stays")
    some, others = may_hold(docs, F.xxhash64(F.col(f"`{key}`")), gone.select(F.xxhash64("doc_id").alias("k")), gone.count())
    gone = gone.select(F.col("doc_id").alias(own), F.col("text_sha256").alias(sha), F.col("kept").alias(stays))
    same = F.col(own).eqNullSafe(F.col(f"`{key}`")) & (F.col(sha) == F.sha2(text_of(text), 256))
    out = others.unionByName(some.join(gone, same, "left_anti"))
    again = gone.where(F.col(stays))
    if again.isEmpty():
        return out
    # repeated rows with one id and text: one of each stays
    one = some.join(again, same, "left_semi").withColumn(sha, F.sha2(text_of(text), 256)).dropDuplicates([key, sha])
    return out.unionByName(one.drop(sha))
