"""Multi-party perspective rotation of dialogues, in DataFrame functions only.

For every participant (every speaker but the system) the dialogue is rendered
once with that speaker as the assistant, the others as named users and system
turns as they are.  A rendering is a sequence of turns; each row holds one turn's
text, its code-point range in the whole rendering, and the range that counts in
the loss (the assistant's words and the end mark).  Turns in ``position`` order,
concatenated, are the whole rendering.

A long dialogue is never gathered: turns are range-partitioned and written, each
part gets running sums of its own, and parts are moved by the sums before them
(one row a part).

A turn can't forge another: in texts and shown names, a mark gets a backslash after its ``<`` (also one that has
some already, so taking one away gives the text back), and a line break in a shown name becomes a space.
``name`` and ``perspective`` are as given.

Cases: a null text is an empty turn; a null speaker is called ``unknown``; a null
conversation id is one conversation; turns are ordered by number (null first),
then speaker, then digest of the text, and repeated rows are turns of their own;
a conversation of system turns alone has no participant and gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphmill.llm.common import settle, text_of

SYSTEM, UNKNOWN = "system", "unknown"
BEGIN, END = "<|im_start|>", "<|im_end|>"
ORDER = ("turn", "speaker", "digest")
#: A mark, or one that was escaped before, and what takes its place.
MARK, ESCAPED = r"<(\\*)\|(im_start|im_end)\|>", r"<\\$1|$2|>"
BREAKS = r"[\n\r]"


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, perspective, position, turn, role, name, rendered, start, end, loss_start, loss_end``."""
    base = turns.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                        F.coalesce(F.col(f"`{speaker}`").cast("string"), F.lit(UNKNOWN)).alias("speaker"), text_of(text).alias("text"))
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = base.withColumn("digest", F.md5("text")).repartitionByRange(n, "conv_id", *ORDER)
    base = settle(base.withColumn("part", F.spark_partition_id()), "turns")
    people = settle(base.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("__conv"), F.col("speaker").alias("perspective"))
                    .distinct(), "participants")
    rows = base.join(people, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    own, system = F.col("speaker") == F.col("perspective"), F.col("speaker") == SYSTEM
    rows = rows.withColumns({
        "role": F.when(system, SYSTEM).when(own, "assistant").otherwise("user"),
        "name": F.when(~system & ~own, F.col("speaker"))})
    shown = F.regexp_replace(F.regexp_replace("name", BREAKS, " "), MARK, ESCAPED)
    head = F.concat(F.lit(BEGIN), F.col("role"), F.when(F.col("name").isNotNull(), F.concat(F.lit(" name="), shown)).otherwise(""), F.lit("\n"))
    rows = rows.withColumns({"head": F.length(head), "rendered": F.concat(head, F.regexp_replace("text", MARK, ESCAPED), F.lit(END), F.lit("\n"))})
    within = Window.partitionBy("conv_id", "perspective", "part").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    rows = settle(rows.withColumns({"rank": F.row_number().over(within.rowsBetween(Window.unboundedPreceding, 0)),
                                    "stop": F.sum(F.length("rendered")).over(within)}).drop("text", "digest"), "rendered")
    before = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (rows.groupBy("conv_id", "perspective", "part").agg(F.count(F.lit(1)).alias("n"), F.max("stop").alias("size"))
             .select(F.col("conv_id").alias("__conv"), F.col("perspective").alias("__who"), F.col("part").alias("__part"),
                     F.coalesce(F.sum("n").over(before), F.lit(0)).alias("turns_before"),
                     F.coalesce(F.sum("size").over(before), F.lit(0)).alias("chars_before")))
    parts = settle(parts, "dialogue-parts")
    out = rows.join(parts, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("perspective") == F.col("__who"))
                    & (F.col("part") == F.col("__part")))
    end = F.col("chars_before") + F.col("stop")
    start = end - F.length("rendered")
    trained = F.col("role") == "assistant"
    return out.select("conv_id", "perspective", (F.col("turns_before") + F.col("rank") - 1).cast("long").alias("position"), "turn", "role", "name",
                      "rendered", start.cast("long").alias("start"), end.cast("long").alias("end"),
                      F.when(trained, start + F.col("head")).cast("long").alias("loss_start"),
                      F.when(trained, end - 1).cast("long").alias("loss_end"))


#: The same in DuckDB's notation.
_SQL_ESCAPE = f"'{MARK}', '" + r"<\\\1|\2|>" + "', 'g')"
ROTATE_SQL = f"""
WITH base AS (SELECT conv_id, turn, coalesce(role, '{UNKNOWN}') AS speaker, coalesce(text, '') AS text FROM conversations),
people AS (SELECT DISTINCT conv_id AS conv, speaker AS perspective FROM base WHERE speaker <> '{SYSTEM}'),
said AS (SELECT conv_id, perspective, turn, speaker, md5(text) AS digest, text,
    CASE WHEN speaker = '{SYSTEM}' THEN '{SYSTEM}' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
    CASE WHEN speaker <> '{SYSTEM}' AND speaker <> perspective THEN speaker END AS name
  FROM base JOIN people ON conv_id IS NOT DISTINCT FROM conv),
headed AS (SELECT *, '{BEGIN}' || role || coalesce(' name=' || regexp_replace(regexp_replace(name, '{BREAKS}', ' ', 'g'), {_SQL_ESCAPE}, '')
    || chr(10) AS head FROM said),
shown AS (SELECT *, head || regexp_replace(text, {_SQL_ESCAPE} || '{END}' || chr(10) AS rendered FROM headed),
placed AS (SELECT *, row_number() OVER w - 1 AS position, sum(length(rendered)) OVER w AS stop FROM shown
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, digest ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, CAST(position AS BIGINT) AS position, turn, role, name, rendered,
  CAST(stop - length(rendered) AS BIGINT) AS start, CAST(stop AS BIGINT) AS "end",
  CAST(CASE WHEN role = 'assistant' THEN stop - length(rendered) + length(head) END AS BIGINT) AS loss_start,
  CAST(CASE WHEN role = 'assistant' THEN stop - 1 END AS BIGINT) AS loss_end
FROM placed"""
