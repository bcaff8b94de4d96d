"""Edge-list, weighted edge-list and ego-net files.

* edge list: one edge per line, ``src<whitespace>dst[<whitespace>ignored...]``;
  blank lines and lines starting with ``#`` are skipped; fewer than two
  tokens or a non-integer id fails the job; weight is 1.0;
* weighted edge list: ``src<TAB>dst<TAB>weight``, blank and ``#`` lines skipped;
* ego nets: one file per ego whose path carries the ego id (default
  ``<ego>.egonet``); each line ``src: d1 d2 ...``; an empty list (``src:`` or
  ``src: ``) stands for a self loop ``(src, src)``.  Lines of many egos may share a
  file when each starts with ``ego<TAB>``; that is what the writer makes, as a
  file per ego costs file-system work per ego.

Readers are plain ``spark.read`` scans, so files split across executors and
nothing passes through the driver.  Writers use ``DataFrame.write``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from graphmill.functions.graph import canonical as to_canonical

EGO_FILE_PATTERN = r"(\d+)\.egonet$"


MODES = ("failfast", "permissive")


def _checked(rows: DataFrame, mode: str, canonical: bool) -> DataFrame:
    """Edges of ``rows (src, dst, weight, _bad)``; ``_bad`` is the line that isn't an edge, else null."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "failfast":
        bad = F.raise_error(F.concat(F.lit("malformed edge line: "), F.col("_bad")))
        rows = rows.select(F.when(F.col("_bad").isNotNull(), bad.cast("long")).otherwise(F.col("src")).alias("src"), "dst", "weight")
        return to_canonical(rows) if canonical else rows
    rows = rows.withColumnRenamed("_bad", CORRUPT)
    return to_canonical(rows) if canonical else rows


#: Column of a permissive reader: the line that isn't an edge (its other columns are null), else null.
CORRUPT = "corrupt_line"


def drop_corrupt(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Edges of a permissive read, and an observation whose ``get["dropped"]`` counts the corrupt lines once the edges
    have been used by a job."""
    seen = Observation(f"corrupt-{uuid.uuid4().hex[:8]}")
    counted = rows.observe(seen, F.count(CORRUPT).alias("dropped"))
    return counted.where(F.col(CORRUPT).isNull()).drop(CORRUPT), seen


def _lines(spark: SparkSession, path: str):
    body = F.trim(F.col("value"))
    return spark.read.text(path).where((body != "") & ~body.startswith("#")), body


def read_edge_list(spark: SparkSession, path: str, canonical: bool = False, mode: str = "failfast") -> DataFrame:
    """``(src, dst, weight=1.0)``; ``canonical=True`` orients every edge small id -> large id.

    ``mode="permissive"`` keeps a malformed line in a column ``corrupt_line`` (see ``drop_corrupt``) instead of failing.
    """
    lines, body = _lines(spark, path)
    toks = F.split(body, r"\s+")
    src, dst = (F.try_element_at(toks, F.lit(k)).try_cast("long") for k in (1, 2))
    rows = lines.select(src.alias("src"), dst.alias("dst"), body.alias("line"))
    ok = F.col("src").isNotNull() & F.col("dst").isNotNull()
    return _checked(rows.select(*[F.when(ok, F.col(c)).alias(c) for c in ("src", "dst")], F.when(ok, F.lit(1.0)).alias("weight"),
                                F.when(~ok, F.col("line")).alias("_bad")), mode, canonical)


def read_weighted_edge_list(spark: SparkSession, path: str, canonical: bool = False, mode: str = "failfast") -> DataFrame:
    """``(src, dst, weight)`` from tab-separated lines; blank lines and lines starting with ``#`` are skipped.

    A malformed line fails the job, or with ``mode="permissive"`` is kept in a column ``corrupt_line``.
    """
    lines, body = _lines(spark, path)
    toks = F.split(F.col("value"), "\t")
    src, dst = (F.trim(F.try_element_at(toks, F.lit(k))).try_cast("long") for k in (1, 2))
    weight = F.trim(F.try_element_at(toks, F.lit(3))).try_cast("double")
    rows = lines.select(src.alias("src"), dst.alias("dst"), weight.alias("weight"), (F.size(toks) == 3).alias("three"), F.col("value").alias("line"))
    ok = F.col("src").isNotNull() & F.col("dst").isNotNull() & F.col("weight").isNotNull() & F.col("three")
    return _checked(rows.select(*[F.when(ok, F.col(c)).alias(c) for c in ("src", "dst", "weight")], F.when(~ok, F.col("line")).alias("_bad")), mode, canonical)


def read_ego_nets(spark: SparkSession, path: str, pattern: str = EGO_FILE_PATTERN) -> DataFrame:
    """``(ego_id, src, dst)`` from ego-net files; the ego id stands before a tab in the line, or
    else is group 1 of ``pattern`` matched against the file path (a line with neither
    fails the job)."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"))
    lines = lines.select(F.when(F.contains("value", F.lit("\t")), F.split("value", "\t", 2)[0])
                         .otherwise(F.regexp_extract("path", pattern, 1)).alias("ego"),
                         F.element_at(F.split("value", "\t", 2), -1).alias("value"), "path")
    ego = F.trim("ego")
    parts = F.split(F.col("value"), ":", 2)
    dsts = F.filter(F.split(F.trim(F.coalesce(parts[1], F.lit(""))), r"\s+"), lambda x: x != "")
    rows = (lines.where(F.trim("value") != "")
            .select(F.when(ego == "", F.raise_error(F.concat(F.lit("no ego id in path: "), F.col("path"))))
                    .otherwise(ego).cast("long").alias("ego_id"),
                    F.trim(parts[0]).cast("long").alias("src"), dsts.alias("dsts")))
    return rows.select("ego_id", "src", F.explode_outer("dsts").alias("d")).select(
        "ego_id", "src", F.coalesce(F.col("d").cast("long"), F.col("src")).alias("dst"))


def write_edge_list(edges: DataFrame, path: str, weighted: bool = False, mode: str = "overwrite") -> None:
    """Write ``src dst`` lines (or ``src<TAB>dst<TAB>weight`` with ``weighted=True``)."""
    if weighted:
        edges.select("src", "dst", "weight").write.mode(mode).csv(path, sep="\t")
    else:
        edges.select(F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string")).alias("v")) \
            .write.mode(mode).text(path)


def write_ego_nets(ego_edges: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``ego<TAB>src: d1 d2 ...`` lines into ordinary part files; a vertex whose only
    edge is a self loop gets an empty list."""
    alone = (F.size("d") == 1) & (F.col("d")[0] == F.col("src"))
    (ego_edges.groupBy("ego_id", "src").agg(F.sort_array(F.collect_list("dst")).alias("d"))
     .select(F.concat(F.col("ego_id").cast("string"), F.lit("\t"), F.col("src").cast("string"), F.lit(": "),
                      F.when(alone, "").otherwise(F.array_join(F.transform("d", lambda x: x.cast("string")), " "))).alias("value"))
     .write.mode(mode).text(path))


def write_vertices(vertices: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Vertex results ``(id, ...)`` as parquet (default) or csv."""
    vertices.write.mode(mode).format(fmt).save(path)


def write_graph(vertices: DataFrame, edges: DataFrame, path: str, fmt: str = "parquet",
                mode: str = "overwrite") -> None:
    """Write a graph as ``<path>/vertices`` and ``<path>/edges``."""
    vertices.write.mode(mode).format(fmt).save(f"{path}/vertices")
    edges.write.mode(mode).format(fmt).save(f"{path}/edges")
