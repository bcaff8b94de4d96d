"""Edge tables projected from the TPC-H-like test tables.

Every projection reads the whole ``lineitem`` table and is linear in it: a line
links only to the next line slot of its order, never to all lines of the order,
so a huge order cannot blow up quadratically.  Duplicate line numbers are first
collapsed to ``(order, line, key, multiplicity)`` and the pair weight is the
product of multiplicities.  The ``*_SQL`` strings are the same definitions as
DuckDB CTE bodies for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the projections: seeds (landmarks, roots, origins) are the parts of this size and type.
SEED_SIZE, SEED_TYPE = 50, "ECONOMY"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _slots(lines: DataFrame, shift: int, **values) -> DataFrame:
    """Collapse lines to one row ``(o, n, k)`` per order, line slot (moved by ``shift``) and part, with ``values``.

    Lines meet by slot, so a join on the slot needs no other exchange."""
    slots = lines.select(F.col("l_orderkey").alias("o"), (F.col("l_linenumber") + shift).alias("n"), F.col("l_partkey").alias("k"), F.col("l_quantity").alias("q"))
    return slots.repartition("o", "n").groupBy("o", "n", "k").agg(*[v.alias(c) for c, v in values.items()])


def part_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G_PART: ``a.l_partkey -> b.l_partkey`` for consecutive line slots of one order,
    parts differ; ``weight`` = sum of ``a.l_quantity`` over pairs."""
    li = table(spark, sf_dir, "lineitem")
    a = _slots(li, 1, q=F.sum("q")).withColumnRenamed("k", "src")
    b = _slots(li, 0, cb=F.count(F.lit(1))).withColumnRenamed("k", "dst")
    return (a.join(b, ["o", "n"]).where(F.col("src") != F.col("dst"))
            .groupBy("src", "dst").agg(F.sum(F.col("q") * F.col("cb")).alias("weight")))


PART_GRAPH_SQL = """
  g_part AS (
    WITH a AS (SELECT l_orderkey o, l_linenumber n, l_partkey k, sum(l_quantity) q FROM lineitem
               GROUP BY 1, 2, 3),
         b AS (SELECT l_orderkey o, l_linenumber n, l_partkey k, count(*) c FROM lineitem GROUP BY 1, 2, 3)
    SELECT a.k AS src, b.k AS dst, sum(a.q * b.c) AS weight
    FROM a JOIN b ON a.o = b.o AND b.n = a.n + 1 AND a.k <> b.k
    GROUP BY 1, 2)"""


def customer_ego_nets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ego nets ``(ego_id, src, dst)``: one ego per customer; inside it the supplier of
    each line links to the supplier of the next line slot of the same order, and a
    line with no next slot gives a self loop of its supplier (an ego-file line with an
    empty list).  Distinct rows."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey").distinct()
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                   F.col("o_custkey").alias("ego_id"))
    a = li.join(orders, "l_orderkey")
    nxt = li.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"),
                    F.col("l_suppkey").alias("dst"))
    return (a.join(nxt, ["l_orderkey", "l_linenumber"], "left")
            .select("ego_id", F.col("l_suppkey").alias("src"), F.coalesce("dst", "l_suppkey").alias("dst"))
            .distinct())


EGO_NETS_SQL = """
  ego AS (
    WITH li AS (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem)
    SELECT DISTINCT o.o_custkey AS ego_id, a.l_suppkey AS src, coalesce(b.l_suppkey, a.l_suppkey) AS dst
    FROM li a JOIN orders o ON o.o_orderkey = a.l_orderkey
    LEFT JOIN li b ON b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)"""


def part_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertex labels ``(id, label)`` = part size."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("long").alias("label"))


PART_SIZES_SQL = """
  sizes AS (SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS label FROM part)"""


def seed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds ``(id)``: the parts of ``SEED_SIZE`` and ``SEED_TYPE``."""
    return (table(spark, sf_dir, "part").where((F.col("p_size") == SEED_SIZE) & (F.col("p_type") == SEED_TYPE))
            .select(F.col("p_partkey").alias("id")))


SEEDS_SQL = f"""
  seeds AS (SELECT p_partkey AS id FROM part WHERE p_size = {SEED_SIZE} AND p_type = '{SEED_TYPE}')"""


def with_sql(*ctes: str) -> str:
    """``WITH`` clause of the given CTE bodies (prefix of an oracle query)."""
    return "WITH RECURSIVE " + ",".join(ctes) + "\n"
