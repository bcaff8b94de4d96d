"""Lineage cutting for iterative operators.

Each round's state is written as a parquet table under the session's
``spark.checkpoint.dir`` and read back, which gives the next round a short
plan (scan of the written files) and survives executor loss: nothing lives
only in an executor's memory or local disk.  Row counts of written tables
come from an ``Observation`` on the writing job, so asking "did anything
change?" costs no scan.  Frames that operators return read these tables, so
they stay until their reader is done and calls ``graphmill.session.free_state``; what
only a loop needed goes when the loop ends (``StateStore.free``).

A loop that names its store (``resume=``) can be taken up by another driver: after each round it commits a manifest,
the round's numbers and the folders of its tables, and a later call of that name starts from the last one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphmill.session import delete_path, list_path, note_state, read_text, state_root, write_text


class StateStore:
    """Writes named state tables round by round and frees superseded ones.

    ``resume`` names the loop: its folder then outlives this process and ``free_state``, until ``forget``.  Tables that a
    manifest names are safe from being superseded until the next commit, if every version of them is committed.
    """

    def __init__(self, spark: SparkSession, tag: str, keep: int = 2, resume: str | None = None):
        self.spark = spark
        run = uuid.uuid4().hex[:12]
        self.home = f"{state_root(spark)}/{tag}-resume-{resume}" if resume else None
        self.base = f"{self.home}/run-{run}" if resume else f"{state_root(spark)}/{tag}-{run}"
        if not resume:
            note_state(self.base)
        self.keep = keep
        self._seq = self._commits = 0
        self._versions: dict[str, list[str]] = {}
        self._schemas: dict[str, T.StructType] = {}
        self._tables: list[str] = []

    def save(self, df: DataFrame, name: str, **metrics: Column) -> DataFrame | tuple[DataFrame, dict]:
        """Materialise ``df`` as a table and return a DataFrame reading it back.

        With ``metrics`` (name -> aggregate Column) the aggregates are observed
        while the same job writes the table, and ``(df, values)`` is returned;
        an aggregate over no rows gives ``None``.
        """
        path = f"{self.base}/{name}-{self._seq:05d}"
        self._seq += 1
        obs = None
        if metrics:
            obs = Observation(f"{name}-{self._seq}")
            df.observe(obs, *[c.alias(k) for k, c in metrics.items()]).write.mode("overwrite").parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
        versions = self._versions.setdefault(name, [])
        versions.append(path)
        self._schemas[name] = df.schema
        while len(versions) > self.keep:
            delete_path(self.spark, versions.pop(0))
        out = self.spark.read.schema(df.schema).parquet(path)
        return (out, dict(obs.get)) if obs is not None else out

    def save_bucketed(self, df: DataFrame, name: str, keys: list[str], buckets: int | None = None) -> DataFrame:
        """Write a loop-invariant input (e.g. the edges) as a table bucketed by ``keys``.

        Joins on ``keys`` then read it without a shuffle: every round of a loop
        moves only its (small) frontier to the edges' buckets instead of
        re-shuffling all edges.  The files live in the shared state folder.
        """
        n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"graphmill_{name}_{uuid.uuid4().hex[:12]}"
        path = f"{self.base}/{name}-{self._seq:05d}"
        self._seq += 1
        # hash-partition by the bucket keys first so each bucket is one file, not one per task
        df.repartition(n, *keys).write.bucketBy(n, *keys).option("path", path).saveAsTable(table)
        self._tables.append(table)
        note_state(path, table)
        return self.spark.table(table)

    def commit(self, tables: list[str], done: bool = False, **facts) -> None:
        """Note the end of a round: the last versions of ``tables`` and what else the loop needs (JSON values).

        Manifests have rising numbers and none is overwritten, so a driver that dies while writing one leaves the one before.
        With ``done``, all other tables of the loop go.  A store without a name does nothing.
        """
        if not self.home:
            return
        named = {t: (self._versions[t][-1], self._schemas[t].json()) for t in tables}
        self._commits += 1
        write_text(self.spark, f"{self.home}/manifest-{self._commits:08d}.json", json.dumps({"tables": named, "facts": facts, "done": done}) + "\n")
        delete_path(self.spark, f"{self.home}/manifest-{self._commits - 2:08d}.json")
        if done:
            for table in self._tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self._tables = []
            def of_run(path):
                return path.rsplit("/", 2)[1:]

            wanted = [of_run(path) for path, _ in named.values()]
            for run in list_path(self.spark, self.home):
                for folder in list_path(self.spark, run) if of_run(run)[1].startswith("run-") else []:
                    if of_run(folder) not in wanted:
                        delete_path(self.spark, folder)

    def resumed(self) -> tuple[dict[str, DataFrame], dict, bool] | None:
        """Tables, facts and whether the loop has ended, from the last whole manifest of this name."""
        if not self.home:
            return None
        found = sorted((p for p in list_path(self.spark, self.home) if "/manifest-" in p), reverse=True)
        for path in found:
            text = read_text(self.spark, path)
            if not text.endswith("\n"):
                continue  # its driver died while writing it
            m = json.loads(text)
            self._commits = int(found[0].rsplit("-", 1)[1].split(".")[0])
            tables = {}
            for name, (folder, schema) in m["tables"].items():
                self._versions[name], self._schemas[name] = [folder], T.StructType.fromJson(json.loads(schema))
                tables[name] = self.spark.read.schema(self._schemas[name]).parquet(folder)
            return tables, m["facts"], m["done"]
        return None

    def drop(self, name: str) -> None:
        """Delete what is left of a table that is needed no more."""
        for path in self._versions.pop(name, []):
            delete_path(self.spark, path)

    def free(self) -> None:
        """Delete everything that this store has written."""
        for table in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables, self._versions = [], {}
        delete_path(self.spark, self.base)


def forget(spark: SparkSession, tag: str, resume: str) -> None:
    """Delete the state of a loop of that name, its result with it."""
    delete_path(spark, f"{state_root(spark)}/{tag}-resume-{resume}")


def fingerprint(rows: DataFrame) -> list[int]:
    """Number of rows and a digest of them, whatever their order: tells whether a loop resumes on the rows that it began with."""
    return list(rows.select(F.xxhash64(*rows.columns).alias("h")).agg(
        F.count(F.lit(1)), F.coalesce(F.bit_xor("h"), F.lit(0)), F.coalesce(F.sum(F.col("h") % 1_000_003), F.lit(0))).first())


class DeltaLog:
    """A keyed table that grows by appended changes.

    A round writes only its changed rows.  ``current`` is the least value of each key (``least``: the column, or several, each by itself) or its
    latest row; when the appended rows outnumber the compacted ones (or ``parts`` tables have gathered), they
    are compacted into one table, so all compactions together write a few times the final state.  With ``parts=None`` none is.
    """

    def __init__(self, store: StateStore, name: str, keys: list[str], least: str | list[str] | None = None, parts: int | None = 12):
        self.store, self.name, self.keys, self.least, self.most = store, name, keys, [least] if isinstance(least, str) else least, parts
        self._base: DataFrame | None = None
        self._base_rows = self._new_rows = self.rows_written = 0
        self._parts: list[DataFrame] = []
        self._seq = 0

    def append(self, rows: DataFrame) -> tuple[DataFrame, int]:
        """Write changed rows; gives them back with their number."""
        part, m = self.store.save(rows, f"{self.name}-{self._seq}", rows=F.count(F.lit(1)))
        self._seq += 1
        n = m["rows"] or 0
        if n:
            self._parts.append(part.withColumn("_at", F.lit(self._seq)))
            self._new_rows += n
            self.rows_written += n
        elif self._base is None and not self._parts:
            self._base = part  # no rows yet
        if self.most and len(self._parts) > 1 and (len(self._parts) >= self.most or self._new_rows > 2 * max(self._base_rows, 1_000_000)):
            self._compact()
        return part, n

    def _every(self) -> DataFrame:
        parts = ([self._base.withColumn("_at", F.lit(0))] if self._base is not None else []) + self._parts
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def current(self) -> DataFrame:
        """The rows that stand, one a key."""
        if self._base is not None and not self._parts:
            return self._base
        every = self._every()
        rest = [c for c in every.columns if c not in self.keys and c != "_at"]
        if len(self._parts) == 1 and self._base is None:
            return every.drop("_at")
        if self.least:
            return every.groupBy(*self.keys).agg(*[F.min(c).alias(c) for c in self.least])
        if not rest:
            return every.select(*self.keys).distinct()
        return every.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "_at").alias("_row")).select(*self.keys, "_row.*")

    def _compact(self) -> None:
        self._base, m = self.store.save(self.current(), f"{self.name}-base", rows=F.count(F.lit(1)))
        self._base_rows, self._new_rows, self._parts = m["rows"] or 0, 0, []
        self.rows_written += self._base_rows


#: Rows of one key that a mirror holds, about.
MIRROR_ROWS = 256


class Mirrors:
    """A loop-invariant table bucketed by (key, salt): a hub's rows are dealt over as many mirrors as its measured degree asks for.

    ``meet`` joins it with rows on the key; a row on a hub goes to all of its mirrors, so each joins a share of the hub, and
    sums over the other end start as partial sums a mirror.
    """

    def __init__(self, store: StateStore, table: DataFrame, name: str, key: str, by: str, rows: int = MIRROR_ROWS):
        self.key = key
        table = store.save(table, f"{name}-rows")
        self.hubs = store.save(table.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("salts")).where(F.col("salts") > 1), f"{name}-hubs")
        self.none = self.hubs.isEmpty()
        dealt = table.withColumn("salt", F.lit(0)) if self.none else table.join(self.hubs, key, "left").withColumn(
            "salt", F.pmod(F.xxhash64(by), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
        self.table = store.save_bucketed(dealt, name, [key, "salt"])

    def meet(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with the key column) joined with the table."""
        if self.none:
            return rows.withColumn("salt", F.lit(0)).join(self.table, [self.key, "salt"]).drop("salt")
        over = rows.join(self.hubs, self.key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
        return over.drop("salts").join(self.table, [self.key, "salt"]).drop("salt")
