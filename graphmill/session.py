"""Session helpers: a local session for tests/bench and the shared state folder."""

from __future__ import annotations

import logging
import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


#: State folders and tables that this process has written and not freed.
_written: list[tuple[str, str]] = []


def driver_heap_gb() -> int:
    """Heap of a local session: two fifths of the machine's memory (Python workers and the system need the rest), at most 16 GB."""
    try:
        with open("/sys/fs/cgroup/memory.max") as f:
            limit = int(f.read())
    except (OSError, ValueError):  # no limit
        limit = 1 << 62
    there = min(limit, os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES"))
    return max(1, min(16, there * 2 // 5 >> 30))


def note_state(path: str, table: str = "") -> None:
    """Remember a state folder (or the table over it) for ``free_state``."""
    _written.append((path, table))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system; a failure is logged, as nothing depends on it."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception as ex:  # pragma: no cover - e.g. Spark Connect sessions
        logging.getLogger(__name__).warning("state %s was not deleted: %s", path, ex)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_path(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder of the shared file system (nothing, if there is none)."""
    fs, p = _file_system(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(p)] if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file to the shared file system."""
    fs, p = _file_system(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Read a small file of the shared file system."""
    fs, p = _file_system(spark, path)
    given = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(given, "UTF-8")
    finally:
        given.close()


def free_state(spark: SparkSession) -> int:
    """Delete all state that this process has written so far, and give the number of folders.

    For a caller that has written or read its results: frames that operators returned before can't be read afterwards.
    """
    n = len(_written)
    while _written:
        path, table = _written.pop()
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete_path(spark, path)
    return n


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "graphmill",
                  checkpoint_dir: str | None = None, extra: dict | None = None) -> SparkSession:
    """A ``local[cores]`` session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", f"{driver_heap_gb()}g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if checkpoint_dir:
        builder = builder.config(CHECKPOINT_CONF, checkpoint_dir)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def state_root(spark: SparkSession) -> str:
    """Shared folder for lineage-cutting tables: the session's ``spark.checkpoint.dir``.

    On a cluster the setting must name shared storage (HDFS/S3/...).  Only a
    local-mode session without the setting (tests, bench) gets a fresh
    temporary folder, which is then registered as the context's checkpoint dir.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; iterative graph operators need a shared "
                "folder to cut lineage on a cluster")
        root = tempfile.mkdtemp(prefix="graphmill-state-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")
