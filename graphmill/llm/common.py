"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.session import state_root

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table that all executors see, so that a lost
    executor costs its running tasks only.  A join with the table gets an
    exchange of its own, which AQE can split where a key is hot; an aggregate
    that feeds a join directly can't be split.
    """
    spark = df.sparkSession
    path = f"{state_root(spark)}/llm-{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a table of keys: 16 for each key, and at most so many (a broadcast of 2 ** 20 rows).
FEWEST_BITS, MOST_BITS = 16, 26


def may_hold(rows: DataFrame, key: Column, keys: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``key`` may be among ``n`` 64-bit hashes ``keys (k)``, and rows whose key surely isn't.

    The hashes become a table of bits of bounded size that all tasks get, so a join that needs the exact answer moves
    the few rows that may have it and the others stay where they are.  Beyond its bound the table fills up: more rows
    move, none is lost.
    """
    bits = min(max((16 * n).bit_length(), FEWEST_BITS), MOST_BITS)

    def place(k):
        return F.shiftrightunsigned(k, 64 - bits)

    at, held = unused(rows, "bits_at"), unused(rows, "bits_held")
    slot = place(F.col("k"))
    table = settle(keys.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias(at)).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias(held)), "key-bits")
    own = unused(rows, "bits_slot")
    marked = rows.withColumn(own, place(key)).withColumn(at, F.shiftright(own, 6)).join(F.broadcast(table), at, "left")
    hit = F.expr(f"shiftright(coalesce(`{held}`, 0L), CAST(`{own}` & 63 AS INT)) & 1") == 1
    return tuple(marked.where(x).select(*[F.col(f"`{c}`") for c in rows.columns]) for x in (hit, ~hit))


def bounded_batches(spark: SparkSession, size: int = 16 << 20) -> None:
    """Bound the bytes of an Arrow batch, so that very long texts don't pile up in one."""
    have = int(spark.conf.get(BATCH_BYTES, None) or -1)
    if have < 0 or have > size:
        spark.conf.set(BATCH_BYTES, str(size))


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def text_of(name: str = "text"):
    """A text column, null as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary array and its n + 1 offsets, without a copy; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def spans_of_rows(offsets: np.ndarray, size: int):
    """Ranges of rows ``(first, end)`` of about ``size`` bytes each; one long row is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end
