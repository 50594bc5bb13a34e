"""Helpers shared by the operators: reading, staging, document keys."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL twin if it has one."""
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read the copy: it cuts the
    lineage, and a lost executor rereads the files."""
    path = shared_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give memory that earlier tasks of this Python worker have freed back to
    the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches, rows: int = 512):
    """The Arrow batches in smaller ones, so that a task turns few texts into
    Python strings at a time."""
    release()
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
        del b
    release()


def text_or_empty(col: str = "text") -> Column:
    """Null texts count as empty ones."""
    return F.coalesce(F.col(col), F.lit(""))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Columns that name a row whatever its id: the id, two hashes of the text
    and its length.  Rows that agree in all four are copies of one row."""
    t = text_or_empty(text_col)
    return [F.col(id_col).alias("k_id"), F.xxhash64(t).alias("k_h1"), F.hash(t).alias("k_h2"),
            F.length(t).alias("k_len")]


KEY = ["k_id", "k_h1", "k_h2", "k_len"]


def same_key(a: DataFrame, b: DataFrame, cols: list[str] = KEY) -> Column:
    """Null-safe equality of the row keys of two frames."""
    cond = a[cols[0]].eqNullSafe(b[cols[0]])
    for c in cols[1:]:
        cond = cond & (a[c] == b[c])
    return cond
