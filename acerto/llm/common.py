"""Helpers that several text operators use."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acerto.sources.scratch import new_folder, shared_folder, until_end

#: White space between words, as a character class for a regular expression.
SPACE = r"\x20\x09-\x0D"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else.

    By the Guava class that Spark comes with: translate() looks up every character in a map
    and takes a hundred times as long.
    """
    return F.reflect(F.lit("com.google.common.base.Ascii"), F.lit("toLowerCase"), text)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read again.

    Cuts the lineage, so a lost executor costs one reread, and gives the planner the
    table's true size. The table stays until the driver ends, as later results may still be read from it.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(until_end(spark, path))


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` through checkpoint() into the shared folder; Spark removes it when unused if
    spark.cleaner.referenceTracking.cleanCheckpoints is set."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def sampled(df: DataFrame, key: str, rows: int, total: int | None = None) -> DataFrame:
    """About `rows` rows of `df`, picked by the hash of `key`; never over twice as many.

    For fitting models on a bounded sample. The choice is the same in every run as long as
    the bound of twice `rows` is not reached, which only repeated keys can bring about.
    """
    total = df.count() if total is None else total
    if total <= rows:
        return df
    share = int(rows / total * 2**31)
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(2**31)) < share).limit(2 * rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batch: pa.RecordBatch, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """`batch` in parts of about `size` bytes, at least one row each, to bound the memory of a step."""
    rows = batch.num_rows
    step = max(1, int(rows * size / max(batch.nbytes, 1)))
    for start in range(0, rows, step):
        yield batch.slice(start, step)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bounds the rows of the session's Arrow batches, which Spark counts but does not weigh: 10,000 long texts take much
    memory in the JVM and in the worker. A smaller bound stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def settle() -> None:
    """Gives free memory back to the system. A Python worker keeps what numpy and Arrow have freed, and stays between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


_HELD: list[Callable[[], None]] = []


def held_by_worker(free: Callable[[], None]) -> None:
    """Registers what frees memory that a Python worker holds from task to task."""
    _HELD.append(free)


def free_held() -> None:
    """Frees what earlier tasks of other operators hold in this Python worker, for tasks that need the memory."""
    for free in _HELD:
        free()
    settle()
