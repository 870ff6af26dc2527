"""Helpers that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardbook.sources.staging import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """Write a table into the shared folder and go on from its files.

    What follows reads the same rows however often it runs, also after an
    executor is lost, and the plan before it does not run again.
    """
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` as one, ``_docs``, so that no name of theirs meets one that an operator adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_docs"))


def unpacked(rows: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns out of ``_docs`` again, those named in ``new`` with new values."""
    return rows.select([(new[c] if c in new else F.col("_docs").getField(c)).alias(c) for c in columns])


def _release() -> None:
    """Give memory that is free inside this process back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over the batches of a task, after which its worker keeps no free memory.

    Workers are kept for later tasks, and an executor has several of them.
    """

    def run(batches):
        try:
            yield from work(batches)
        finally:
            _release()

    return run
