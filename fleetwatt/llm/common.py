"""Helpers shared by the text operators: tables, shared storage, byte views of Arrow columns."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import fleetwatt
from fleetwatt.session import shared_dir

# Bytes of text that one step of a Python task works on; a longer document is a step of its own.
STEP_BYTES = 1 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package from where the driver has it.

    On a cluster the package is sent along (``--py-files``) or installed.
    """
    root = str(Path(fleetwatt.__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = [part for part in environment.get("PYTHONPATH", "").split(os.pathsep) if part]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: the plan is cut and its size is known to the planner."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(documents: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and named columns only, so that no other column can clash with a result."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; NULL ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def held_out(doc_id: Column, divisor: int, remainder: int) -> Column:
    return crc_remainder(doc_id, divisor) == remainder


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; NULL counts as empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    all_bytes = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return all_bytes[at[0] : at[-1]], at - at[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges with about ``limit`` bytes each, in order, covering all rows."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def text_steps(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the bytes and offsets of their texts."""
    for batch in batches:
        data, offsets = byte_view(batch.column(batch.schema.get_field_index(column)))
        for start, stop in steps(offsets):
            yield (
                batch.slice(start, stop - start),
                data[offsets[start] : offsets[stop]],
                offsets[start : stop + 1] - offsets[start],
            )
    # The worker lives on for other tasks; what this one has used goes back.
    pa.default_memory_pool().release_unused()
