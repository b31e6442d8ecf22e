"""New telemetry files as streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetwatt.sources.json_records import ENVELOPES, read_payloads, records, vehicle_from_path


def stream_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    vehicle_pattern: str,
    envelopes: Sequence[str] = ENVELOPES,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Records of new product files, as ``sources.json_records.records`` gives them.

    How files are cut into batches changes no result of a ``DayStore``.
    """
    payloads = read_payloads(spark, path, stream_files=files_per_batch)
    return records(vehicle_from_path(payloads, vehicle_pattern), schema, envelopes)


def stream_parquet(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New files of a Parquet table; the schema is that of the files present."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def drain(stream: DataFrame, checkpoint: str, mode: str = "append"):
    """Writer that takes all files present, in batches, and then stops."""
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
