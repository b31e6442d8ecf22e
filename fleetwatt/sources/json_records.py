"""Scan of JSON payloads that hold lists of records.

A payload is ``{"recordData": [...]}`` or a bare ``[...]``. Daily product files
hold one payload each; compacted landing files hold one payload per line, which
Spark can split, and are the form to use when single files grow large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_DATA = "record_data"
BARE_LIST = "list"
ALL_FIELDS = T.MapType(T.StringType(), T.StringType())
ENVELOPES = (RECORD_DATA, BARE_LIST)

# Place of a record in its source: later files, then later records, win over earlier ones.
SOURCE_ORDER = "source_order"


def read_payloads(
    spark: SparkSession, paths: str | Sequence[str], whole_file: bool = True, stream_files: int | None = None
) -> DataFrame:
    """Payload texts of the files matching ``paths`` as (file, chunk, line, value).

    No match raises. With ``stream_files`` the result is a stream that takes up
    to that many new files per batch.
    """
    if stream_files is None:
        lines = spark.read.text(paths, wholetext=whole_file)
    else:
        lines = spark.readStream.option("maxFilesPerTrigger", stream_files).text(paths, wholetext=whole_file)
    if whole_file:
        chunk, line = F.lit(0).cast("long"), F.lit(0).cast("long")
    else:
        # Within one split of a file the row ids rise with the lines.
        chunk, line = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    return lines.select(F.col("_metadata.file_path").alias("file"), chunk.alias("chunk"), line.alias("line"), "value")


def vehicle_from_path(payloads: DataFrame, pattern: str) -> DataFrame:
    """Add ``vehicle``, the first group of ``pattern`` in the file path."""
    return payloads.withColumn("vehicle", F.regexp_extract("file", pattern, 1))


def _objects(items: Column, schema: T.DataType) -> Column:
    """Parse the list elements that are objects, one by one."""
    return F.transform(F.filter(items, lambda item: item.startswith("{")), lambda item: F.from_json(item, schema))


def _record_list(value: Column, schema: T.DataType, envelopes: Sequence[str], lenient: bool) -> Column:
    whole = T.ArrayType(schema)
    items = T.ArrayType(T.StringType())

    def in_envelope(content: T.DataType) -> T.StructType:
        return T.StructType([T.StructField("recordData", content)])

    # One element that is no object voids the whole typed parse; only such
    # payloads are parsed again, element by element.
    is_list, is_dict = value.rlike(r"^\s*\["), value.rlike(r"^\s*\{")
    bare = F.coalesce(F.from_json(value, whole), _objects(F.from_json(value, items), schema))
    wrapped = F.coalesce(
        F.from_json(value, in_envelope(whole))["recordData"],
        _objects(F.from_json(value, in_envelope(items))["recordData"], schema),
    )
    nothing = F.lit(None).cast(whole)
    found = F.when(is_list, bare if BARE_LIST in envelopes else nothing).when(
        is_dict, wrapped if RECORD_DATA in envelopes else nothing
    )
    if lenient:
        return found
    broken = F.raise_error(F.concat(F.lit("malformed JSON payload in "), F.col("file"))).cast(whole)
    return F.coalesce(found, F.when(malformed(value), broken))


def malformed(value: Column) -> Column:
    """True for a text that is no JSON value."""
    as_list = F.from_json(value, T.ArrayType(T.StringType()))
    as_dict = F.from_json(value, ALL_FIELDS)
    return (
        F.when(value.rlike(r"^\s*\["), as_list.isNull())
        .when(value.rlike(r"^\s*\{"), as_dict.isNull())
        .otherwise(F.get_json_object(value, "$").isNull())
    )


def records(
    payloads: DataFrame, schema: T.StructType | T.MapType, envelopes: Sequence[str] = ENVELOPES, lenient: bool = False
) -> DataFrame:
    """One row per record object, with the declared fields and ``source_order``.

    With a map type in place of a schema, each record is one column ``fields``
    that holds all its keys.

    Elements that are no objects are skipped, other payload kinds hold no
    records, and malformed text stops the job unless ``lenient``. Columns of
    ``payloads`` other than the text and its place are kept.
    """
    kept = [name for name in payloads.columns if name not in ("file", "chunk", "line", "value")]
    exploded = payloads.select(
        "file", "chunk", "line", *kept, F.posexplode(_record_list(F.col("value"), schema, envelopes, lenient))
    )
    content = F.col("col.*") if isinstance(schema, T.StructType) else F.col("col").alias("fields")
    return exploded.where(F.col("col").isNotNull()).select(
        *kept, F.struct("file", "chunk", "line", "pos").alias(SOURCE_ORDER), content
    )


def file_census(payloads: DataFrame, envelopes: Sequence[str] = ENVELOPES) -> DataFrame:
    """Records per file; files without any record are listed with 0."""
    no_field = T.StructType([T.StructField("_", T.StringType())])
    found = F.filter(_record_list(F.col("value"), no_field, envelopes, False), lambda item: item.isNotNull())
    counted = F.coalesce(F.size(found), F.lit(0)).cast("long")
    kept = [name for name in payloads.columns if name not in ("file", "chunk", "line", "value")]
    return payloads.groupBy(*kept, "file").agg(F.sum(counted).alias("n"))


def places_beyond(payloads: DataFrame, slots: int) -> DataFrame:
    """Payloads per vehicle and file that name a port of a place above ``slots``, which no table reads."""
    numbers = F.transform(
        F.regexp_extract_all("value", F.lit(r'"(?:portNumber|moduleNumber)([0-9]+)"'), F.lit(1)), lambda n: n.try_cast("int")
    )
    found = payloads.select("vehicle", "file", F.array_max(numbers).alias("highest"))
    return found.where(F.col("highest") > slots).groupBy("vehicle", "file").agg(F.count("*").alias("payloads"), F.max("highest").alias("highest"))


def require_records(found: DataFrame, source: str) -> DataFrame:
    """Stop the job where files were found but hold no record."""
    if found.isEmpty():
        raise ValueError(f"no {source} records in the files found")
    return found
