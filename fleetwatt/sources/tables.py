"""CSV, Parquet and JSON tables, read and written by vehicle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt.sources.json_records import SOURCE_ORDER

CSV_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
    # Files whose header differs from the first one are an error, not shifted columns.
    "enforceSchema": "false",
}


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV files with a header row; columns are matched by name and stay text.

    ``schema`` names the columns to read. Header names that are not in it are
    ignored, and names that are missing from the header are an error.
    """
    header = spark.read.options(**CSV_OPTIONS).csv(paths)
    missing = sorted(set(schema.names) - set(header.columns))
    if missing:
        raise KeyError(f"missing CSV columns: {missing}")
    return header.select(*[F.col(f"`{name}`") for name in schema.names])


def read_vehicle_csv(spark: SparkSession, paths: Mapping[str, str], schema: T.StructType) -> DataFrame:
    """One source of several vehicles, each with its own path."""
    tables = [
        read_csv(spark, path, schema).select(F.lit(vehicle).alias("vehicle"), "*") for vehicle, path in paths.items()
    ]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result


def laid_out(table: DataFrame, partitions: Sequence[str], order: Sequence[str], cluster: Sequence[str]) -> DataFrame:
    """Rows of a partition together, and sorted by ``cluster`` and ``order`` inside it.

    The rebalance hint lets adaptive execution split a day or vehicle that is far
    larger than the others, and merge the small ones. Only the partition columns
    are hashed: with more columns every task would write a file for every day.
    """
    together = list(partitions or cluster)
    return table.hint("rebalance", *together).sortWithinPartitions(*dict.fromkeys([*partitions, *cluster]), *order)


def in_global_order(table: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows sorted over all partitions, which are numbered in order, so that files read one after another are sorted.

    Ranges are sampled over all columns of ``order``: the rows of one hot value
    of the first are cut by the next ones.
    """
    return table.repartitionByRange(*order).sortWithinPartitions(*order)


def write_ordered(table: DataFrame, path: str, order: Sequence[str]) -> None:
    """Replace ``path`` by Parquet files that hold ``table`` in one order over all of them."""
    in_global_order(table, order).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_bucketed(table: DataFrame, path: str, name: str, by: Sequence[str], buckets: int) -> DataFrame:
    """Replace the table ``name`` at ``path`` by one in sorted buckets of ``by``, which joins on these need not shuffle."""
    rows = table.repartition(buckets, *by)
    rows.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)
    return table.sparkSession.table(name)


def _as_text(table: DataFrame) -> DataFrame:
    times = [
        field.name for field in table.schema if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType))
    ]
    return table.withColumns({name: F.col(f"`{name}`").cast("string") for name in times})


def write_csv(table: DataFrame, path: str, partitions: Sequence[str] = ("vehicle",), order: Sequence[str] = ()) -> None:
    """Replace ``path`` by CSV files with header rows, one folder per partition value, each in one ``order`` over its files."""
    rows = table.drop(SOURCE_ORDER)
    plain = _as_text(in_global_order(rows, [*partitions, *order]) if order else laid_out(rows, partitions, order, ()))
    plain.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**CSV_OPTIONS).partitionBy(
        *partitions
    ).csv(path)


def write_parquet(
    table: DataFrame,
    path: str,
    order: Sequence[str] = (),
    partitions: Sequence[str] = (),
    cluster: Sequence[str] = ("vehicle",),
    mode: str = "static",
) -> None:
    """Replace ``path``, or with mode 'dynamic' only the partitions present in ``table``.

    Folders are made by day only, whose number does not grow with the fleet. A
    vehicle is found inside a day by the row-group statistics of the sorted files.
    """
    laid_out(table, partitions, order, cluster).write.mode("overwrite").option(
        "partitionOverwriteMode", mode
    ).partitionBy(*partitions).parquet(path)


def write_json(table: DataFrame, path: str, partitions: Sequence[str] = ("vehicle",), order: Sequence[str] = ()) -> None:
    """Replace ``path`` by JSON lines, the form a chart client reads."""
    plain = _as_text(laid_out(table, partitions, order, ()))
    plain.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partitions).json(path)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table as (tbl, n)."""
    counts = [table.agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), "n") for name, table in tables.items()]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, bytes) of the files matching ``paths``; their content is not read."""
    return spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def file_counts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Files found per source as (source, n_files, bytes), from file lists."""
    counts = [
        files.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).select(
            F.lit(name).alias("source"), "n_files", "bytes"
        )
        for name, files in sources.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result
