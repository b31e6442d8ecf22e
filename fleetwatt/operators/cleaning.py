"""Cleaning of record tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt.functions.numbers import marked_missing, nan_to_null, to_number
from fleetwatt.functions.times import to_time
from fleetwatt.sources.json_records import SOURCE_ORDER


def quoted(name: str) -> Column:
    """Column by its plain name, which may hold dots or brackets."""
    return F.col(f"`{name}`")


def number_column(table: DataFrame, name: str) -> Column:
    """Column as double, NULL where it is no number; only text has to be parsed."""
    if isinstance(table.schema[name].dataType, T.NumericType):
        return nan_to_null(quoted(name).cast("double"))
    return to_number(quoted(name))


def time_column(table: DataFrame, name: str, *formats: str) -> Column:
    """Column as time, NULL where it is none; only text has to be parsed."""
    if isinstance(table.schema[name].dataType, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return quoted(name).cast("timestamp_ntz")
    return to_time(quoted(name), *formats)


def order_columns(table: DataFrame, order: Sequence[str]) -> list[Column]:
    """The columns to sort by; a struct is sorted by its fields, which is cheaper and the same order."""
    columns = []
    for name in order:
        kind = table.schema[name].dataType
        fields = kind.names if isinstance(kind, T.StructType) else None
        columns += [quoted(name)[field] for field in fields] if fields else [quoted(name)]
    return columns


def keep_last(table: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``.

    Spark cuts each input partition to one row per key before the shuffle, so a
    key with very many copies sends one row per task.
    """
    latest = Window.partitionBy(*keys).orderBy(*[column.desc() for column in order_columns(table, order)])
    return table.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def clean_time(
    table: DataFrame, time: str, order: Sequence[str] = (SOURCE_ORDER,), by: Sequence[str] = ("vehicle",)
) -> DataFrame:
    """Parse ``time``, drop rows without one and keep the last row of each time."""
    parsed = table.withColumn(time, time_column(table, time)).na.drop(subset=[time])
    return keep_last(parsed, [*by, time], order)


def to_numbers(table: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Numeric coercion of those of ``columns`` that are present."""
    present = [name for name in columns if name in table.columns]
    return table.withColumns({name: number_column(table, name) for name in present})


def rename(table: DataFrame, names: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Select ``keep`` and the columns of ``names`` under their new names."""
    return table.select(*keep, *[quoted(old).alias(new) for old, new in names.items()])


def blank_marks(table: DataFrame, columns: Iterable[str], marks: Iterable[float]) -> DataFrame:
    marks = tuple(marks)
    return table.withColumns({name: marked_missing(quoted(name), marks) for name in columns})


def require_columns(table: DataFrame, required: Iterable[str]) -> DataFrame:
    """Stop with the sorted names of the columns that ``table`` lacks."""
    missing = sorted(set(required) - set(table.columns))
    if missing:
        raise KeyError(f"missing required fields: {missing}")
    return table


def missing_fields(table: DataFrame, fields: str, required: Sequence[str]) -> DataFrame:
    """Required names that no record holds, one per row.

    ``fields`` is a map column with the fields of each record. A record table
    has the fields of all its records, so a field is missing only where every
    record lacks it.
    """
    found = table.agg(
        *[
            F.coalesce(F.bool_or(F.map_contains_key(F.col(fields), name)), F.lit(False)).alias(f"f{i}")
            for i, name in enumerate(required)
        ]
    )
    pairs = [F.struct(F.lit(name).alias("column_name"), F.col(f"f{i}").alias("found")) for i, name in enumerate(required)]
    return found.select(F.inline(F.array(*pairs))).where(~F.col("found")).select("column_name")


def require_fields(table: DataFrame, fields: str, required: Sequence[str]) -> DataFrame:
    """Stop with the sorted names of the required fields that no record holds."""
    missing = sorted(row.column_name for row in missing_fields(table, fields, required).collect())
    if missing:
        raise KeyError(f"missing required fields: {missing}")
    return table
