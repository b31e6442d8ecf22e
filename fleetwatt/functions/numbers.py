"""Numeric coercion, unit conversion and sums."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark also casts '1d', '1f' and hexadecimal text, which are no numbers in the inputs.
# Groups hold nothing and runs are taken whole, so that matching never goes back.
NUMBER = r"^\s*+[+-]?+(?:(?:[0-9]++[.]?+[0-9]*+|[.][0-9]++)(?:[eE][+-]?+[0-9]++)?+|(?i:inf(?:inity)?+))\s*+$"


def to_number(column: Column) -> Column:
    """Double value of a text; anything else, NaN included, gives NULL."""
    text = column.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_integer(column: Column) -> Column:
    """Whole-number part of a text number, NULL where there is none."""
    return F.coalesce(column.try_cast("int"), to_number(column).try_cast("int"))


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def marked_missing(column: Column, marks: Iterable[float]) -> Column:
    """NULL where the value is one of the producer's missing-value marks."""
    return F.when(~column.isin(*marks), column)


def milli_to_unit(column: Column) -> Column:
    return column / F.lit(1000.0)


def scaled(column: Column, factor: float) -> Column:
    return column * F.lit(factor)


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def total(column: Column, scale: int | None = None) -> Column:
    """Sum of a measure.

    With ``scale`` the values are added as decimals with that many places, so
    that the sum does not depend on the order in which tasks deliver rows.
    """
    if scale is None:
        return F.sum(column)
    return F.sum(column.cast(f"decimal(18,{scale})")).cast("double")


def one_decimal(column: Column, plus: bool = False) -> Column:
    """Text of a number with one decimal, rounded half to even on the exact value of the double.

    Ten times a double is the sum of its double and eightfold, both exact. What
    their sum loses is found without error, so a value just below a half is told
    from a half: 2.25 gives 2.2, 0.15 (which is a little less) 0.1, 0.35 0.3.
    ``plus`` puts a sign before values that have none. From 10^17 on the digits are
    the shortest that name the double.
    """
    size = F.abs(column)
    eight, two = size * 8, size * 2
    ten = eight + two
    part = ten - eight
    lost = (eight - (ten - part)) + (two - part)
    whole = F.floor(ten)
    rest = ten - whole
    even = F.pmod(whole, F.lit(2)) == 0
    up = (rest > 0.5) | ((rest == 0.5) & ((lost > 0) | ((lost == 0) & ~even)))
    tenths = whole + F.when(rest == 0, F.rint(lost).cast("long")).when(up, 1).otherwise(0)
    minus = column.cast("string").startswith("-")
    sign = F.when(minus, "-").otherwise("+" if plus else "")
    digits = F.lpad(tenths.cast("string"), F.greatest(F.length(tenths.cast("string")), F.lit(2)), F.lit("0"))
    digits = F.regexp_replace(F.concat(sign, digits), "([0-9])$", ".$1")
    named = F.when(F.isnan(column), "+nan" if plus else "nan").when(size == float("inf"), F.concat(sign, F.lit("inf")))
    # Ten times such a value is no long.
    large = F.format_string("%+.1f" if plus else "%.1f", column)
    return F.when(column.isNull(), None).when(F.isnan(column) | (size == float("inf")), named).when(size >= 1e17, large).otherwise(digits)
