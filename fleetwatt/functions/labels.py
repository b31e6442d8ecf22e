"""Component and vehicle labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# White space characters; trim without a list removes blanks only.
SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2028\u2029\u3000"


def strip(column: Column) -> Column:
    """Remove white space of any kind at both ends; NULL becomes ''."""
    return F.btrim(F.coalesce(column.cast("string"), F.lit("")), F.lit(SPACE))


def port_name(domain: Column, slot: Column, port: Column) -> Column:
    parts = [F.coalesce(part.cast("string"), F.lit("")) for part in (domain, slot, port)]
    return F.concat(F.lit("D"), parts[0], F.lit("-S"), parts[1], F.lit("-P"), parts[2])


def component_name(sensor: Column, domain: Column, slot: Column, port: Column) -> Column:
    """The sensor name, or ``D{domain}-S{slot}-P{port}`` where it is blank."""
    name = strip(sensor)
    return F.when(name == "", port_name(domain, slot, port)).otherwise(name)


def vehicle_label(label: Column, vehicle: Column) -> Column:
    return F.coalesce(label, F.upper(vehicle))
