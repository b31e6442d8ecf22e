"""Port records: wide to long, and port labels."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatt.functions.labels import component_name
from fleetwatt.operators.cleaning import quoted
from fleetwatt.schemas import PORT_KEYS, PORT_SENSORS


def base_columns(columns: Sequence[str], prefixes: Sequence[str]) -> list[str]:
    """Columns that are no numbered port fields."""
    field = re.compile(f"({'|'.join(map(re.escape, prefixes))})[0-9]+")
    return [name for name in columns if name != "recordData" and not field.fullmatch(name)]


# Texts of the JSON values that mean "no port": zero in its forms, empty and false.
NO_PORT = ("0", "0.0", "-0.0", "", "false")


def used_places(wide: DataFrame, fields: Sequence[str], slots: int) -> DataFrame:
    """The columns that are no port fields, and ``_places``, the places of each wide record, NULL where unused.

    Port field f of place i is column ``f{i}``, NULL where absent. A place is
    unused where both its port and its module number are 0 or missing.
    """
    numbered = [*PORT_KEYS, *fields]
    base = base_columns(wide.columns, numbered)
    present = set(wide.columns)
    nothing = ", ".join(f"'{text}'" for text in NO_PORT)

    # One SQL text, since hundreds of column objects take longer to make than the query to plan. Plain conditions
    # are compiled; a filter with a lambda would have Spark interpret the whole array.
    def place(i: int) -> str:
        values = [f"`{f}{i}`" if f"{f}{i}" in present else "cast(null as string)" for f in numbered]
        pairs = [f"'{field}', {value}" for field, value in zip(numbered, values)]
        used = " or ".join(f"coalesce(cast({key} as string) not in ({nothing}), false)" for key in values[: len(PORT_KEYS)])
        return f"if({used}, named_struct('place', {i}, {', '.join(pairs)}), null)"

    places = F.expr(f"array({', '.join(place(i) for i in range(1, slots + 1))})")
    return wide.select(*[quoted(name) for name in base], places.alias("_places"))


def port_rows(narrow: DataFrame) -> DataFrame:
    """One row per place in use of ``used_places``."""
    base = [quoted(name) for name in narrow.columns if name != "_places"]
    # Outer, since Spark would otherwise test every record for places beforehand, and make the array twice.
    places = narrow.select(*base, F.explode_outer("_places").alias("_p")).where("_p is not null")
    return places.select(*base, "_p.*")


def unpivot_ports(wide: DataFrame, fields: Sequence[str], slots: int) -> DataFrame:
    """One row per port in use of each wide record; see ``used_places``."""
    return port_rows(used_places(wide, fields, slots))


def sensor_table(spark: SparkSession, rows: Sequence[tuple[int, int, str]] = PORT_SENSORS) -> DataFrame:
    """The fixed port names, a handful of rows made in the code and so safe to broadcast."""
    return F.broadcast(spark.createDataFrame(list(rows), "slot int, port int, sensor string"))


def label_ports(ports: DataFrame, sensors: DataFrame, keys: Sequence[str] = ("slot", "port")) -> DataFrame:
    """Add the sensor of each port; ports that are not in ``sensors`` get NULL.

    With ``sensor_table`` as ``sensors`` the ports are not shuffled.
    """
    return ports.join(sensors, list(keys), "left")


def with_component(ports: DataFrame) -> DataFrame:
    return ports.withColumn("component", component_name(F.col("sensor"), F.col("domain"), F.col("slot"), F.col("port")))
