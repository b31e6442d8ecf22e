"""Dashboard tables from the power tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from fleetwatt.operators.components import component_colours, trace_spans
from fleetwatt.operators.days import day_summary, days, default_day, with_titles
from fleetwatt.operators.fleet import with_label
from fleetwatt.operators.series import series_table


@dataclass
class Dashboard:
    components: DataFrame  # vehicle, sampleHour, component, power_W
    flows: DataFrame  # vehicle, sampleHour, total_usage_W, solar_gain_W, total_battery_power_W
    summary: DataFrame  # one row per vehicle and day, with titles
    days: DataFrame
    default_day: DataFrame
    colours: DataFrame
    traces: DataFrame
    series: DataFrame


def day_tables(
    components: DataFrame,
    flows: DataFrame,
    battery: DataFrame,
    availability: DataFrame,
    labels: DataFrame,
    as_of: dt.date | None = None,
) -> Dashboard:
    day_list = days(flows)
    colours = component_colours(components)
    return Dashboard(
        components=components,
        flows=flows,
        summary=with_titles(with_label(day_summary(flows, battery), labels)),
        days=day_list,
        default_day=default_day(flows, as_of),
        colours=colours,
        traces=trace_spans(day_list, colours),
        series=series_table(components, flows, battery, availability),
    )
