"""Row order for readers; no operator relies on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def first_rows(table: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in the given order; each task keeps only its own first ``n``."""
    return table.orderBy(*order).limit(n)
