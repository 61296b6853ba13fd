"""Small helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r(col, digits: int = 6) -> Column:
    """Round for comparison: aggregates may differ in the last bits between runs."""
    return F.round(F.col(col) if isinstance(col, str) else col, digits)


def bigint(col) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("bigint")
