"""Time expressions: epoch seconds, service times past 24 h, local clock."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp; no session zone involved."""
    return F.floor((_c(ts) - _epoch()).cast("decimal(20,6)")).cast("bigint")


def plus_seconds(ts, secs) -> Column:
    return _c(ts) + F.make_dt_interval(secs=_c(secs).cast("decimal(18,6)"))


def whole_second(ts) -> Column:
    """A zone-less timestamp without its fraction of a second."""
    return plus_seconds(_epoch(), epoch_seconds(ts))


def seconds_between(later, earlier) -> Column:
    """``later - earlier`` in whole seconds; NULL when either is NULL."""
    return (_c(later) - _c(earlier)).cast("bigint")


def parse_service_time(text) -> Column:
    """``HH:MM:SS`` with HH >= 24 allowed -> seconds; malformed text -> NULL."""
    t = _c(text)
    part = [F.split_part(t, F.lit(":"), F.lit(i)).try_cast("int") for i in (1, 2, 3)]
    return F.when(t.rlike(r"^\d{1,3}:\d{1,2}:\d{1,2}$"), part[0] * 3600 + part[1] * 60 + part[2])


def format_seconds(secs) -> Column:
    """Seconds -> signed ``HH:MM:SS``."""
    s = _c(secs).cast("bigint")
    a = F.abs(s)

    def two(x: Column) -> Column:
        text = x.cast("bigint").cast("string")
        return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)

    body = F.concat_ws(":", two(F.floor(a / 3600)), two(F.floor((a % 3600) / 60)), two(a % 60))
    return F.when(s.isNotNull(), F.concat(F.when(s < 0, "-").otherwise(""), body))


def local_time(epoch, zone: str = "Europe/Zurich") -> Column:
    """Epoch seconds -> wall clock of ``zone`` as a zone-less timestamp (DST aware)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), plus_seconds(_epoch(), epoch))


def iso_weekday(day) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(_c(day)) + 1


def cyclic(value, period: float) -> tuple[Column, Column]:
    """(sin, cos) of a value on a circle of length ``period``."""
    angle = _c(value) * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)
