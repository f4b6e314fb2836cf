"""Calendar fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c) -> Column:
    """Timestamp parse that yields NULL for bad input (B2)."""
    return F.try_to_timestamp(_c(c).cast("string"))


def hour(c) -> Column:
    return F.hour(_c(c))


def day_of_week(c) -> Column:
    """Integer day of week, Monday = 0."""
    return F.weekday(_c(c))


def day_name(c) -> Column:
    """English day name, e.g. Monday."""
    return F.date_format(_c(c), "EEEE")


def month(c) -> Column:
    return F.month(_c(c))


def year(c) -> Column:
    return F.year(_c(c))


def quarter_label(c) -> Column:
    """Quarter period label such as 2023Q1."""
    c = _c(c)
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))
