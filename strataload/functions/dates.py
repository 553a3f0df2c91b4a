"""Date expressions and the fixed boundary dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The dates of the unknown member and the open end of a version.
LOW_DATE = dt.date(1900, 1, 1)
HIGH_DATE = dt.date(9999, 12, 31)


def date_key(day: Column) -> Column:
    """20240131 as a long."""
    return F.date_format(day, "yyyyMMdd").cast("long")


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + F.lit(1)


def calendar_columns(day: Column) -> list[Column]:
    """All columns of the day dimension for one date."""
    weekday = iso_weekday(day)
    return [
        date_key(day).alias("date_surr_id"),
        day.alias("date"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.when(weekday >= 6, F.lit(1)).otherwise(F.lit(0)).alias("is_weekend"),
    ]
