"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.values import date_key


def calendar_columns(day: Column) -> list[Column]:
    iso_weekday = F.weekday(day) + 1
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.dayname(day).alias("day_name"),
        iso_weekday.alias("day_of_week"),
        F.weekofyear(day).alias("week_number"),
        F.month(day).alias("month_number"),
        F.monthname(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        iso_weekday.isin(6, 7).alias("is_weekend"),
    ]
