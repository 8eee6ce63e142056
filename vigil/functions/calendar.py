"""Calendar attributes of a date column (the dim_date columns) and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """yyyyMMdd as an integer (20260719)."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def text_key(c: Column) -> Column:
    """md5 hex of a text key (null stays null)."""
    return F.md5(c)


def calendar_columns(d: Column, pad_names: bool = False) -> list[Column]:
    """A4 attributes.  day_of_week is 0 = Sunday .. 6 = Saturday (N14);
    week_of_year is ISO (N15).  Names are unpadded unless `pad_names`, which
    blank-pads to 9 characters like the database's 'Day' / 'Month' formats."""
    day_name = F.date_format(d, "EEEE")
    month_name = F.date_format(d, "MMMM")
    if pad_names:
        day_name, month_name = F.rpad(day_name, 9, " "), F.rpad(month_name, 9, " ")
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        day_name.alias("day_name"),
        month_name.alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    ]
