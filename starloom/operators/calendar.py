"""The calendar dimension: bounds from the data, one row per day, attributes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import date_key

# The calendar always covers these years and this many to come.
FIRST_YEAR = 2013
LAST_YEAR = 2052
YEARS_AHEAD = 5


def date_range(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Smallest and largest date over several columns of one table, NULLs ignored."""
    low = F.least(*(F.min(c) for c in columns)) if len(columns) > 1 else F.min(columns[0])
    high = F.greatest(*(F.max(c) for c in columns)) if len(columns) > 1 else F.max(columns[0])
    return df.agg(F.lit(table).alias("table_name"), low.alias("first_date"), high.alias("last_date"))


def calendar_bounds(ranges: Sequence[DataFrame], this_year: int) -> DataFrame:
    """One row: Jan 1 and Dec 31 of the years the calendar must cover.

    From the earlier of 2013 and the data's first year, to the latest of the
    data's last year, five years from ``this_year``, and 2052.
    """
    seen = reduce(DataFrame.unionByName, ranges)
    first = F.least(F.lit(FIRST_YEAR), F.year(F.min("first_date")))
    last = F.greatest(
        F.lit(LAST_YEAR), F.lit(this_year + YEARS_AHEAD), F.year(F.max("last_date"))
    )
    return seen.agg(
        F.make_date(first, F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date(last, F.lit(12), F.lit(31)).alias("end_date"),
    )


def calendar_days(bounds: DataFrame) -> DataFrame:
    """Every day between the bounds; at most one row per representable date."""
    step = F.expr("interval 1 day")
    return bounds.select(F.explode(F.sequence("start_date", "end_date", step)).alias("full_date"))


def with_calendar_attributes(days: DataFrame) -> DataFrame:
    """Attributes of each day. The week is the ISO week, the year the calendar year."""
    day = F.col("full_date")
    monday_first = F.weekday(day) + 1
    return days.select(
        "full_date",
        date_key(day).alias("date_key"),
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.month(day).alias("calendar_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        monday_first.cast("int").alias("day_of_week_sort"),
        (monday_first > 5).alias("is_weekend"),
    )


def date_dimension(ranges: Sequence[DataFrame], this_year: int) -> DataFrame:
    return with_calendar_attributes(calendar_days(calendar_bounds(ranges, this_year)))
