"""Year to date and same period last year over period aggregates.

Both work on rows already aggregated by period, at most one per group and
period, with any of the columns ``calendar_year``, ``calendar_quarter``,
``calendar_month`` and ``full_date``; the finest of them is the grain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

YEAR, QUARTER, MONTH, DAY = "calendar_year", "calendar_quarter", "calendar_month", "full_date"
MONTH_NAME = "month_name"
_LAST_IN_YEAR = {MONTH: 12, QUARTER: 4}


def month_name(month: str) -> Column:
    """The calendar's name of a month's number."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM")


def finest(columns: Sequence[str]) -> str:
    unknown = set(columns) - {YEAR, QUARTER, MONTH, DAY}
    if unknown:
        raise ValueError(f"not a period: {', '.join(sorted(unknown))}")
    grain = next((name for name in (DAY, MONTH, QUARTER, YEAR) if name in columns), None)
    if grain is None or (grain != DAY and YEAR not in columns):
        raise ValueError("a shifted measure needs the calendar year or the date")
    return grain


def _aligned(columns: Sequence[str], grain: str) -> dict[str, Column]:
    """The coarser period columns that follow from the grain column."""
    if grain == DAY:
        parts = {YEAR: F.year(DAY), QUARTER: F.quarter(DAY), MONTH: F.month(DAY)}
    elif grain == MONTH:
        parts = {QUARTER: F.ceil(F.col(MONTH) / 3).cast("int")}
    else:
        parts = {}
    return {name: value for name, value in parts.items() if name in columns}


def year_to_date(
    frame: DataFrame, columns: Sequence[str], others: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Running sums from January 1, in every period from a year's first value to its end.

    Periods without rows of their own repeat the sum so far; periods before the
    first value of the year stay blank and have no row. Gaps are filled from
    each row to the next, so no calendar is crossed with the groups, and a
    window never holds more than one year of one group.
    """
    grain = finest(columns)
    dated = frame.where(F.col(grain).isNotNull())
    if grain == YEAR:
        return dated
    year = F.year(DAY) if grain == DAY else F.col(YEAR)
    in_year = Window.partitionBy(*others, year).orderBy(grain)
    so_far = in_year.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.lead(grain).over(in_year)
    if grain == DAY:
        last = F.coalesce(F.date_sub(following, 1), F.make_date(year, F.lit(12), F.lit(31)))
    else:
        last = F.coalesce(following - 1, F.lit(_LAST_IN_YEAR[grain]))
    running = {name: F.sum(name).over(so_far) for name in values}
    return (
        dated.withColumns({**running, "last_period": last})
        .withColumn(grain, F.explode(F.sequence(grain, "last_period")))
        .drop("last_period")
        .withColumns(_aligned(columns, grain))
    )


def same_period_last_year(
    frame: DataFrame, columns: Sequence[str], calendar: DataFrame
) -> DataFrame:
    """Values moved to the period twelve months later, as far as the calendar goes.

    Whole periods move by a year, so February takes a leap day along. Single
    days look twelve months back: Feb 28 and Feb 29 both see Feb 28.
    """
    grain = finest(columns)
    if grain == DAY:
        days = calendar.select(
            F.col(DAY).alias("seen_from"), F.add_months(DAY, -12).alias("seen_day")
        )
        moved = frame.join(days, F.col(DAY) == F.col("seen_day"))
        return moved.withColumns({DAY: F.col("seen_from"), **_aligned(columns, grain)}).drop(
            "seen_from", "seen_day"
        )
    years = calendar.select(F.col(YEAR).alias("known_year")).distinct()
    moved = frame.withColumn(YEAR, F.col(YEAR) + 1)
    return moved.join(years, F.col(YEAR) == F.col("known_year"), "left_semi")
