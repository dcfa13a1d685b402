from datetime import date

from starloom.operators.calendar import (
    calendar_bounds,
    calendar_days,
    date_dimension,
    date_range,
    with_calendar_attributes,
)


def spans(spark, *days):
    df = spark.createDataFrame([(d, None) for d in days], "a date, b date")
    return [date_range(df, ["a", "b"], "t")]


def test_bounds_cover_fixed_years_and_data(spark):
    inside = calendar_bounds(spans(spark, date(2020, 5, 5)), 2024).first()
    assert (inside.start_date, inside.end_date) == (date(2013, 1, 1), date(2052, 12, 31))
    outside = calendar_bounds(spans(spark, date(1995, 5, 5), date(2060, 1, 1)), 2024).first()
    assert (outside.start_date, outside.end_date) == (date(1995, 1, 1), date(2060, 12, 31))
    later = calendar_bounds(spans(spark, date(2020, 5, 5)), 2050).first()
    assert later.end_date == date(2055, 12, 31)


def test_bounds_without_any_date(spark):
    empty = spark.createDataFrame([], "a date")
    found = calendar_bounds([date_range(empty, ["a"], "t")], 2024).first()
    assert (found.start_date, found.end_date) == (date(2013, 1, 1), date(2052, 12, 31))


def test_one_row_per_day(spark):
    days = calendar_days(calendar_bounds(spans(spark, date(2020, 5, 5)), 2024))
    assert days.count() == days.distinct().count() == 14610


def test_attributes(spark):
    days = spark.createDataFrame(
        [(date(2021, 1, 3),), (date(2024, 1, 1),), (date(2024, 1, 7),)], "full_date date"
    )
    sunday, monday, next_sunday = with_calendar_attributes(days).orderBy("full_date").collect()
    assert (sunday.calendar_year, sunday.week_of_year) == (2021, 53)
    assert (monday.day_of_week, monday.day_of_week_sort, monday.is_weekend) == ("Monday", 1, False)
    assert (next_sunday.day_of_week_sort, next_sunday.is_weekend) == (7, True)
    assert (monday.date_key, monday.month_name, monday.calendar_quarter) == (20240101, "January", 1)


def test_dimension_has_unique_keys(spark):
    dim = date_dimension(spans(spark, date(2020, 5, 5)), 2024)
    assert dim.select("date_key").distinct().count() == dim.count()
