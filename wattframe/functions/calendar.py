"""Calendar columns. Weeks start on Monday; week 1 holds at least four days of its year."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(moment: str) -> Column:
    return F.to_date(F.col(moment))


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)


def week_in_calendar_year(day: Column) -> Column:
    """Week number 0-53 that never leaves the calendar year.

    Days of January that belong to last year's final week are week 0; days of
    December that belong to next year's first week are week 53.
    """
    return (
        F.when(iso_year(day) < F.year(day), F.lit(0))
        .when(iso_year(day) > F.year(day), F.lit(53))
        .otherwise(F.weekofyear(day))
    )


def iso_year_week(day: Column) -> Column:
    """ISO year and week as one number: 2024-12-30 gives 202501."""
    return iso_year(day) * 100 + F.weekofyear(day)


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def week_label(year: Column, week: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-W"), two_digits(week))


def month_label(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), two_digits(month))


def month_title(day: Column) -> Column:
    return F.date_format(day, "MMMM yyyy")
