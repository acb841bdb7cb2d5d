"""Reports from the stored summary of days. Each gives what the report of the same name gives from all sessions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.rounding import deviation_of_parts, mean_of_parts, published, ratio
from ..plans import measures as m
from ..sources.day_summary import merged, summed


def _total(column: str, name: str) -> Column:
    return published(F.col(column)).alias(name)


def _mean(total: str, count: str, scale: int, name: str) -> Column:
    return published(mean_of_parts(F.col(total), F.col(count), scale)).alias(name)


def _volume() -> list[Column]:
    return [
        F.col("n").alias("total_sessions"),
        _total("energy_sum", "total_energy_kwh"),
        _mean("energy_sum", "energy_n", 2, "avg_energy_kwh"),
        _total("cost_sum", "total_revenue"),
        _mean("cost_sum", "cost_n", 2, "avg_cost"),
        _mean("hours_sum", "hours_n", 3, "avg_duration_hours"),
        F.col("unique_users"),
    ]


def _whole(summary: DataFrame, measure: str, scale: int, *names: str) -> DataFrame:
    """One row over all days: number of values, mean, extremes, total and deviation under the given names, and the exact mean."""
    n, total = F.coalesce(f"{measure}_n", F.lit(0)), F.col(f"{measure}_sum")
    mean = mean_of_parts(total, n, scale)
    found = n, published(mean), *(published(F.col(f"{measure}_{end}")) for end in ("min", "max")), published(total)
    deviation = deviation_of_parts(total, F.col(f"{measure}_squares"), n, scale)
    values = (value.alias(name) for value, name in zip((*found, deviation), names, strict=True))
    return summed(summary).select(*values, mean.alias("_mean"))


def total_energy_delivered(summary: DataFrame) -> DataFrame:
    names = "total_sessions", "avg_energy_per_session", "min_energy_kwh", "max_energy_kwh", "total_energy_delivered_kwh"
    found = _whole(summary, "energy", 2, *names, "energy_std_dev")
    return found.select("total_sessions", "total_energy_delivered_kwh", *names[1:4], "energy_std_dev")


def duration_statistics(summary: DataFrame) -> DataFrame:
    names = "total_sessions", "avg_duration_hours", "min_duration_hours", "max_duration_hours"
    found = _whole(summary, "hours", 3, *names, "_total", "duration_std_dev")
    return found.select(*names, "duration_std_dev", published(F.col("_mean") * 60).alias("avg_duration_minutes"))


def cost_statistics(summary: DataFrame) -> DataFrame:
    names = "total_sessions", "avg_cost", "min_cost", "max_cost", "total_revenue", "cost_std_dev"
    return _whole(summary, "cost", 2, *names).select(*names)


def _span(first: str, last: str) -> list[Column]:
    return [F.col("first_day").alias(first), F.col("last_day").alias(last)]


def _day() -> Column:
    return F.col("date")


def daily_trends(summary: DataFrame) -> DataFrame:
    return merged(summary, day=_day()).select(F.col("day").alias("date"), *_volume(), "stations_used").orderBy("date")


def weekly_trends(summary: DataFrame) -> DataFrame:
    weeks = merged(summary, year=F.year(_day()), week_number=cal.week_in_calendar_year(_day()))
    label = cal.week_label(F.col("year"), F.col("week_number")).alias("year_week")
    return weeks.select("year", "week_number", label, *_span("week_start", "week_end"), *_volume()).orderBy("year", "week_number")


def weekly_trends_iso(summary: DataFrame) -> DataFrame:
    return merged(summary, yearweek=cal.iso_year_week(_day())).select("yearweek", *_span("week_start", "week_end"), *_volume()).orderBy("yearweek")


def monthly_trends(summary: DataFrame) -> DataFrame:
    months = merged(summary, year=F.year(_day()), month_number=F.month(_day()))
    label = cal.month_label(F.col("year"), F.col("month_number")).alias("month")
    title = cal.month_title(F.col("first_day")).alias("month_name")
    named = months.select(label, "year", "month_number", title, *_volume(), "stations_used")
    return named.orderBy("year", "month_number")


def monthly_trends_span(summary: DataFrame) -> DataFrame:
    months = merged(summary, month=F.date_format(_day(), "yyyy-MM"))
    return months.select("month", *_span("month_start", "month_end"), *_volume(), "stations_used").orderBy("month")


def daily_cost_trends(summary: DataFrame) -> DataFrame:
    days = summed(summary, day=_day()).where("cost_n > 0").select(
        F.col("day").alias("date"),
        F.col("cost_n").alias("sessions"),
        _total("cost_sum", "total_cost"),
        _mean("cost_sum", "cost_n", 2, "avg_cost_per_session"),
        _total("cost_min", "min_cost"),
        _total("cost_max", "max_cost"),
    )
    return days.orderBy("date")


def weekly_cost_trends(summary: DataFrame) -> DataFrame:
    weeks = summed(summary, year=F.year(_day()), week=cal.week_in_calendar_year(_day())).where("cost_n > 0")
    return weeks.orderBy("year", "week").select(
        cal.week_label(F.col("year"), F.col("week")).alias("year_week"),
        F.col("first_priced").alias("week_start"),
        F.col("cost_n").alias("sessions"),
        _total("cost_sum", "total_cost"),
        _mean("cost_sum", "cost_n", 2, "avg_cost_per_session"),
    )


def monthly_cost_trends(summary: DataFrame) -> DataFrame:
    months = summed(summary, year=F.year(_day()), number=F.month(_day())).where("charged_cost_n > 0")
    return months.orderBy("year", "number").select(
        cal.month_label(F.col("year"), F.col("number")).alias("month"),
        cal.month_title(F.col("first_charged")).alias("month_name"),
        F.col("charged_cost_n").alias("sessions"),
        _total("charged_cost", "total_cost"),
        _mean("charged_cost", "charged_cost_n", 2, "avg_cost_per_session"),
        _total("charged_energy", "total_energy"),
        published(ratio(F.col("charged_cost"), F.col("charged_energy"))).alias("cost_per_kwh"),
    )


def daily_energy_delivered(summary: DataFrame) -> DataFrame:
    days = summed(summary, day=_day()).where("timed_energy_n > 0").select(
        F.col("day").alias("date"),
        F.col("timed_energy_n").alias("sessions"),
        _total("timed_energy", "total_energy_kwh"),
        _mean("timed_energy", "timed_energy_n", 2, "avg_energy_kwh"),
        published(ratio(F.col("timed_energy"), F.col("timed_hours"))).alias("avg_power_kw"),
    )
    return days.orderBy("date")


def daily_overview(summary: DataFrame, days: int) -> DataFrame:
    newest = summed(summary, day=_day()).select(
        F.col("day").alias("date"),
        F.col("n").alias("sessions"),
        _total("energy_sum", "energy"),
        _mean("cost_sum", "cost_n", 2, "avg_cost"),
    )
    return newest.orderBy(F.desc("date")).limit(days)


REPORTS = (
    daily_trends,
    weekly_trends,
    weekly_trends_iso,
    monthly_trends,
    monthly_trends_span,
    daily_cost_trends,
    weekly_cost_trends,
    monthly_cost_trends,
    daily_energy_delivered,
    total_energy_delivered,
    duration_statistics,
    cost_statistics,
)
__all__ = ["REPORTS", "daily_overview", *(report.__name__ for report in REPORTS)]
