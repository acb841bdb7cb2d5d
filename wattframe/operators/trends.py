"""Sessions over time: days, weeks, months and hours."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import calendar as cal
from ..functions.rounding import count_as_decimal, published
from ..plans import measures as m


def _volume() -> list[Column]:
    return [
        m.rows("total_sessions"),
        m.total(m.ENERGY, "total_energy_kwh"),
        m.mean(m.ENERGY, "avg_energy_kwh"),
        m.total(m.COST, "total_revenue"),
        m.mean(m.COST, "avg_cost"),
        m.mean(m.HOURS, "avg_duration_hours"),
        m.distinct(m.USER, "unique_users"),
    ]


def _stations_used() -> Column:
    return m.distinct(m.STATION, "stations_used")


def daily_trends(sessions: DataFrame) -> DataFrame:
    """Volume, money, users and stations per calendar day."""
    by_day = sessions.groupBy(cal.day_of(m.START).alias("date"))
    return by_day.agg(*_volume(), _stations_used()).orderBy("date")


def weekly_trends(sessions: DataFrame) -> DataFrame:
    """Volume per calendar year and week 0-53.

    Week start and end are the first and last day that has sessions.
    """
    day = cal.day_of(m.START)
    by_week = sessions.groupBy(F.year(day).alias("year"), cal.week_in_calendar_year(day).alias("week_number"))
    weeks = by_week.agg(m.first_day("week_start"), m.last_day("week_end"), *_volume())
    label = cal.week_label(F.col("year"), F.col("week_number")).alias("year_week")
    first, rest = ["year", "week_number"], weeks.columns[2:]
    return weeks.select(*first, label, *rest).orderBy("year", "week_number")


def weekly_trends_iso(sessions: DataFrame) -> DataFrame:
    """Volume per ISO week, written as one number such as 202501."""
    by_week = sessions.groupBy(cal.iso_year_week(cal.day_of(m.START)).alias("yearweek"))
    return by_week.agg(m.first_day("week_start"), m.last_day("week_end"), *_volume()).orderBy("yearweek")


def monthly_trends(sessions: DataFrame) -> DataFrame:
    """Volume per month with the month's name."""
    day = cal.day_of(m.START)
    by_month = sessions.groupBy(F.year(day).alias("year"), F.month(day).alias("month_number"))
    months = by_month.agg(m.first_day("_first"), *_volume(), _stations_used())
    return months.select(
        cal.month_label(F.col("year"), F.col("month_number")).alias("month"),
        "year",
        "month_number",
        cal.month_title(F.col("_first")).alias("month_name"),
        *months.columns[3:],
    ).orderBy("year", "month_number")


def monthly_trends_span(sessions: DataFrame) -> DataFrame:
    """Volume per month with the first and last day that has sessions."""
    by_month = sessions.groupBy(F.date_format(cal.day_of(m.START), "yyyy-MM").alias("month"))
    months = by_month.agg(m.first_day("month_start"), m.last_day("month_end"), *_volume(), _stations_used())
    return months.orderBy("month")


def trend_comparison(sessions: DataFrame) -> DataFrame:
    """Average day, week and month side by side.

    Counts and sums of days add up to those of weeks and months, so sessions
    are read and shuffled once; each day then stands for itself, its week and
    its month.
    """
    days = sessions.groupBy(cal.day_of(m.START).alias("day")).agg(
        m.rows("n"), F.sum(m.ENERGY).alias("energy"), F.sum(m.COST).alias("cost")
    )
    day = F.col("day")
    periods = [
        (fixed.DAILY_AVERAGE, F.date_format(day, "yyyy-MM-dd")),
        (fixed.WEEKLY_AVERAGE, cal.week_label(F.year(day), cal.week_in_calendar_year(day))),
        (fixed.MONTHLY_AVERAGE, F.date_format(day, "yyyy-MM")),
    ]
    memberships = F.array(
        *[
            F.struct(F.lit(place).alias("place"), F.lit(kind).alias("period_type"), key.alias("period"))
            for place, (kind, key) in enumerate(periods)
        ]
    )
    totals = (
        days.select("n", "energy", "cost", F.explode(memberships).alias("of"))
        .groupBy("of.place", "of.period_type", "of.period")
        .agg(F.sum("n").alias("n"), F.sum("energy").alias("energy"), F.sum("cost").alias("cost"))
    )
    averages = totals.groupBy("place", "period_type").agg(
        published(F.avg(count_as_decimal(F.col("n")))).alias("avg_sessions"),
        published(F.avg("energy")).alias("avg_energy_kwh"),
        published(F.avg("cost")).alias("avg_revenue"),
    )
    return averages.orderBy("place").drop("place")


def hourly_distribution(sessions: DataFrame, wide: bool = False) -> DataFrame:
    """Sessions and cost per hour of day; ``wide`` adds energy and duration."""
    aggregates = [m.rows("session_count"), m.mean(m.COST, "avg_cost")]
    if wide:
        aggregates += [m.mean(m.ENERGY, "avg_energy"), m.mean(m.HOURS, "avg_duration")]
    return sessions.groupBy(F.hour(m.START).alias("hour")).agg(*aggregates).orderBy("hour")
