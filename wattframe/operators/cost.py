"""What sessions cost."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.rounding import published, ratio
from ..plans import measures as m


def _priced(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col(m.COST).isNotNull())


def cost_statistics(sessions: DataFrame) -> DataFrame:
    """Overall cost statistics in one row."""
    return _priced(sessions).agg(
        m.rows("total_sessions"),
        m.mean(m.COST, "avg_cost"),
        m.lowest(m.COST, "min_cost"),
        m.highest(m.COST, "max_cost"),
        m.total(m.COST, "total_revenue"),
        m.spread(m.COST, "cost_std_dev"),
    )


def daily_cost_trends(sessions: DataFrame) -> DataFrame:
    """Cost per day."""
    days = _priced(sessions).groupBy(cal.day_of(m.START).alias("date")).agg(
        m.rows("sessions"),
        m.total(m.COST, "total_cost"),
        m.mean(m.COST, "avg_cost_per_session"),
        m.lowest(m.COST, "min_cost"),
        m.highest(m.COST, "max_cost"),
    )
    return days.orderBy("date")


def weekly_cost_trends(sessions: DataFrame) -> DataFrame:
    """Cost per calendar year and week 0-53."""
    day = cal.day_of(m.START)
    weeks = _priced(sessions).groupBy(F.year(day).alias("year"), cal.week_in_calendar_year(day).alias("week")).agg(
        m.first_day("week_start"),
        m.rows("sessions"),
        m.total(m.COST, "total_cost"),
        m.mean(m.COST, "avg_cost_per_session"),
    )
    label = cal.week_label(F.col("year"), F.col("week")).alias("year_week")
    return weeks.orderBy("year", "week").select(label, *weeks.columns[2:])


def monthly_cost_trends(sessions: DataFrame) -> DataFrame:
    """Cost per month and per kWh, over sessions that delivered energy."""
    day = cal.day_of(m.START)
    charged = _priced(sessions).where(F.col(m.ENERGY) > 0)
    months = charged.groupBy(F.year(day).alias("year"), F.month(day).alias("number")).agg(
        m.first_day("_first"),
        m.rows("sessions"),
        m.total(m.COST, "total_cost"),
        m.mean(m.COST, "avg_cost_per_session"),
        m.total(m.ENERGY, "total_energy"),
        published(ratio(F.sum(m.COST), F.sum(m.ENERGY))).alias("cost_per_kwh"),
    )
    return months.orderBy("year", "number").select(
        cal.month_label(F.col("year"), F.col("number")).alias("month"),
        cal.month_title(F.col("_first")).alias("month_name"),
        *months.columns[3:],
    )


def cost_trends_by_time_of_day(sessions: DataFrame) -> DataFrame:
    """Average cost per day and time of day, labels in alphabetical order."""
    labelled = _priced(sessions).where(F.col("time_of_day").isNotNull())
    return (
        labelled.groupBy(cal.day_of(m.START).alias("date"), "time_of_day")
        .agg(m.rows("sessions"), m.mean(m.COST, "avg_cost"))
        .orderBy("date", "time_of_day")
    )
