"""How sessions spread over the day and the week."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.bands import position_in
from ..plans import measures as m
from ..plans.shares import share_of_labels


def time_of_day_distribution(sessions: DataFrame) -> DataFrame:
    """Share, cost, energy and duration per time of day; sessions without one are left out."""
    times = sessions.where(F.col("time_of_day").isNotNull()).groupBy("time_of_day").agg(
        m.rows("session_count"),
        m.mean(m.COST, "avg_cost"),
        m.mean(m.ENERGY, "avg_energy"),
        m.mean(m.HOURS, "avg_duration_hours"),
    )
    shares = share_of_labels(times, "session_count")
    return shares.select(
        "time_of_day", "session_count", "percentage", "avg_cost", "avg_energy", "avg_duration_hours"
    ).orderBy(position_in(F.col("time_of_day"), fixed.TIMES_OF_DAY), "time_of_day")


def day_of_week_distribution(sessions: DataFrame) -> DataFrame:
    """Share, cost and energy per weekday; sessions without one are left out."""
    days = sessions.where(F.col("day_of_week").isNotNull()).groupBy("day_of_week").agg(
        m.rows("session_count"), m.mean(m.COST, "avg_cost"), m.mean(m.ENERGY, "avg_energy")
    )
    shares = share_of_labels(days, "session_count")
    return shares.select("day_of_week", "session_count", "percentage", "avg_cost", "avg_energy").orderBy(
        position_in(F.col("day_of_week"), fixed.DAYS_OF_WEEK), "day_of_week"
    )


def weekend_vs_weekday(sessions: DataFrame) -> DataFrame:
    """Weekend against weekdays. Any label that is no weekend day counts as weekday."""
    is_weekend = F.col("day_of_week").isin(fixed.WEEKEND_DAYS)
    period = F.when(is_weekend, F.lit(fixed.WEEKEND)).otherwise(F.lit(fixed.WEEKDAY))
    known = sessions.where(F.col("day_of_week").isNotNull())
    return known.groupBy(period.alias("period_type")).agg(
        m.rows("session_count"),
        m.mean(m.COST, "avg_cost"),
        m.mean(m.ENERGY, "avg_energy"),
        m.mean(m.HOURS, "avg_duration"),
    )
