"""Usage per user."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import calendar as cal
from ..functions.rounding import count_as_decimal, mean_of_parts, published, ratio
from ..plans import measures as m
from ..plans.ranking import with_ranks
from ..plans.staging import staged


def usage_per_user(sessions: DataFrame) -> DataFrame:
    """Everything about a user and vehicle model, busiest first."""
    users = sessions.groupBy(m.USER, m.MODEL).agg(
        m.rows("total_sessions"),
        m.total(m.COST, "total_spent"),
        m.mean(m.COST, "avg_cost_per_session"),
        m.total(m.ENERGY, "total_energy_kwh"),
        m.mean(m.ENERGY, "avg_energy_per_session"),
        m.mean(m.HOURS, "avg_duration_hours"),
        m.distinct(m.STATION, "stations_used"),
        m.distinct(cal.day_of(m.START), "days_active"),
    )
    return m.ranked_by(users, "total_sessions", m.USER, m.MODEL)


def user_charging_frequency(sessions: DataFrame) -> DataFrame:
    """Sessions per day between a user's first and last charge, if on different days."""
    users = sessions.groupBy(m.USER).agg(
        m.rows("total_sessions"), m.first_day("first_charge"), m.last_day("last_charge")
    )
    span = F.datediff("last_charge", "first_charge")
    paced = users.withColumn("days_span", span).where(F.col("days_span") > 0)
    rate = published(ratio(count_as_decimal(F.col("total_sessions")), F.col("days_span")))
    return m.ranked_by(paced.withColumn("sessions_per_day", rate), "sessions_per_day", m.USER)


def user_daily_usage(sessions: DataFrame, user_id: str | None = None) -> DataFrame:
    """Sessions, cost and energy per user and day, for one user if given."""
    if user_id:
        sessions = sessions.where(F.col(m.USER) == F.lit(user_id))
    days = sessions.groupBy(m.USER, cal.day_of(m.START).alias("date")).agg(
        m.rows("sessions_that_day"), m.total(m.COST, "daily_cost"), m.total(m.ENERGY, "daily_energy")
    )
    return days.orderBy(m.USER, "date")


def top_users_ranking(sessions: DataFrame, limit: int = fixed.TOP_ROWS) -> DataFrame:
    """Busiest users with their rank among all by sessions, spending and energy."""
    users = staged(
        sessions.groupBy(m.USER, m.MODEL).agg(
            m.rows("sessions"),
            F.sum(m.COST).alias("cost"),
            F.count(m.COST).alias("priced"),
            F.sum(m.ENERGY).alias("energy"),
            F.sum(m.HOURS).alias("hours"),
        )
    )
    ranked = with_ranks(
        m.ranked_by(users, "sessions", m.USER, m.MODEL, limit=limit),
        users,
        {"sessions": "rank_by_frequency", "cost": "rank_by_spending", "energy": "rank_by_energy"},
    )
    report = ranked.select(
        m.USER,
        m.MODEL,
        "sessions",
        published(F.col("cost")).alias("total_spent"),
        published(F.col("energy")).alias("total_energy"),
        published(F.col("hours")).alias("total_hours"),
        published(mean_of_parts(F.col("cost"), F.col("priced"), 2)).alias("avg_cost"),
        "rank_by_frequency",
        "rank_by_spending",
        "rank_by_energy",
    )
    return m.ranked_by(report, "sessions", m.USER, m.MODEL)
