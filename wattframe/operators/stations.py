"""Usage per charging station."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import calendar as cal
from ..functions.rounding import count_as_decimal, published, ratio
from ..plans import measures as m
from ..plans.locations import locate, per_station
from ..plans.ranking import with_ranks
from ..plans.staging import staged


def usage_per_station(sessions: DataFrame, stations: DataFrame) -> DataFrame:
    """Everything about a station, busiest first; unknown stations have no location."""
    usage = per_station(
        sessions,
        m.rows("total_sessions"),
        m.distinct(m.USER, "unique_users"),
        m.total(m.COST, "total_revenue"),
        m.mean(m.COST, "avg_revenue_per_session"),
        m.total(m.ENERGY, "total_energy_delivered"),
        m.mean(m.ENERGY, "avg_energy_per_session"),
        m.mean(m.HOURS, "avg_duration_hours"),
        m.mean(m.RATE, "avg_charging_rate_kw"),
        m.distinct(cal.day_of(m.START), "days_active"),
    )
    located = locate(usage, stations, "left").select(
        m.STATION,
        "distrito",
        "concelho",
        "freguesia",
        published(F.col(m.POWER)).alias("station_power_kw"),
        F.col(m.POINTS).alias("connection_points"),
        *usage.columns[1:],
    )
    return m.ranked_by(located, "total_sessions", m.STATION)


def station_daily_usage(sessions: DataFrame, station_id: str | None = None) -> DataFrame:
    """Sessions, users, revenue and energy per station and day, for one station if given."""
    if station_id:
        sessions = sessions.where(F.col(m.STATION) == F.lit(station_id))
    days = sessions.groupBy(m.STATION, cal.day_of(m.START).alias("date")).agg(
        m.rows("sessions_that_day"),
        m.distinct(m.USER, "unique_users"),
        m.total(m.COST, "daily_revenue"),
        m.total(m.ENERGY, "daily_energy"),
    )
    return days.orderBy(m.STATION, "date")


def station_utilization_rate(sessions: DataFrame) -> DataFrame:
    """Sessions and hours per day between first and last use, both days counted."""
    usage = per_station(
        sessions,
        m.rows("total_sessions"),
        m.first_day("first_use"),
        m.last_day("last_use"),
        F.sum(m.HOURS).alias("hours"),
    )
    dated = usage.withColumn("days_in_operation", F.datediff("last_use", "first_use") + 1)
    rates = dated.select(
        m.STATION,
        "total_sessions",
        "first_use",
        "last_use",
        "days_in_operation",
        published(ratio(count_as_decimal(F.col("total_sessions")), F.col("days_in_operation"))).alias(
            "sessions_per_day"
        ),
        published(ratio(F.col("hours"), F.col("days_in_operation"))).alias("hours_used_per_day"),
    )
    return m.ranked_by(rates, "sessions_per_day", m.STATION)


def top_stations_ranking(sessions: DataFrame, limit: int = fixed.TOP_ROWS) -> DataFrame:
    """Busiest stations with their rank among all by sessions, revenue and users."""
    stations = staged(
        per_station(
            sessions,
            m.rows("sessions"),
            F.sum(m.COST).alias("cost"),
            F.sum(m.ENERGY).alias("energy"),
            m.distinct(m.USER, "unique_users"),
        )
    )
    ranked = with_ranks(
        m.ranked_by(stations, "sessions", m.STATION, limit=limit),
        stations,
        {"sessions": "rank_by_usage", "cost": "rank_by_revenue", "unique_users": "rank_by_user_diversity"},
    )
    report = ranked.select(
        m.STATION,
        "sessions",
        published(F.col("cost")).alias("revenue"),
        published(F.col("energy")).alias("energy_delivered"),
        "unique_users",
        "rank_by_usage",
        "rank_by_revenue",
        "rank_by_user_diversity",
    )
    return m.ranked_by(report, "sessions", m.STATION)


def station_peak_hours(sessions: DataFrame, station_id: str) -> DataFrame:
    """Hours of day of one station, busiest first."""
    own = sessions.where(F.col(m.STATION) == F.lit(station_id))
    hours = own.groupBy(F.hour(m.START).alias("hour")).agg(
        m.rows("sessions"), m.mean(m.HOURS, "avg_duration")
    )
    return m.ranked_by(hours, "sessions", "hour")
