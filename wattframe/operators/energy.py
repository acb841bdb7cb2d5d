"""Energy delivered."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import calendar as cal
from ..functions.rounding import published, ratio
from ..plans import measures as m


def _with_energy(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col(m.ENERGY).isNotNull())


def total_energy_delivered(sessions: DataFrame) -> DataFrame:
    """Overall energy statistics in one row."""
    return _with_energy(sessions).agg(
        m.rows("total_sessions"),
        m.total(m.ENERGY, "total_energy_delivered_kwh"),
        m.mean(m.ENERGY, "avg_energy_per_session"),
        m.lowest(m.ENERGY, "min_energy_kwh"),
        m.highest(m.ENERGY, "max_energy_kwh"),
        m.spread(m.ENERGY, "energy_std_dev"),
    )


def energy_by_vehicle_model(sessions: DataFrame) -> DataFrame:
    """Energy per model and how much of the battery an average session fills."""
    known = _with_energy(sessions).where(F.col(m.BATTERY).isNotNull())
    filled = ratio(F.avg(m.ENERGY), F.avg(m.BATTERY)) * 100
    models = known.groupBy(m.MODEL).agg(
        m.rows("sessions"),
        m.total(m.ENERGY, "total_energy_kwh"),
        m.mean(m.ENERGY, "avg_energy_per_session"),
        m.mean(m.BATTERY, "avg_battery_capacity"),
        published(filled).alias("avg_battery_pct_charged"),
    )
    return m.ranked_by(models, "total_energy_kwh", m.MODEL)


def energy_by_station(sessions: DataFrame, limit: int = fixed.TOP_ROWS) -> DataFrame:
    """Stations that delivered most energy."""
    by_station = _with_energy(sessions).groupBy(m.STATION).agg(
        m.rows("sessions"),
        m.total(m.ENERGY, "total_energy_delivered_kwh"),
        m.mean(m.ENERGY, "avg_energy_per_session"),
        m.mean(m.RATE, "avg_charging_rate_kw"),
    )
    return m.ranked_by(by_station, "total_energy_delivered_kwh", m.STATION, limit=limit)


def daily_energy_delivered(sessions: DataFrame) -> DataFrame:
    """Energy per day and average power over the hours charged."""
    timed = _with_energy(sessions).where(F.col(m.HOURS) > 0)
    days = timed.groupBy(cal.day_of(m.START).alias("date")).agg(
        m.rows("sessions"),
        m.total(m.ENERGY, "total_energy_kwh"),
        m.mean(m.ENERGY, "avg_energy_kwh"),
        published(ratio(F.sum(m.ENERGY), F.sum(m.HOURS))).alias("avg_power_kw"),
    )
    return days.orderBy("date")
