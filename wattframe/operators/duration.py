"""How long sessions take."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.bands import band_of, labels_of, position_in
from ..plans import measures as m
from ..plans.shares import share_of_bands


def _timed(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col(m.HOURS).isNotNull())


def duration_statistics(sessions: DataFrame) -> DataFrame:
    """Overall duration statistics in one row."""
    return _timed(sessions).agg(
        m.rows("total_sessions"),
        m.mean(m.HOURS, "avg_duration_hours"),
        m.lowest(m.HOURS, "min_duration_hours"),
        m.highest(m.HOURS, "max_duration_hours"),
        m.spread(m.HOURS, "duration_std_dev"),
        m.mean_minutes(m.HOURS, "avg_duration_minutes"),
    )


def duration_distribution(sessions: DataFrame) -> DataFrame:
    """Sessions per duration band, as a share of all sessions.

    Sessions without a duration count in the total but form no band, so the
    shares may add up to less than 100.
    """
    bands = sessions.groupBy(band_of(F.col(m.HOURS), fixed.DURATION_BANDS).alias("duration_range")).agg(
        m.rows("session_count"), m.mean(m.ENERGY, "avg_energy_kwh"), m.mean(m.COST, "avg_cost")
    )
    shares = share_of_bands(bands, "session_count").where(F.col("duration_range").isNotNull())
    return shares.orderBy(position_in(F.col("duration_range"), labels_of(fixed.DURATION_BANDS)))


def duration_by_vehicle_model(sessions: DataFrame) -> DataFrame:
    """Duration per vehicle model, longest average first."""
    models = _timed(sessions).groupBy(m.MODEL).agg(
        m.rows("sessions"),
        m.mean(m.HOURS, "avg_duration_hours"),
        m.mean_minutes(m.HOURS, "avg_duration_minutes"),
        m.lowest(m.HOURS, "min_duration_hours"),
        m.highest(m.HOURS, "max_duration_hours"),
    )
    return m.ranked_by(models, "avg_duration_hours", m.MODEL)


def duration_by_time_of_day(sessions: DataFrame) -> DataFrame:
    """Duration and energy per time of day, morning to night."""
    times = _timed(sessions).where(F.col("time_of_day").isNotNull()).groupBy("time_of_day").agg(
        m.rows("sessions"),
        m.mean(m.HOURS, "avg_duration_hours"),
        m.mean_minutes(m.HOURS, "avg_duration_minutes"),
        m.mean(m.ENERGY, "avg_energy_kwh"),
    )
    return times.orderBy(position_in(F.col("time_of_day"), fixed.TIMES_OF_DAY), "time_of_day")
