"""Daily figures on a stream of sessions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as fixed
from ..operators.explore import daily_overview
from ..plans import measures as m


def start_daily_overview(
    sessions: DataFrame,
    name: str,
    checkpoint: str,
    interval: str | None = fixed.REFRESH_INTERVAL,
    days: int = fixed.OVERVIEW_DAYS,
) -> StreamingQuery:
    """Keeps the newest days up to date in an in-memory table of that name.

    State is one row per day and the table holds ``days`` rows. Without an
    interval all present input is processed and the query ends.
    """
    writer = daily_overview(sessions, days).writeStream.outputMode("complete").format("memory").queryName(name)
    when = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**when).start()


def _watermarked(sessions: DataFrame, delay: str) -> DataFrame:
    """Adds the start time as an instant, which a watermark needs.

    The clock time is taken as if it were UTC, whatever the session's zone, so
    one-day windows are calendar days.
    """
    at = F.from_utc_timestamp(F.col(m.START).cast("timestamp"), F.current_timezone())
    return sessions.withColumn("_at", at).withWatermark("_at", delay)


def _date_of(window_start: str) -> Column:
    return F.date_from_unix_date((F.unix_seconds(window_start) / F.lit(24 * 60 * 60)).cast("int"))


def daily_windows(sessions: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Volume per day for append mode: a day appears once, after it can no longer change."""
    days = _watermarked(sessions, delay).groupBy(F.window("_at", "1 day")).agg(
        m.rows("total_sessions"),
        m.total(m.ENERGY, "total_energy_kwh"),
        m.mean(m.ENERGY, "avg_energy_kwh"),
        m.total(m.COST, "total_revenue"),
        m.mean(m.COST, "avg_cost"),
        m.mean(m.HOURS, "avg_duration_hours"),
    )
    return days.select(_date_of("window.start").alias("date"), *days.columns[1:])


def daily_users(sessions: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Exact distinct users per day for append mode.

    Sessions of a user and day are first reduced to one row, then counted, so
    state is spread by user and no day is one task's work.
    """
    day_and_user = _watermarked(sessions, delay).groupBy(F.window("_at", "1 day").alias("day"), m.USER)
    known = day_and_user.agg(m.rows("n")).withColumn("_known", F.col(m.USER).isNotNull().cast("int"))
    days = known.groupBy(F.window("day", "1 day").alias("day")).agg(F.sum("_known").alias("unique_users"))
    return days.select(_date_of("day.start").alias("date"), "unique_users")


def daily_users_estimate(sessions: DataFrame, delay: str = "1 hour", error: float = 0.05) -> DataFrame:
    """Estimated distinct users per day, with small fixed state per day."""
    days = _watermarked(sessions, delay).groupBy(F.window("_at", "1 day").alias("day")).agg(
        F.approx_count_distinct(m.USER, error).alias("unique_users")
    )
    return days.select(_date_of("day.start").alias("date"), "unique_users")
