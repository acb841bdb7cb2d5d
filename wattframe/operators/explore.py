"""Looking at the tables as a whole: profile, headline figures, newest rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import calendar as cal
from ..functions.rounding import published
from ..plans import measures as m


def table_profile(sessions: DataFrame, stations: DataFrame) -> DataFrame:
    """Row counts and distinct counts as (metric, value) rows.

    Distinct counts of an empty table are left out.
    """
    session_side = sessions.agg(
        m.rows("sessions"),
        m.distinct(m.USER, "users"),
        m.distinct(m.STATION, "stations_used"),
        m.distinct(m.MODEL, "vehicle_models"),
    )
    station_side = stations.agg(
        m.rows("stations"), m.distinct("distrito", "distritos"), m.distinct("concelho", "concelhos")
    )

    def as_rows(one_row: DataFrame) -> DataFrame:
        count = one_row.columns[0]
        entries = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in one_row.columns]
        rows = one_row.select(F.col(count).alias("_rows"), F.inline(F.array(*entries)))
        return rows.where((F.col("_rows") > 0) | (F.col("metric") == F.lit(count))).drop("_rows")

    return as_rows(session_side).unionByName(as_rows(station_side))


def headline_figures(sessions: DataFrame, stations: DataFrame) -> DataFrame:
    """Sessions, users, stations and whole kWh in one row."""
    station_count = stations.agg(F.count(F.lit(1))).scalar()
    return sessions.agg(
        m.rows("total_sessions"), m.distinct(m.USER, "active_users"), m.total(m.ENERGY, "total_energy_kwh", 0)
    ).select("total_sessions", "active_users", station_count.alias("total_stations"), "total_energy_kwh")


def newest_sessions(sessions: DataFrame, limit: int = fixed.NEWEST_ROWS) -> DataFrame:
    """All columns of the newest sessions; those without a start time come last.

    The start time of the last row is found from that one column first; the
    wide read then keeps only rows at or above it. Rows without a start time are
    read only if there are too few others.
    """
    newest = sessions.select(m.START).where(F.col(m.START).isNotNull()).orderBy(F.desc(m.START)).limit(limit)
    found = newest.agg(F.min(m.START).alias("oldest"), F.count(F.lit(1)).alias("rows"))
    timed = sessions.where(F.col(m.START) >= found.select("oldest").scalar())
    untimed = sessions.where(F.col(m.START).isNull() & (found.select("rows").scalar() < F.lit(limit)))
    ties = [c for c in sessions.columns if c != m.START]
    return timed.unionByName(untimed).orderBy(F.desc_nulls_last(m.START), *ties).limit(limit)


def daily_overview(sessions: DataFrame, days: int = fixed.OVERVIEW_DAYS) -> DataFrame:
    """Sessions, energy and average cost of the newest days."""
    by_day = sessions.groupBy(cal.day_of(m.START).alias("date")).agg(
        m.rows("sessions"),
        published(F.sum(m.ENERGY)).alias("energy"),
        m.mean(m.COST, "avg_cost"),
    )
    return by_day.orderBy(F.desc("date")).limit(days)
