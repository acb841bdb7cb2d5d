"""Bringing sessions and stations together.

Sessions are added up before they meet the stations: a station that holds a
third of all sessions is then one row of the join, and both sides have unique
keys. No side is broadcast by hint; Spark does so when its size estimate is
below the session's threshold.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import measures as m


def per_station(sessions: DataFrame, *aggregates: Column) -> DataFrame:
    return sessions.groupBy(m.STATION).agg(*aggregates)


def locate(by_station: DataFrame, stations: DataFrame, how: str = "inner") -> DataFrame:
    """Joins rows that are unique per station with the station's attributes."""
    return by_station.join(stations, by_station[m.STATION] == stations["station_id"], how)


def locate_spread(pairs: DataFrame, stations: DataFrame, spread_by: str, rows: int | None = None) -> DataFrame:
    """Joins many rows per station with few station columns.

    Rows of one station are spread over slices by a second key and the station
    row is repeated per slice, so a busy station is not one task's work. There
    are four slices to a shuffle partition of the session, so that each gets
    some, but only as many that all repeated station rows together are no more
    than ``rows``, about the number of pairs (by default they are counted).
    """
    rows = pairs.count() if rows is None else rows
    number = 4 * int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = max(1, min(number, rows // max(1, stations.count())))
    slices = F.sequence(F.lit(0), F.lit(number - 1))
    sliced_stations = stations.withColumn("_slice", F.explode(slices))
    sliced_pairs = pairs.withColumn("_slice", F.pmod(F.hash(spread_by), F.lit(number)))
    matches = (sliced_pairs[m.STATION] == sliced_stations["station_id"]) & (
        sliced_pairs["_slice"] == sliced_stations["_slice"]
    )
    return sliced_pairs.join(sliced_stations, matches).drop("_slice")


_NAMES = ["distrito", "concelho", "freguesia"]


def collated(stations: DataFrame, collation: str | None) -> DataFrame:
    """Station geography compared under a collation, e.g. ``UNICODE_CI_AI``.

    Without one, names are compared byte by byte. Of names that are equal under
    the collation the smallest spelling is reported, so row order doesn't matter.
    Spellings are found on one row per name.
    """
    if collation is None:
        return stations
    spelled = stations
    for name in _NAMES:
        alike = F.collate(F.col(name), collation)
        smallest = stations.groupBy(alike.alias("_alike")).agg(F.min(name).alias("_spelling"))
        spelled = spelled.join(smallest, alike == F.col("_alike"), "left")
        spelled = spelled.withColumn(name, F.collate(F.col("_spelling"), collation)).drop("_alike", "_spelling")
    return spelled


def plain(report: DataFrame, collation: str | None) -> DataFrame:
    """Names as ordinary text again, for the caller."""
    if collation is None:
        return report
    shown = [name for name in _NAMES if name in report.columns]
    return report.withColumns({name: F.collate(F.col(name), "UTF8_BINARY") for name in shown})
