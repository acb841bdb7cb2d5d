"""Tables in the form of the separated files that are loaded."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe import fixed_values as fixed
from wattframe.plans.staging import shuffles_released

_HEADERS = {name: header for header, name, _ in fixed.SESSION_COLUMNS + fixed.STATION_COLUMNS}
#: Lines of a compressed file at most; it can't be split, so a task reads whole ones.
PACKED_LINES = 100_000


def write(lines: DataFrame, folder: str, packed: bool = False) -> None:
    """Header line, separator and quoting of the format; empty stays empty. ``packed`` files are compressed by gzip."""
    headed = lines.select(*[F.col(name).alias(_HEADERS[name]) for name in lines.columns])
    writer = headed.write.options(sep=fixed.FIELD_SEPARATOR, header=True, quote='"', escape='"', emptyValue="")
    if packed:
        writer = writer.options(compression="gzip", maxRecordsPerFile=PACKED_LINES)
    with shuffles_released(lines.sparkSession):
        writer.csv(folder)


def write_ragged(lines: DataFrame, folder: str, short: Column, long: Column) -> None:
    """As above without quotes; the short lines lack their last two fields, the long ones have one too many."""
    names = [name for name in lines.columns if name in _HEADERS]
    joined = lambda columns: F.concat_ws(fixed.FIELD_SEPARATOR, *(F.coalesce(c, F.lit("")) for c in columns))
    line = F.when(long, F.concat(joined(names), F.lit(fixed.FIELD_SEPARATOR + "more"))).when(short, joined(names[:-2]))
    line = line.otherwise(joined(names)).alias(fixed.FIELD_SEPARATOR.join(_HEADERS[name] for name in names))
    lines.select(line).write.options(sep="\x01", header=True, quote="\x00").csv(folder)


def _comma(number: Column) -> Column:
    return F.replace(number.cast("string"), F.lit("."), F.lit(fixed.DECIMAL_MARK))


def _moment(clock: Column) -> Column:
    """Put together from its parts; formatting as a whole would go through the session's time zone."""
    day = F.date_format(F.to_date(clock), "d/M/yy")
    return F.concat(day, F.lit(" "), F.hour(clock), F.lit(":"), F.lpad(F.minute(clock).cast("string"), 2, "0"))


def session_lines(sessions: DataFrame, *more: str) -> DataFrame:
    """All session columns as text, and columns to go along. Some end times and costs are unreadable."""
    key = F.col("id")
    start = F.col("charging_start_time")
    end = F.timestamp_add("MINUTE", F.lit(45), start)
    decimals = ["battery_capacity_kwh", "energy_consumed_kwh", "charging_duration_hours", "charging_rate_kw"]
    return sessions.select(
        "user_id",
        "vehicle_model",
        "charging_station_id",
        _moment(start).alias("charging_start_time"),
        F.when(key % 97 == 5, "soon").otherwise(_moment(end)).alias("charging_end_time"),
        *[_comma(F.col(name)).alias(name) for name in decimals],
        F.when(key % 101 == 3, "1.234,5").otherwise(_comma(F.col("charging_cost_eur"))).alias("charging_cost_eur"),
        "time_of_day",
        "day_of_week",
        F.concat(key % 60, F.lit(",5")).alias("state_of_charge_start_pct"),
        F.concat(key % 40 + 60, F.lit(",25")).alias("state_of_charge_end_pct"),
        F.concat(key % 1000, F.lit(",125")).alias("distance_driven_km"),
        F.concat(key % 55 - 20, F.lit(",0")).alias("temperature_c"),
        F.when(key % 13 == 0, "n/a").otherwise((key % 12).cast("string")).alias("vehicle_age_years"),
        *more,
    )


def station_lines(stations: DataFrame) -> DataFrame:
    """All station columns as text. Longitudes of size-8 stations are unreadable."""
    return stations.select(
        "station_id",
        "distrito",
        "concelho",
        "freguesia",
        _comma(F.col("latitude")).alias("latitude"),
        F.when(F.col("pontos_ligacao") == 8, "east").otherwise(_comma(F.col("longitude"))).alias("longitude"),
        _comma(F.col("potencia_maxima_kw")).alias("potencia_maxima_kw"),
        F.col("pontos_ligacao").cast("string").alias("pontos_ligacao"),
    )


def altered(stations: DataFrame) -> DataFrame:
    """The same stations with other attributes."""
    return stations.withColumns(
        {"distrito": F.lit("ELSEWHERE"), "latitude": F.col("latitude") + 1, "pontos_ligacao": F.lit(1)}
    )
