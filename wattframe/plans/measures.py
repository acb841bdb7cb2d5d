"""Named aggregate columns from which the reports are put together."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import deviation_of_parts, mean_of_parts, published, squared_units

ENERGY = "energy_consumed_kwh"
COST = "charging_cost_eur"
HOURS = "charging_duration_hours"
RATE = "charging_rate_kw"
BATTERY = "battery_capacity_kwh"
START = "charging_start_time"
USER = "user_id"
MODEL = "vehicle_model"
STATION = "charging_station_id"
POWER = "potencia_maxima_kw"
POINTS = "pontos_ligacao"
#: Digits after the point.
SCALES = {ENERGY: 2, COST: 2, HOURS: 3, RATE: 2, POWER: 2}


def rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def total(column: str, name: str, digits: int = 2) -> Column:
    return published(F.sum(column), digits).alias(name)


def mean(column: str, name: str) -> Column:
    return published(F.avg(column)).alias(name)


def mean_minutes(column: str, name: str) -> Column:
    """Average of an hour column, in minutes; scaled before rounding."""
    return published(F.avg(column) * 60).alias(name)


def lowest(column: str, name: str) -> Column:
    return published(F.min(column)).alias(name)


def highest(column: str, name: str) -> Column:
    return published(F.max(column)).alias(name)


def spread(column: str, name: str) -> Column:
    """Population standard deviation, from exact sums of the values and of their squares."""
    scale = SCALES[column]
    squares = F.sum(squared_units(F.col(column), scale))
    return deviation_of_parts(F.sum(column), squares, F.count(column), scale).alias(name)


def distinct(column: str | Column, name: str) -> Column:
    return F.count_distinct(column).alias(name)


def first_day(name: str) -> Column:
    return F.to_date(F.min(START)).alias(name)


def last_day(name: str) -> Column:
    return F.to_date(F.max(START)).alias(name)


def ranked_by(df: DataFrame, metric: str, *keys: str, limit: int | None = None) -> DataFrame:
    """Largest metric first. Keys settle ties, so a cut is repeatable."""
    ordered = df.orderBy(F.desc(metric), *keys)
    return ordered if limit is None else ordered.limit(limit)


# --- parts: sums and counts that can be added up again after a join --------------------


def parts(*columns: str) -> list[Column]:
    """Row count plus, for each column, its sum and the number of its values."""
    out = [F.count(F.lit(1)).alias("n")]
    for column in columns:
        out += [F.sum(column).alias(f"{column}_sum"), F.count(column).alias(f"{column}_n")]
    return out


def total_of_parts(column: str, name: str) -> Column:
    return published(F.sum(f"{column}_sum")).alias(name)


def mean_of_summed_parts(column: str, name: str) -> Column:
    exact = mean_of_parts(F.sum(f"{column}_sum"), F.sum(f"{column}_n"), SCALES[column])
    return published(exact).alias(name)


def rows_of_parts(name: str) -> Column:
    return F.sum("n").alias(name)
