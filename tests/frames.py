"""Small hand-made sessions and stations."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

_SESSION = {
    "id": "bigint",
    "user_id": "string",
    "vehicle_model": "string",
    "battery_capacity_kwh": "decimal(5,2)",
    "charging_station_id": "string",
    "charging_start_time": "timestamp_ntz",
    "energy_consumed_kwh": "decimal(6,2)",
    "charging_duration_hours": "decimal(5,3)",
    "charging_rate_kw": "decimal(6,2)",
    "charging_cost_eur": "decimal(8,2)",
    "time_of_day": "string",
    "day_of_week": "string",
}
_STATION = {
    "station_id": "string",
    "distrito": "string",
    "concelho": "string",
    "freguesia": "string",
    "latitude": "decimal(10,7)",
    "longitude": "decimal(10,7)",
    "potencia_maxima_kw": "decimal(8,2)",
    "pontos_ligacao": "int",
}


def _frame(spark: SparkSession, types: dict[str, str], defaults: dict, rows: list[dict]) -> DataFrame:
    def value(row: dict, name: str):
        found = row.get(name, defaults.get(name))
        if types[name].startswith("decimal") and found is not None:
            return Decimal(str(found))
        if types[name] == "timestamp_ntz" and isinstance(found, str):
            return datetime.fromisoformat(found)
        return found

    schema = ", ".join(f"{name} {kind}" for name, kind in types.items())
    return spark.createDataFrame([tuple(value(row, name) for name in types) for row in rows], schema)


def sessions(spark: SparkSession, *rows: dict) -> DataFrame:
    defaults = {
        "user_id": "U1",
        "vehicle_model": "M",
        "battery_capacity_kwh": 50,
        "charging_station_id": "S1",
        "charging_start_time": "2024-03-01 08:00:00",
        "energy_consumed_kwh": 10,
        "charging_duration_hours": 1,
        "charging_rate_kw": 10,
        "charging_cost_eur": 5,
        "time_of_day": "Morning",
        "day_of_week": "Friday",
    }
    return _frame(spark, _SESSION, defaults, [{"id": i, **row} for i, row in enumerate(rows)])


def stations(spark: SparkSession, *rows: dict) -> DataFrame:
    defaults = {
        "station_id": "S1",
        "distrito": "Lisboa",
        "concelho": "Sintra",
        "freguesia": "Colares",
        "latitude": 38.7,
        "longitude": -9.1,
        "potencia_maxima_kw": 50,
        "pontos_ligacao": 2,
    }
    return _frame(spark, _STATION, defaults, list(rows))


def dicts(df: DataFrame) -> list[dict]:
    return [row.asDict() for row in df.collect()]
