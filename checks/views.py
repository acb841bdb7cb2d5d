"""Sessions and stations as views over the given order, supplier and event tables.

Every row of the tables is kept. Some keys are renamed so that stations without
sessions and sessions at unknown stations occur.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def sessions_from(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """One session per order line; works on a stream of lines too."""
    order, line, supplier = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")
    minutes = ((order * 17 + line * 131) % 1440).cast("int")
    station = F.when(supplier % 10 == 3, supplier + 1).otherwise(supplier)
    thousandths = F.round(F.col("l_tax") * 100).cast("int") * 1000 + line * 125
    times = ["Morning", "Afternoon", "Evening", "Night"]
    time_of_day = F.when(line % 5 == 1, times[0])
    for place, name in enumerate(times[1:], start=2):
        time_of_day = time_of_day.when(line % 5 == place, name)
    return lines.join(orders, order == F.col("o_orderkey")).select(
        (order * 10 + line).alias("id"),
        F.concat(F.lit("U"), F.col("o_custkey")).alias("user_id"),
        F.col("o_orderpriority").alias("vehicle_model"),
        (F.lit(40) + F.col("o_custkey") % 7 * 10).cast("decimal(5,2)").alias("battery_capacity_kwh"),
        F.concat(F.lit("S"), station).alias("charging_station_id"),
        F.timestamp_add("MINUTE", minutes, F.col("l_shipdate")).alias("charging_start_time"),
        _unless(order % 50 == 0, F.col("l_quantity").cast("decimal(6,2)")).alias("energy_consumed_kwh"),
        _unless(
            order % 70 == 1, (thousandths.cast("decimal(10,0)") * F.lit(Decimal("0.001"))).cast("decimal(5,3)")
        ).alias("charging_duration_hours"),
        (F.col("l_quantity") * 3).cast("decimal(6,2)").alias("charging_rate_kw"),
        _unless(order % 90 == 2, F.col("l_extendedprice").cast("decimal(8,2)")).alias("charging_cost_eur"),
        time_of_day.alias("time_of_day"),
        F.date_format("l_shipdate", "EEEE").alias("day_of_week"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions_from(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def streamed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table file read as a stream."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions_from(streamed(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation, region = (table(spark, sf_dir, name) for name in ("supplier", "nation", "region"))
    key = F.col("s_suppkey")
    places = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    power = F.floor("s_acctbal").cast("int") % 400
    return places.select(
        F.concat(F.when(key % 25 == 7, "X").otherwise("S"), key).alias("station_id"),
        F.col("r_name").alias("distrito"),
        F.col("n_name").alias("concelho"),
        F.concat("n_name", F.lit("/"), key % 3).alias("freguesia"),
        (F.lit(37) + (key * 37 % 500).cast("decimal(10,0)") * F.lit(Decimal("0.01")))
        .cast("decimal(10,7)")
        .alias("latitude"),
        (F.lit(Decimal("-9.5")) + (key * 53 % 300).cast("decimal(10,0)") * F.lit(Decimal("0.01")))
        .cast("decimal(10,7)")
        .alias("longitude"),
        _unless(F.col("s_acctbal") < 0, power.cast("decimal(8,2)")).alias("potencia_maxima_kw"),
        _unless(key % 20 == 0, (key % 8 + 1).cast("int")).alias("pontos_ligacao"),
    )


def sessions_from_events(events: DataFrame) -> DataFrame:
    """One session per event; works on a stream of events too."""
    return events.select(
        F.col("ts").alias("charging_start_time"),
        F.concat(F.lit("U"), F.col("user_id")).alias("user_id"),
        _unless(F.col("event_type") == "error", F.col("value").cast("decimal(6,2)")).alias("energy_consumed_kwh"),
        (F.col("value") * 2).cast("decimal(8,2)").alias("charging_cost_eur"),
        (F.col("event_id") % 9000 * F.lit(Decimal("0.001"))).cast("decimal(5,3)").alias("charging_duration_hours"),
    )


def messages_from_events(events: DataFrame, spoilt: Column | None = None) -> DataFrame:
    """One message per event, its topic named after the event type; spoilt payloads begin with a byte that no text has."""
    payload = F.encode("props", "UTF-8")
    if spoilt is not None:
        payload = F.when(spoilt, F.concat(F.unhex(F.lit("FF")), payload)).otherwise(payload)
    return events.select(
        F.concat(F.lit("topic/"), "event_type").alias("topic"),
        payload.alias("payload"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
