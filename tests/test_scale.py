"""Busy keys, stations too large to broadcast, and results that outlive lost rows."""

import pytest
from pyspark.sql import functions as F

from checks import views
from wattframe import operators as op
from wattframe.plans import measures as m
from wattframe.plans.locations import locate_spread
from wattframe.plans.staging import shared_folder, staged

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def busy(spark, tmp_path_factory):
    """All sessions, a third at one station and a third by one user."""
    folder = str(tmp_path_factory.mktemp("busy"))
    key = F.col("id") % 3
    sessions = views.sessions(spark, SF_DIR).withColumns(
        {
            "charging_station_id": F.when(key == 1, "S50").otherwise(F.col("charging_station_id")),
            "user_id": F.when(key == 2, "U0").otherwise(F.col("user_id")),
        }
    )
    sessions.repartition(6).write.parquet(f"{folder}/sessions")
    views.stations(spark, SF_DIR).write.parquet(f"{folder}/stations")
    return spark.read.parquet(f"{folder}/sessions"), spark.read.parquet(f"{folder}/stations")


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize(
    "report",
    [
        op.usage_per_station,
        op.charging_sessions_with_location,
        op.usage_by_distrito,
        op.usage_by_concelho,
        op.stations_with_no_usage,
        op.power_vs_usage_analysis,
        op.geographic_coverage_stats,
        op.top_locations_by_revenue,
    ],
)
def test_shuffled_joins_give_the_same_rows(spark, busy, no_broadcast, report):
    shuffled = report(*busy)
    rows = shuffled.collect()
    plan = shuffled._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "BroadcastHashJoin" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    assert report(*busy).collect() == rows


def test_usage_by_distrito_equals_the_plain_join(spark, busy):
    sessions, stations = busy
    joined = sessions.join(stations, sessions[m.STATION] == stations["station_id"])
    plain = joined.groupBy("distrito").agg(
        F.count_distinct(m.STATION).alias("stations_used"),
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_distinct(m.USER).alias("unique_users"),
        F.round(F.avg(m.ENERGY), 2).cast("double").alias("avg_energy_per_session"),
    )
    report = op.usage_by_distrito(sessions, stations).select(plain.columns)
    assert sorted(report.collect()) == sorted(plain.collect())


def test_rows_of_a_busy_station_are_spread(spark, busy, no_broadcast):
    sessions, stations = busy
    pairs = sessions.groupBy(m.STATION, m.USER).agg(m.rows("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        located = locate_spread(pairs, stations.select("station_id", "distrito"), m.USER)
        hot = located.where(F.col(m.STATION) == "S50").groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    total = sum(row["count"] for row in hot)
    assert len(hot) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(row["count"] for row in hot) < total / 2


def test_staged_rows_need_no_input_any_more(spark):
    counter = spark.sparkContext.accumulator(0)

    def seen(row):
        counter.add(1)
        return row

    source = spark.createDataFrame(spark.sparkContext.parallelize(range(10), 2).map(lambda i: seen((i,))), "i int")
    rows = staged(source)
    after = counter.value
    assert after == 10
    assert rows.count() == rows.agg(F.sum("i")).first()[0] - 35 == 10
    assert counter.value == after


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert spark.sparkContext.getCheckpointDir() is not None


def _explained(spark, df):
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(formatted)


@pytest.mark.parametrize(
    "report,columns",
    [
        (lambda s, t: op.hourly_distribution(s), {"charging_start_time", "charging_cost_eur"}),
        (lambda s, t: op.cost_statistics(s), {"charging_cost_eur"}),
        (lambda s, t: op.stations_with_no_usage(s, t), {"charging_station_id"}),
        (lambda s, t: op.user_daily_usage(s, "U0"), {m.USER, m.START, m.COST, m.ENERGY}),
    ],
)
def test_only_needed_columns_are_read(spark, busy, report, columns):
    scans = _explained(spark, report(*busy)).split("Scan parquet")
    (scan,) = [text for text in scans if "/sessions]" in text]
    schema = scan.split("ReadSchema: struct<")[1].split(">\n")[0]
    assert {field.split(":")[0] for field in schema.split(",") if ":" in field} == columns


@pytest.mark.parametrize(
    "report,condition",
    [
        (lambda s, t: op.user_daily_usage(s, "U0"), "EqualTo(user_id,U0)"),
        (lambda s, t: op.station_peak_hours(s, "S50"), "EqualTo(charging_station_id,S50)"),
        (lambda s, t: op.high_power_stations(t), "GreaterThanOrEqual(potencia_maxima_kw,150.00)"),
        (lambda s, t: op.stations_near_coordinates(t, 38.7, -9.1), "GreaterThanOrEqual(latitude,38.6"),
        (lambda s, t: op.newest_sessions(s), "GreaterThanOrEqual(charging_start_time,ScalarSubquery"),
    ],
)
def test_conditions_reach_the_scan(spark, busy, report, condition):
    assert condition in _explained(spark, report(*busy))
