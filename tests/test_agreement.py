"""Reports that must agree with each other on the same sessions."""

import pytest
from pyspark.sql import functions as F

from checks import views
from wattframe import operators as op

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return views.sessions(spark, SF_DIR).cache(), views.stations(spark, SF_DIR).cache()


def _sums(df, *columns):
    return tuple(round(v, 2) for v in df.agg(*[F.sum(c) for c in columns]).first())


def test_periods_add_up_to_the_total(tables):
    sessions, _ = tables
    total = op.cost_statistics(sessions).first()["total_revenue"]
    energy = op.total_energy_delivered(sessions).first()["total_energy_delivered_kwh"]
    for report in (
        op.daily_trends,
        op.weekly_trends,
        op.weekly_trends_iso,
        op.monthly_trends,
        op.monthly_trends_span,
    ):
        rows = _sums(report(sessions), "total_sessions", "total_energy_kwh", "total_revenue")
        assert rows == (sessions.count(), energy, total)


def test_users_and_stations_add_up_to_the_total(tables):
    sessions, stations = tables
    count = sessions.count()
    assert _sums(op.usage_per_user(sessions), "total_sessions") == (count,)
    assert _sums(op.user_daily_usage(sessions), "sessions_that_day") == (count,)
    assert _sums(op.usage_per_station(sessions, stations), "total_sessions") == (count,)
    assert _sums(op.station_daily_usage(sessions), "sessions_that_day") == (count,)
    known = sessions.join(stations, F.col("charging_station_id") == F.col("station_id")).count()
    assert _sums(op.usage_by_distrito(sessions, stations), "total_sessions") == (known,)
    used = op.usage_per_station(sessions, stations).where("distrito IS NOT NULL").count()
    unused = op.stations_with_no_usage(sessions, stations).count()
    assert used + unused == stations.count()


@pytest.mark.parametrize("report", [op.time_of_day_distribution, op.day_of_week_distribution])
def test_label_shares_add_up_to_all(tables, report):
    assert report(tables[0]).agg(F.sum("percentage")).first()[0] == pytest.approx(100, abs=0.05)


def test_band_shares_add_up_to_those_with_a_value(tables):
    sessions, stations = tables
    with_hours = 100 * op.duration_statistics(sessions).first()["total_sessions"] / sessions.count()
    bands = op.duration_distribution(sessions).agg(F.sum("percentage")).first()[0]
    assert bands == pytest.approx(with_hours, abs=0.05)
    assert bands < 100
    with_power = 100 * stations.where("potencia_maxima_kw IS NOT NULL").count() / stations.count()
    assert op.power_distribution(stations).agg(F.sum("percentage")).first()[0] == pytest.approx(with_power, abs=0.05)


def test_overview_is_the_end_of_the_daily_trend(tables):
    sessions, _ = tables
    newest = op.daily_trends(sessions).orderBy(F.desc("date")).limit(10)
    expected = newest.select("date", "total_sessions", "total_energy_kwh", "avg_cost").collect()
    assert [tuple(r) for r in op.daily_overview(sessions).collect()] == [tuple(r) for r in expected]


def test_cuts_are_the_start_of_the_whole(tables):
    sessions, stations = tables
    whole = op.charging_sessions_with_location(sessions, stations, limit=1000).collect()
    assert op.charging_sessions_with_location(sessions, stations, limit=3).collect() == whole[:3]
    whole = op.top_users_ranking(sessions, limit=100000).collect()
    assert op.top_users_ranking(sessions, limit=7).collect() == whole[:7]
    assert len(whole) == op.usage_per_user(sessions).count()
