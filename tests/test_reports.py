"""Small cases with known answers."""

import pytest
from pyspark.sql import functions as F

from wattframe import operators as op

from .frames import dicts, sessions, stations


def test_weeks_at_year_end(spark):
    s = sessions(
        spark,
        {"charging_start_time": "2021-01-01 10:00:00"},
        {"charging_start_time": "2020-12-31 10:00:00"},
        {"charging_start_time": "2024-12-30 10:00:00"},
    )
    assert [(r["year"], r["week_number"], r["year_week"]) for r in dicts(op.weekly_trends(s))] == [
        (2020, 53, "2020-W53"),
        (2021, 0, "2021-W00"),
        (2024, 53, "2024-W53"),
    ]
    iso = dicts(op.weekly_trends_iso(s))
    assert [(r["yearweek"], r["total_sessions"]) for r in iso] == [(202053, 2), (202501, 1)]
    assert str(iso[0]["week_start"]) == "2020-12-31"
    assert str(iso[0]["week_end"]) == "2021-01-01"


def test_trend_comparison_order_and_averages(spark):
    s = sessions(
        spark,
        {"charging_start_time": "2024-01-01 00:00:00", "energy_consumed_kwh": 1},
        {"charging_start_time": "2024-01-01 23:59:00", "energy_consumed_kwh": 2},
        {"charging_start_time": "2024-01-02 12:00:00", "energy_consumed_kwh": None},
        {"charging_start_time": "2024-02-20 12:00:00", "energy_consumed_kwh": 4},
    )
    rows = [(r["period_type"], r["avg_sessions"], r["avg_energy_kwh"]) for r in dicts(op.trend_comparison(s))]
    # the day without energy has no sum and does not count in the daily energy
    assert rows == [("Daily Average", 1.33, 3.5), ("Weekly Average", 2.0, 3.5), ("Monthly Average", 2.0, 3.5)]


def test_hours_narrow_and_wide(spark):
    s = sessions(spark, {"charging_start_time": "2024-01-01 23:59:00"})
    assert op.hourly_distribution(s).columns == ["hour", "session_count", "avg_cost"]
    assert op.hourly_distribution(s, wide=True).first() == (23, 1, 5.0, 10.0, 1.0)


def test_statistics_of_nothing(spark):
    none = sessions(spark)
    (energy,) = dicts(op.total_energy_delivered(none))
    assert energy["total_sessions"] == 0
    assert energy["total_energy_delivered_kwh"] is None
    (hours,) = dicts(op.duration_statistics(none))
    assert hours["avg_duration_minutes"] is None
    assert op.daily_trends(none).count() == 0
    assert op.time_of_day_distribution(none).count() == 0
    assert op.top_users_ranking(none).count() == 0


def test_population_deviation(spark):
    s = sessions(spark, {"energy_consumed_kwh": 2}, {"energy_consumed_kwh": 4}, {"energy_consumed_kwh": None})
    (row,) = dicts(op.total_energy_delivered(s))
    assert (row["total_sessions"], row["energy_std_dev"]) == (2, 1.0)


def test_battery_share(spark):
    s = sessions(
        spark,
        {"energy_consumed_kwh": 10, "battery_capacity_kwh": 30},
        {"energy_consumed_kwh": 20, "battery_capacity_kwh": 60},
        {"energy_consumed_kwh": 20, "battery_capacity_kwh": None},
    )
    (row,) = dicts(op.energy_by_vehicle_model(s))
    assert (row["sessions"], row["avg_battery_pct_charged"]) == (2, 33.33)


def test_power_needs_time(spark):
    s = sessions(
        spark,
        {"energy_consumed_kwh": 10, "charging_duration_hours": "0.5"},
        {"energy_consumed_kwh": 99, "charging_duration_hours": 0},
        {"energy_consumed_kwh": 99, "charging_duration_hours": None},
    )
    (row,) = dicts(op.daily_energy_delivered(s))
    assert (row["sessions"], row["avg_power_kw"]) == (1, 20.0)


def test_duration_shares_are_of_all_sessions(spark):
    s = sessions(spark, *[{"charging_duration_hours": h} for h in (1, "0.5", 7, None)])
    rows = [(r["duration_range"], r["session_count"], r["percentage"]) for r in dicts(op.duration_distribution(s))]
    assert rows == [("30 min - 1 hour", 2, 50.0), ("> 6 hours", 1, 25.0)]


def test_label_shares_are_of_labelled_sessions(spark):
    s = sessions(spark, *[{"time_of_day": t} for t in ("Night", "Morning", "Night", None, "Noon")])
    rows = [(r["time_of_day"], r["percentage"]) for r in dicts(op.time_of_day_distribution(s))]
    # unknown labels come first
    assert rows == [("Noon", 25.0), ("Morning", 25.0), ("Night", 50.0)]
    s = sessions(spark, *[{"day_of_week": d} for d in ("Sunday", "Monday", None)])
    rows = [(r["day_of_week"], r["percentage"]) for r in dicts(op.day_of_week_distribution(s))]
    assert rows == [("Monday", 50.0), ("Sunday", 50.0)]


def test_unknown_weekday_counts_as_weekday(spark):
    s = sessions(spark, *[{"day_of_week": d} for d in ("Sunday", "Saturday", "Monday", "Holiday", None)])
    counts = {r["period_type"]: r["session_count"] for r in dicts(op.weekend_vs_weekday(s))}
    assert counts == {"Weekend": 2, "Weekday": 2}


def test_cost_per_kwh(spark):
    s = sessions(
        spark,
        {"charging_cost_eur": 1, "energy_consumed_kwh": 3},
        {"charging_cost_eur": 50, "energy_consumed_kwh": 0},
        {"charging_cost_eur": None, "energy_consumed_kwh": 9},
    )
    (row,) = dicts(op.monthly_cost_trends(s))
    assert (row["month"], row["month_name"], row["sessions"], row["cost_per_kwh"]) == ("2024-03", "March 2024", 1, 0.33)


def test_pace_needs_two_days(spark):
    s = sessions(
        spark,
        {"user_id": "once", "charging_start_time": "2024-01-01 01:00:00"},
        {"user_id": "once", "charging_start_time": "2024-01-01 23:00:00"},
        {"user_id": "twice", "charging_start_time": "2024-01-01 23:59:00"},
        {"user_id": "twice", "charging_start_time": "2024-01-02 00:01:00"},
    )
    (row,) = dicts(op.user_charging_frequency(s))
    assert (row["user_id"], row["days_span"], row["sessions_per_day"]) == ("twice", 1, 2.0)
    days = {r["charging_station_id"]: r["days_in_operation"] for r in dicts(op.station_utilization_rate(s))}
    assert days == {"S1": 2}


@pytest.mark.parametrize("everyone", [None, ""])
def test_optional_filters(spark, everyone):
    s = sessions(spark, {"user_id": "a", "charging_station_id": "x"}, {"user_id": "b", "charging_station_id": "y"})
    assert op.user_daily_usage(s, everyone).count() == 2
    assert op.user_daily_usage(s, "a").count() == 1
    assert op.station_daily_usage(s, everyone).count() == 2
    assert op.station_daily_usage(s, "y").count() == 1


def test_values_are_never_part_of_the_query(spark):
    s = sessions(spark, {"user_id": "a"}, {"user_id": "x' OR '1'='1"})
    assert op.user_daily_usage(s, "x' OR '1'='1").count() == 1


# --- places ------------------------------------------------------------------------------


def test_power_shares_are_of_all_stations(spark):
    t = stations(spark, *[{"station_id": f"S{i}", "potencia_maxima_kw": p} for i, p in enumerate((50, 301, None, 10))])
    rows = [(r["power_category"], r["percentage"]) for r in dicts(op.power_distribution(t))]
    assert rows == [("< 50 kW (Slow)", 25.0), ("50-100 kW (Medium)", 25.0), ("> 300 kW (Ultra Fast)", 25.0)]


def test_connection_shares_are_of_all_stations(spark):
    t = stations(spark, *[{"station_id": f"S{i}", "pontos_ligacao": p} for i, p in enumerate((4, 2, None, 2))])
    rows = [(r["connection_points"], r["percentage"]) for r in dicts(op.connection_points_analysis(t))]
    assert rows == [(2, 50.0), (4, 25.0)]


@pytest.mark.parametrize("least,expected", [(150, 2), (149.991, 2), (149.99, 3), ("150.01", 1), (10**9, 0), (0, 3)])
def test_power_limit_between_storable_amounts(spark, least, expected):
    t = stations(spark, *[{"station_id": p, "potencia_maxima_kw": p} for p in ("149.99", "150", "150.01")])
    assert op.high_power_stations(t, min_power=least).count() == expected


def test_density_without_distrito_has_no_ratio(spark):
    t = stations(
        spark,
        {"station_id": "1", "distrito": None},
        {"station_id": "2"},
        {"station_id": "3"},
        {"station_id": "4", "concelho": "Oeiras"},
        {"station_id": "5", "concelho": None},
    )
    rows = {
        (r["distrito"], r["concelho"]): r["stations_per_concelho_in_distrito"]
        for r in dicts(op.station_density_by_area(t, min_stations=1))
    }
    assert rows == {
        (None, "Sintra"): None,
        ("Lisboa", "Sintra"): 1.0,
        ("Lisboa", "Oeiras"): 0.5,
        ("Lisboa", None): 0.5,
    }
    assert op.station_density_by_area(t).count() == 0


def test_unknown_and_unused_stations(spark):
    s = sessions(
        spark,
        {"charging_station_id": "S1", "energy_consumed_kwh": 10},
        {"charging_station_id": "S1", "energy_consumed_kwh": None, "user_id": "U2"},
        {"charging_station_id": "ghost", "energy_consumed_kwh": 30},
    )
    t = stations(
        spark,
        {"station_id": "S1", "potencia_maxima_kw": 20},
        {"station_id": "S2", "potencia_maxima_kw": 40, "distrito": "Porto"},
        {"station_id": "S3", "potencia_maxima_kw": None},
    )
    usage = {r["charging_station_id"]: r for r in dicts(op.usage_per_station(s, t))}
    assert usage["ghost"]["distrito"] is None
    assert usage["S1"]["station_power_kw"] == 20.0
    assert usage["S1"]["unique_users"] == 2
    assert [r["charging_station_id"] for r in dicts(op.charging_sessions_with_location(s, t))] == ["S1", "ghost"]
    # stations without a known power come last
    assert [r["station_id"] for r in dicts(op.stations_with_no_usage(s, t))] == ["S2", "S3"]
    (lisboa,) = dicts(op.usage_by_distrito(s, t))
    assert (lisboa["distrito"], lisboa["total_sessions"], lisboa["unique_users"]) == ("Lisboa", 2, 2)
    assert (lisboa["stations_used"], lisboa["avg_energy_per_session"]) == (1, 10.0)
    (band,) = dicts(op.power_vs_usage_analysis(s, t))
    assert (band["total_stations"], band["stations_with_usage"], band["total_sessions"]) == (2, 1, 2)
    # two sessions at 20 kW and one unused station of 40 kW
    assert band["avg_station_power"] == 26.67
    total, used = dicts(op.geographic_coverage_stats(s, t))
    assert (total["metric"], total["total_stations"], total["avg_power"]) == ("Total Coverage", 3, 30.0)
    assert (used["metric"], used["total_stations"], used["avg_power"]) == ("With Charging Sessions", 1, 20.0)


def test_coverage_without_sessions(spark):
    _, used = dicts(op.geographic_coverage_stats(sessions(spark), stations(spark, {})))
    assert (used["distritos"], used["total_stations"], used["avg_power"]) == (0, 0, None)


def test_places_under_a_collation(spark):
    t = stations(
        spark, *[{"station_id": str(i), "distrito": d} for i, d in enumerate(("Évora", "evora", "ÉVORA", "Beja"))]
    )
    assert op.stations_by_distrito(t).count() == 4
    merged = {r["total_stations"] for r in dicts(op.stations_by_distrito(t, collation="UNICODE_CI_AI"))}
    assert merged == {3, 1}
    assert op.stations_by_concelho(t, distrito="EVORA").count() == 0
    (row,) = dicts(op.stations_by_concelho(t, distrito="EVORA", collation="UNICODE_CI_AI"))
    assert row["total_stations"] == 3
    s = sessions(spark, *[{"charging_station_id": str(i)} for i in range(4)])
    places = {r["total_sessions"] for r in dicts(op.usage_by_distrito(s, t, collation="UNICODE_CI_AI"))}
    assert places == {3, 1}


def test_rounded_distance_decides(spark):
    # 0.09 degrees of latitude are 10.0075 km
    t = stations(
        spark,
        {"station_id": "in", "latitude": "38.79", "longitude": "-9.1"},
        {"station_id": "edge", "latitude": "38.7899775", "longitude": "-9.1"},
        {"station_id": "none", "latitude": None},
    )
    near = dicts(op.stations_near_coordinates(t, 38.7, -9.1, 10.01))
    assert [(r["station_id"], r["distance_km"]) for r in near] == [("edge", 10.01), ("in", 10.01)]
    assert op.stations_near_coordinates(t, 38.7, -9.1).count() == 0


# --- whole tables ---------------------------------------------------------------------------


def test_profile_of_empty_tables(spark):
    got = [tuple(r) for r in op.table_profile(sessions(spark), stations(spark)).collect()]
    assert got == [("sessions", 0), ("stations", 0)]


def test_headline_figures(spark):
    s = sessions(spark, {"energy_consumed_kwh": "1.5"}, {"energy_consumed_kwh": 1, "user_id": None})
    assert op.headline_figures(s, stations(spark, {}, {"station_id": "S2"})).first() == (2, 1, 2, 3.0)


@pytest.mark.parametrize("limit", [1, 3, 4, 10])
def test_newest_sessions_are_complete(spark, limit):
    times = ["2024-01-03 00:00:00", "2024-01-02 00:00:00", "2024-01-02 00:00:00", "2024-01-01 00:00:00", None]
    s = sessions(spark, *[{"charging_start_time": t, "id": i} for i, t in enumerate(times)])
    if limit > 4:
        s = s.where(F.col("charging_start_time").isNotNull())
    got = [r["id"] for r in dicts(op.newest_sessions(s, limit))]
    assert got == [0, 1, 2, 3][:limit]


def test_pairs_are_grouped_by_plain_names_under_a_collation(spark):
    """Groups of collated text are sorted; users of stations are too many for that. Names that tie are still ordered by the collation."""
    t = stations(spark, {"station_id": "S1", "distrito": "b"}, {"station_id": "S2", "distrito": "B"}, {"station_id": "S3", "distrito": "Á"})
    s = sessions(spark, *({"charging_station_id": f"S{k % 3 + 1}", "user_id": f"U{k}"} for k in range(6)), {"charging_station_id": "S3"}, {"charging_station_id": "S3"})
    report = op.usage_by_distrito(s, t, collation="UNICODE_CI_AI")
    plan = report._jdf.queryExecution().sparkPlan().toString()
    assert not [line for line in plan.splitlines() if "SortAggregate" in line and "user_id" in line]
    assert [(r["distrito"], r["total_sessions"], r["unique_users"]) for r in dicts(report)] == [("Á", 4, 3), ("B", 4, 4)]
