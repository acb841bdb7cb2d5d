"""The stored summary of days against the reports from all sessions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattframe import operators as op
from wattframe.operators import days
from wattframe.sources import create_tables, drop_tables, keep_summary, load_sessions, open_sessions, open_summary
from wattframe.sources.day_summary import merged, open_days, refresh_days, stale_months

from .frames import dicts, sessions
from .test_tables import _line, _session_file

ODD = [
    {"user_id": "a", "charging_start_time": "2024-01-01 00:00:00", "charging_cost_eur": 0},
    {"user_id": "a", "charging_start_time": "2024-01-01 23:59:59", "charging_cost_eur": None},
    {"user_id": None, "charging_start_time": "2023-12-31 23:59:59", "energy_consumed_kwh": None},
    {"user_id": "b", "charging_start_time": "2024-12-30 10:00:00", "charging_station_id": None},
    {"user_id": "b", "charging_start_time": None, "charging_duration_hours": None},
    {"user_id": "c", "charging_start_time": None, "charging_station_id": "other"},
    {"user_id": "", "charging_start_time": "2024-02-29 10:00:00", "charging_duration_hours": 0, "energy_consumed_kwh": 0},
    {"user_id": "b", "charging_start_time": "2024-01-07 10:00:00"},
    {"user_id": "a", "charging_start_time": "2024-01-07 11:00:00"},
]


def same_reports(summary, rows):
    for report in days.REPORTS:
        assert dicts(report(summary)) == dicts(getattr(op, report.__name__)(rows)), report.__name__
    assert dicts(days.daily_overview(summary, 3)) == dicts(op.daily_overview(rows, 3))


def test_odd_sessions(spark, tmp_path):
    rows = sessions(spark, *ODD, *({"user_id": f"u{k}", "charging_start_time": "2024-01-02 10:00:00"} for k in range(200)))
    refresh_days(rows, str(tmp_path))
    same_reports(open_days(spark, str(tmp_path)), rows)


def test_nothing(spark, tmp_path):
    rows = sessions(spark).where("false")
    refresh_days(rows, str(tmp_path))
    same_reports(open_days(spark, str(tmp_path)), rows)


def test_months_are_refreshed_alone(spark, tmp_path):
    folder = str(tmp_path)
    before = sessions(spark, *ODD)
    refresh_days(before, folder)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in tmp_path.glob("days/**/*.parquet")}
    old = files()
    more = [{"user_id": "new", "charging_start_time": "2024-02-01 10:00:00"}, {"user_id": "z", "charging_start_time": None}]
    after = sessions(spark, *ODD, *more)
    refresh_days(after, folder, [dt.date(2024, 2, 1), None])
    same_reports(open_days(spark, folder), after)
    kept = {name for name in old if old[name] == files().get(name)}
    assert {n for n in old if "start_month=2024-02-01" not in n and "DEFAULT" not in n} == kept
    again = sorted(map(str, open_days(spark, folder).collect()))
    refresh_days(after, folder, [dt.date(2024, 2, 1), None])
    assert sorted(map(str, open_days(spark, folder).collect())) == again
    numbers = spark.read.parquet(f"{folder}/users").collect()
    assert sorted(r.number for r in numbers) == list(range(len(numbers))) and len({r.value for r in numbers}) == len(numbers)


def test_periods_are_merged_without_expanding(spark, tmp_path):
    refresh_days(sessions(spark, *ODD), str(tmp_path))
    plan = merged(open_days(spark, str(tmp_path)), month=F.trunc("date", "month"))._jdf.queryExecution().toString()
    assert "Expand" not in plan


@pytest.fixture
def stored(spark, tmp_path):
    drop_tables(spark)
    create_tables(spark, str(tmp_path / "tables"))
    yield
    drop_tables(spark)
    assert list((tmp_path / "tables").iterdir()) == []


def _at(day, **more):
    return _line(**{"Charging Start Time": f"{day} 10:00", "Charging End Time": f"{day} 11:00", **more})


def test_loads_keep_the_summary_up(spark, stored, tmp_path):
    load_sessions(spark, _session_file(tmp_path / "a.csv", _at("01/01/24"), _at("02/02/24", **{"User ID": "U2"})))
    assert sorted(map(str, keep_summary(spark))) == ["2024-01-01", "2024-02-01"]
    load_sessions(spark, _session_file(tmp_path / "b.csv", _at("02/02/24", **{"User ID": "U3"}), _at("03/03/24")))
    same_reports(open_summary(spark), open_sessions(spark))
    assert days.monthly_trends(open_summary(spark)).collect()[1].unique_users == 2
    assert keep_summary(spark) == []
    load_sessions(spark, _session_file(tmp_path / "c.csv", _at("05/05/24")), replace=True)
    same_reports(open_summary(spark), open_sessions(spark))


def test_a_summary_left_behind_is_found(spark, stored, tmp_path, monkeypatch):
    load_sessions(spark, _session_file(tmp_path / "a.csv", _at("01/01/24"), _at("02/02/24")))
    keep_summary(spark)
    from wattframe.sources import tables

    def broken(*_):
        raise OSError("broken")

    monkeypatch.setattr(tables, "refresh_days", broken)
    with pytest.raises(OSError):
        load_sessions(spark, _session_file(tmp_path / "b.csv", _at("02/02/24")))
    monkeypatch.undo()
    assert stale_months(spark.table("ev_charging_data"), open_summary(spark)) == [dt.date(2024, 2, 1)]
    assert keep_summary(spark) == [dt.date(2024, 2, 1)]
    same_reports(open_summary(spark), open_sessions(spark))


def test_deviation_is_the_same_however_rows_are_spread(spark):
    """Exact sums: the double at the end has the same bits for any order, and equals one computed with fractions."""
    from fractions import Fraction

    costs = [(7919 * k * k % 999_983) / 100 for k in range(3000)] + [999_999.99] * 5 + [-0.01, 0]
    rows = sessions(spark, *({"charging_cost_eur": f"{c:.2f}"} for c in costs), {"charging_cost_eur": None})
    exact = [Fraction(f"{c:.2f}") for c in costs]
    mean = sum(exact) / len(exact)
    wanted = round(float(sum((x - mean) ** 2 for x in exact) / len(exact)) ** 0.5, 2)
    found = {op.cost_statistics(rows.repartition(n)).first().cost_std_dev for n in (1, 8, 50)}
    assert found == {wanted}
    same = sessions(spark, *[{"charging_cost_eur": "999999.99"}] * 7)
    assert op.cost_statistics(same).first().cost_std_dev == 0.0


def test_words_are_stored_and_grouped_without_figures(spark, tmp_path):
    """Words are many: they have no room for the figures of a day, and their groups add up none."""
    folder = str(tmp_path)
    refresh_days(sessions(spark, *({"user_id": f"u{k}"} for k in range(200))), folder)
    stored = spark.read.parquet(f"{folder}/days")
    assert sorted(stored.columns) == ["bits", "date", "figures_of_days", "kind", "start_month", "word"]
    assert stored.where("kind <> 'parts' AND figures_of_days IS NOT NULL").isEmpty()
    plan = merged(open_days(spark, folder), month=F.trunc("date", "month"))._jdf.queryExecution().optimizedPlan().toString()
    words = [line for line in plan.splitlines() if "Aggregate" in line and "bit_or" in line]
    assert words and not any("energy_sum" in line for line in words)


def test_summary_with_figures_as_columns_is_still_read(spark, tmp_path):
    refresh_days(sessions(spark, *ODD), f"{tmp_path}/new")
    new = open_days(spark, f"{tmp_path}/new")
    new.write.partitionBy("start_month").parquet(f"{tmp_path}/old/days")
    assert sorted(map(str, open_days(spark, f"{tmp_path}/old").collect())) == sorted(map(str, new.collect()))
