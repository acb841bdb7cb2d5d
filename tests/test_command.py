import sys

from wattframe import __main__ as command
from wattframe import fixed_values as fixed
from wattframe.sources import drop_tables

from .frames import sessions, stations
from .test_ingest import STATION_HEADERS, _changed, _file, _line


def test_text_values_become_arguments(spark):
    s, t = sessions(spark, {"user_id": "a"}, {"user_id": "b"}), stations(spark, {})
    assert command.run("user_daily_usage", {"user_id": "a"}, s, t).count() == 1
    assert command.run("hourly_distribution", {"wide": "true"}, s, t).columns[-1] == "avg_duration"
    near = {"latitude": "38.7", "longitude": "-9.1", "max_distance_km": "1"}
    assert command.run("stations_near_coordinates", near, s, t).count() == 1
    assert command.run("energy_by_station", {"limit": "1"}, s, t).count() == 1


def test_files_to_printed_report(spark, tmp_path, monkeypatch, capsys):
    drop_tables(spark)
    files = [
        _file(tmp_path / "s.csv", [_line(), _line(**{"Charging Start Time": "?"})]),
        _file(tmp_path / "t.csv", [";".join(_changed())], STATION_HEADERS),
    ]
    monkeypatch.setattr(command, "build_session", lambda master=None: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    monkeypatch.setattr(sys, "argv", ["wattframe", "--sessions", files[0], "--stations", files[1]])
    command.main()
    printed = capsys.readouterr().out
    assert "'imported': 1, 'skipped': 1" in printed
    assert "'processed': 1, 'skipped': 0, 'inserted': 1" in printed
    assert "< 50 kW (Slow)" in printed
    assert spark.catalog.tableExists(fixed.SESSIONS_TABLE)
    drop_tables(spark)
