"""Stored tables across processes and broken replacements."""

import os
import subprocess
import sys

import pytest

from wattframe import fixed_values as fixed
from wattframe.sources import create_tables, drop_tables, load_all, load_sessions, open_rejects, open_sessions, tables

from .test_tables import _line, _session_file

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def stored(spark, tmp_path):
    drop_tables(spark)
    create_tables(spark, str(tmp_path / "tables"))
    yield str(tmp_path / "tables")
    drop_tables(spark)


def forget(spark):
    """The state of a new process: the files are there, the catalog knows nothing."""
    for name in (fixed.SESSIONS_TABLE, fixed.STATIONS_TABLE, fixed.REJECTS_TABLE):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_another_session_finds_the_tables(spark, stored, tmp_path):
    path = _session_file(tmp_path / "s.csv", _line(), _line(**{"Charging Start Time": "31/01/24 23:59"}))
    load_sessions(spark, path)
    forget(spark)
    create_tables(spark, stored)
    assert open_sessions(spark).count() == 2
    load_sessions(spark, path)
    rows = open_sessions(spark)
    assert rows.count() == rows.select("id").distinct().count() == 4


@pytest.mark.parametrize("step", ["write", "aside", "place", "delete"])
def test_a_replacement_broken_at_any_step(spark, stored, tmp_path, monkeypatch, step):
    load_sessions(spark, _session_file(tmp_path / "a.csv", _line(), _line()))
    old = sorted(open_sessions(spark).collect())
    real = tables._files

    class Breaking:
        """A file system that fails before the given step."""

        def __init__(self, files):
            self.files, self.renames = files, 0

        def __getattr__(self, name):
            if name == "rename":
                self.renames += 1
                if (step, self.renames) in (("aside", 1), ("place", 2)):
                    raise OSError("broken")
            if name == "delete" and step == "delete":
                raise OSError("broken")
            return getattr(self.files, name)

    if step == "write":
        monkeypatch.setattr(tables, "_swap", lambda *_: (_ for _ in ()).throw(OSError("broken")))
    else:
        swap = tables._swap

        def breaking(spark, sessions):
            broken = Breaking(real(spark, sessions))
            monkeypatch.setattr(tables, "_files", lambda *_: broken)
            swap(spark, sessions)

        monkeypatch.setattr(tables, "_swap", breaking)
    with pytest.raises(OSError):
        load_sessions(spark, _session_file(tmp_path / "b.csv", _line()), replace=True)
    monkeypatch.undo()
    forget(spark)
    create_tables(spark, stored)
    found = sorted(open_sessions(spark).collect())
    assert found == old if step in ("write", "aside") else len(found) == 1
    # and loads go on
    load_sessions(spark, _session_file(tmp_path / "c.csv", _line()))
    rows = open_sessions(spark)
    assert rows.count() == rows.select("id").distinct().count() == len(found) + 1
    assert sorted(os.listdir(stored)) == sorted([fixed.SESSIONS_TABLE, fixed.STATIONS_TABLE, fixed.REJECTS_TABLE])


def test_refused_lines_are_kept(spark, stored, tmp_path):
    bad = _line(**{"Charging End Time": "never"})
    path = _session_file(tmp_path / "s.csv", _line(), bad, bad, _line() + ";x")
    counts = load_all(spark, path, _stations(tmp_path))
    assert counts[fixed.SESSIONS_TABLE] == {
        "imported": 1,
        "skipped": 3,
        "reasons": {"bad time: charging_end_time": 2, "too many fields": 1},
    }
    rows = open_rejects(spark).collect()
    assert sorted(r.reject_reason for r in rows) == ["bad time: charging_end_time"] * 2 + ["too many fields"]
    assert all(r.for_table == fixed.SESSIONS_TABLE and r.file.endswith("s.csv") for r in rows)
    assert sum('"never"' in (r.fields or "") for r in rows) == 2


def _stations(folder):
    path = folder / "stations.csv"
    path.write_text(";".join(h for h, _, _ in fixed.STATION_COLUMNS) + "\n", encoding="utf-8")
    return str(path)


def test_the_command_line_in_two_processes(tmp_path):
    sessions = _session_file(tmp_path / "s.csv", _line())

    def call(*words):
        command = [sys.executable, "-m", "wattframe", "--master", "local[2]", "--tables", str(tmp_path / "t"), *words]
        env = os.environ | {"PYTHONPATH": ROOT}
        done = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        return done.stdout

    report = ["--report", "total_energy_delivered"]
    assert "'imported': 1" in call("--sessions", sessions, *report)
    first = call(*report)
    assert "'imported': 1" in call("--sessions", sessions, *report)
    assert call(*report) != first
