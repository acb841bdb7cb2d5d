"""What loads leave on disk, and how much of it."""

import os
import time

import pytest

from checks import files, registry, views
from wattframe import fixed_values as fixed
from wattframe.plans.staging import shuffles_released
from wattframe.sources import create_tables, drop_tables, load_sessions, open_sessions, read_sessions

from . import frames
from .test_tables import _line, _session_file

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture
def stored(spark, tmp_path):
    drop_tables(spark)
    create_tables(spark, str(tmp_path / "tables"))
    yield tmp_path / "tables" / fixed.SESSIONS_TABLE
    drop_tables(spark)


def _names(folder) -> list[str]:
    return [name for _, _, found in os.walk(folder) for name in found]


def _shuffled(spark) -> set[str]:
    """Names of the files of shuffled rows that this session has."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for folder in disk.localDirsString() for name in _names(folder) if name.startswith("shuffle_")}


@pytest.mark.parametrize("replace", [False, True])
def test_a_load_leaves_no_shuffled_rows(spark, stored, tmp_path, replace):
    path = _session_file(tmp_path / "s.csv", _line(), _line(**{"Charging Start Time": "31/01/24 23:59"}))
    load_sessions(spark, path)
    before, setting = _shuffled(spark), spark.conf.get(SETTING, None)
    load_sessions(spark, path, replace=replace)
    until = time.monotonic() + 10
    while (left := _shuffled(spark) - before) and time.monotonic() < until:
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(SETTING, None) == setting
    assert open_sessions(spark).count() == (2 if replace else 4)


def test_the_setting_comes_back_after_a_failure(spark):
    spark.conf.set(SETTING, "false")
    try:
        with pytest.raises(OSError), shuffles_released(spark):
            assert spark.conf.get(SETTING) == "true"
            raise OSError("broken")
        assert spark.conf.get(SETTING) == "false"
    finally:
        spark.conf.unset(SETTING)


def test_stored_sessions_are_compressed_by_zstd(spark, stored, tmp_path):
    path = _session_file(tmp_path / "s.csv", _line())
    for replace in (False, True, False):
        load_sessions(spark, path, replace=replace)
        kept = [name for name in _names(stored) if name.endswith(".parquet")]
        assert kept and all(name.endswith(".zstd.parquet") for name in kept)


def test_packed_files_hold_the_same_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PACKED_LINES", 3)
    rows = [{"id": i, "user_id": f'U"{i};', "charging_cost_eur": None if i == 4 else i} for i in range(10)]
    lines = files.session_lines(frames.sessions(spark, *rows).coalesce(1))
    files.write(lines, str(tmp_path / "plain"))
    files.write(lines, str(tmp_path / "packed"), packed=True)
    assert sum(name.endswith(".csv.gz") for name in os.listdir(tmp_path / "packed")) == 4
    plain, packed = (read_sessions(spark, str(tmp_path / name)) for name in ("plain", "packed"))
    assert sorted(packed.counts().collect(), key=str) == sorted(plain.counts().collect(), key=str)
    assert sorted(packed.loaded.drop("_order").collect(), key=str) == sorted(plain.loaded.drop("_order").collect(), key=str)


def test_replaced_tables_loads_packed_files(spark, monkeypatch):
    rows = [{"id": i, "user_id": f"U{i % 2}"} for i in (10, 11, 12, 97 + 5)]  # the last one has an unreadable end
    monkeypatch.setattr(views, "sessions", lambda *_: frames.sessions(spark, *rows))
    monkeypatch.setattr(views, "stations", lambda *_: frames.stations(spark, {}, {"station_id": "S2"}))
    folders, new_folder = [], registry.new_folder
    monkeypatch.setattr(registry, "new_folder", lambda *a: folders.append(new_folder(*a)) or folders[-1])
    found = dict(map(tuple, registry.queries()["replaced_tables"](spark, "").collect()))
    assert (found["sessions"], found["users"], found["stations"]) == (3, 2, 2)
    for kind in ("session-files", "station-files"):
        written = [name for name in os.listdir(f"{folders[0]}/{kind}") if name.startswith("part-")]
        assert written and all(name.endswith(".csv.gz") for name in written)
