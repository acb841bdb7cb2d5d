"""Files that are loaded once, and the overview that a stream stores."""

import pytest

from wattframe import fixed_values as fixed
from wattframe import operators as op
from wattframe import streaming as st
from wattframe.sources import create_tables, drop_tables, ledger, load_new_files, open_rejects, open_sessions, open_stations
from wattframe.streaming import overview

from .frames import dicts, sessions
from .test_tables import _line, _session_file


@pytest.fixture
def places(spark, tmp_path):
    drop_tables(spark)
    create_tables(spark, str(tmp_path / "tables"))
    for name in ("sessions", "stations"):
        (tmp_path / name).mkdir()
    header = ";".join(h for h, _, _ in fixed.STATION_COLUMNS)
    row = {"station_id": "S1", "distrito": "Lisboa"}
    line = ";".join(row.get(name, "") for _, name, _ in fixed.STATION_COLUMNS)
    (tmp_path / "stations" / "t.csv").write_text(f"{header}\n{line}\n", encoding="utf-8")
    yield tmp_path
    drop_tables(spark)


def load(spark, places, **more):
    return load_new_files(spark, str(places / "sessions"), str(places / "stations"), str(places / "ledger"), **more)


def state(spark):
    users = sorted(r.user_id for r in open_sessions(spark).collect())
    ids = open_sessions(spark).select("id")
    assert ids.distinct().count() == len(users)
    return users, open_stations(spark).count(), open_rejects(spark).count()


def _of(user, **more):
    return _line(**{"User ID": user, **more})


def test_a_load_that_breaks_at_each_step_goes_on(spark, places, monkeypatch):
    bad = {"Charging End Time": "never"}
    for k in "ab":
        _session_file(places / "sessions" / f"{k}.csv", _of(k), _of(k, **bad), _of(k, **{"Charging Start Time": "31/01/24 23:59"}))
    real = ledger.keep_rejects
    calls = []

    def breaking(*given):
        calls.append(given[-1])
        if len(calls) == 1:
            real(*given)
        raise OSError("broken")

    # the sessions and, the second time, not even the refused lines of the first batch are stored
    monkeypatch.setattr(ledger, "keep_rejects", breaking)
    for _ in range(2):
        with pytest.raises(Exception, match="broken"):
            load(spark, places, files_at_once=1)
    monkeypatch.undo()
    assert len(set(calls)) == 1
    counts = load(spark, places, files_at_once=1)
    assert counts[fixed.SESSIONS_TABLE] == {"imported": 4, "skipped": 2, "files": 2}
    assert state(spark) == (["a", "a", "b", "b"], 1, 2)

    # a repeated load takes nothing, a new file is taken alone
    assert load(spark, places) == {fixed.STATIONS_TABLE: {}, fixed.SESSIONS_TABLE: {}}
    (places / "sessions" / "deeper").mkdir()
    _session_file(places / "sessions" / "deeper" / "c.csv", _of("c"))
    counts = load(spark, places)
    assert counts[fixed.SESSIONS_TABLE] == {"imported": 1, "skipped": 0, "files": 1}
    assert state(spark) == (["a", "a", "b", "b", "c"], 1, 2)


def test_an_overview_that_breaks_goes_on(spark, tmp_path, monkeypatch):
    feed, folder, checkpoint = (str(tmp_path / n) for n in ("feed", "days", "state"))
    at = lambda day, **more: {"charging_start_time": day and f"2024-01-{day:02d} 12:00:00", **more}
    sessions(spark, *(at(d) for d in (1, 1, 2, None))).coalesce(1).write.parquet(feed)

    def run():
        stream = spark.readStream.schema(sessions(spark).schema).option("maxFilesPerTrigger", 1).parquet(feed)
        st.start_stored_overview(stream, folder, checkpoint, interval=None).awaitTermination()

    run()
    files = lambda: {str(p.relative_to(folder)) for p in (tmp_path / "days").glob("day=*/*.parquet")}
    before = files()
    sessions(spark, at(2, charging_cost_eur=None), at(3, energy_consumed_kwh=None), at(None)).coalesce(1).write.mode("append").parquet(feed)
    # the batch is stored, but the query breaks before it notes that
    writer = overview.F.lit

    def breaking(value):
        raise OSError("broken")

    monkeypatch.setattr(overview.F, "lit", breaking)
    with pytest.raises(Exception, match="broken"):
        run()
    monkeypatch.setattr(overview.F, "lit", writer)
    run()
    everything = spark.read.parquet(feed)
    assert dicts(st.stored_overview(spark, folder)) == dicts(op.daily_overview(everything))
    assert dicts(st.stored_overview(spark, folder, 2)) == dicts(op.daily_overview(everything, 2))
    # the first day has not changed, and was not written again
    assert {f for f in before if "2024-01-01" in f} <= files() and not {f for f in before if "2024-01-02" in f} & files()
    assert {str(r.date): r.batch_id for r in st.stored_days(spark, folder).collect()} == {
        "2024-01-01": 0, "2024-01-02": 1, "2024-01-03": 1, "None": 1
    }


def test_a_batch_that_comes_again_is_counted_once(spark, tmp_path):
    feed, folder, checkpoint = (str(tmp_path / n) for n in ("feed", "days", "state"))
    for _ in range(2):
        sessions(spark, {"charging_start_time": "2024-01-01 12:00:00"}, {}).coalesce(1).write.mode("append").parquet(feed)

    def run():
        stream = spark.readStream.schema(sessions(spark).schema).option("maxFilesPerTrigger", 1).parquet(feed)
        st.start_stored_overview(stream, folder, checkpoint, interval=None).awaitTermination()

    run()
    want = dicts(st.stored_days(spark, folder))
    # as if the driver had died after it stored the last batch and before it noted that
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    run()
    assert dicts(st.stored_days(spark, folder)) == want
    assert dicts(st.stored_overview(spark, folder)) == dicts(op.daily_overview(spark.read.parquet(feed)))
