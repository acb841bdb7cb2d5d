"""The copy of the sessions laid out by user and station: same rows, and how few of them a report on one key reads."""

import pytest
from pyspark.sql import functions as F

from wattframe import operators as op
from wattframe.sources import create_tables, drop_tables, keep_clustered, load_sessions, open_clustered, open_sessions
from wattframe.sources import tables as module
from wattframe.sources.clustered import open_clustered_folder, refresh_clustered

from .frames import dicts, sessions
from .test_tables import _line, _session_file


def rows_read(frame):
    """Rows that left the scan of a plan without a shuffle."""
    query = frame._jdf.queryExecution()
    query.toRdd().count()
    node = query.executedPlan()
    while node.children().size():
        node = node.children().head()
    return node.metrics().apply("numOutputRows").value()


def many(spark, n):
    """Users and stations by hash; one user has a third of all sessions, always at one station."""
    plain = sessions(spark, {})
    row = spark.range(n).withColumn("hot", F.col("id") % 3 == 0)
    user = F.when(F.col("hot"), "hot").otherwise(F.concat(F.lit("u"), F.pmod(F.hash("id"), F.lit(700))))
    station = F.when(F.col("hot"), "busy").otherwise(F.concat(F.lit("s"), F.pmod(F.xxhash64("id"), F.lit(500))))
    start = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).cast("timestamp_ntz")
    row = row.select("id", user.alias("user_id"), station.alias("charging_station_id"), start.alias("charging_start_time"))
    return plain.limit(0).unionByName(row, allowMissingColumns=True)


def test_one_key_reads_few_row_groups(spark, tmp_path):
    n = 40000
    rows = many(spark, n)
    refresh_clustered(rows, f"{tmp_path}/copy", group_rows=100)
    copy = open_clustered_folder(spark, f"{tmp_path}/copy")
    assert copy.count() == n and copy.select("id").distinct().count() == n
    for column, value in (("user_id", "u5"), ("user_id", "u77"), ("charging_station_id", "s8"), ("charging_station_id", "s123")):
        own = copy.where(F.col(column) == value)
        assert own.count() == rows.where(F.col(column) == value).count() > 0
        assert rows_read(own) < n / 10, (column, value)
    assert rows_read(copy.where("user_id = 'nobody'")) < n / 20
    assert dicts(op.user_daily_usage(copy, "u5")) == dicts(op.user_daily_usage(rows, "u5"))


def test_hot_user_is_split(spark, tmp_path):
    """A third of all sessions have one user and station; no task writes them all."""
    rows, small = many(spark, 20000), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")  # tiny ranges would be put together
    try:
        refresh_clustered(rows, f"{tmp_path}/copy")
    finally:
        spark.conf.unset(small)
    copy = open_clustered_folder(spark, f"{tmp_path}/copy")
    sizes = [r["count"] for r in copy.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(sizes) == 20000 and max(sizes) < 20000 / 3


def test_odd_rows_and_months(spark, tmp_path):
    """Null keys and times, repeated rows, an empty table; a month that is laid out again twice stays the same."""
    odd = [
        {"user_id": None, "charging_station_id": None},
        {"user_id": "a", "charging_start_time": None},
        {"user_id": "a", "charging_start_time": None, "id": 1},
        {"user_id": "", "charging_start_time": "2024-02-29 23:59:59"},
        {"user_id": "b", "charging_station_id": None, "charging_start_time": "2024-02-01 00:00:00"},
    ]
    rows, folder = sessions(spark, *odd), f"{tmp_path}/copy"
    refresh_clustered(rows, folder)
    for months in (None, [None], [None]):
        refresh_clustered(rows, folder, months)
        copy = open_clustered_folder(spark, folder).select(rows.columns)
        assert copy.exceptAll(rows).isEmpty() and rows.exceptAll(copy).isEmpty()
    refresh_clustered(rows.limit(0), f"{tmp_path}/none")
    assert open_clustered_folder(spark, f"{tmp_path}/none").count() == 0


def test_loads_keep_it_up(spark, tmp_path, monkeypatch):
    drop_tables(spark)
    create_tables(spark, str(tmp_path / "tables"))
    try:

        def same():
            copy, stored = open_clustered(spark), open_sessions(spark)
            return copy.columns == stored.columns and copy.exceptAll(stored).isEmpty() and stored.exceptAll(copy).isEmpty()

        def load(name, *users, **more):
            lines = [_line(**{"User ID": user}) for user in users]
            load_sessions(spark, _session_file(tmp_path / name, *lines), **more)

        load("one.csv", "a")
        assert len(keep_clustered(spark)) == 1 and same()
        load("two.csv", "b", "a")
        assert same() and open_clustered(spark).count() == 3 and keep_clustered(spark) == []

        def broken(*_):
            raise OSError("broken")

        monkeypatch.setattr(module, "refresh_clustered", broken)
        with pytest.raises(OSError, match="broken"):
            load("three.csv", "c")
        monkeypatch.undo()
        assert not same() and len(keep_clustered(spark)) == 1 and same()
        load("four.csv", "d", replace=True)
        assert same() and open_clustered(spark).count() == 1
    finally:
        drop_tables(spark)
    assert not (tmp_path / "tables" / module.CLUSTERED).exists()
