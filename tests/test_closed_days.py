"""Days that close behind a stream, late sessions, and batches that come twice."""

import json

import pytest
from pyspark.sql import functions as F

from wattframe import streaming as st
from wattframe.sources import create_tables, drop_tables, open_rejects
from wattframe.streaming import closing as module

from .frames import dicts, sessions

FIRST = [{"charging_start_time": "2024-03-01 08:00:00"}, {"charging_start_time": "2024-03-02 00:30:00"}]
SECOND = [
    {"charging_start_time": "2024-03-01 23:00:00"},  # the day is over, but not by an hour
    {"charging_start_time": "2024-03-02 01:00:00", "charging_cost_eur": None},
    {"charging_start_time": None},
]
THIRD = [{"charging_start_time": "2024-03-01 09:00:00", "user_id": "late"}, {"charging_start_time": "2024-03-02 09:00:00"}]


@pytest.fixture
def tables(spark, tmp_path):
    drop_tables(spark)
    create_tables(spark, str(tmp_path / "tables"))
    yield
    drop_tables(spark)


def feed(spark, folder, *rows):
    batch = sessions(spark, *rows)
    batch.coalesce(1).write.mode("append").parquet(f"{folder}/feed")
    stream = spark.readStream.schema(batch.schema).parquet(f"{folder}/feed")
    st.start_closed_days(stream, f"{folder}/days", f"{folder}/state", interval=None).awaitTermination()


def test_late_sessions_are_kept(spark, tables, tmp_path, monkeypatch):
    folder = str(tmp_path)
    feed(spark, folder, *FIRST)
    assert dicts(st.closed_days(spark, f"{folder}/days")) == []

    # broken before the mark: nothing of the batch counts until it has come again
    put = module._put

    def broken(rows, place, *parts):
        if place.endswith("/marks"):
            raise OSError("broken")
        put(rows, place, *parts)

    monkeypatch.setattr(module, "_put", broken)
    with pytest.raises(Exception, match="broken"):
        feed(spark, folder, *SECOND)
    monkeypatch.undo()
    opened = st.closed_days(spark, f"{folder}/days", still_open=True)
    assert sum(r.total_sessions for r in opened.collect()) == 2
    feed(spark, folder, *THIRD)

    days = {str(r.date): r for r in st.closed_days(spark, f"{folder}/days").collect()}
    assert list(days) == ["2024-03-01"] and days["2024-03-01"].total_sessions >= 2
    every = {str(r.date): r.total_sessions for r in st.closed_days(spark, f"{folder}/days", still_open=True).collect()}
    rejects = open_rejects(spark).collect()
    assert sum(every.values()) + len(rejects) == len(FIRST + SECOND + THIRD)
    assert sorted(r.reject_reason for r in rejects) == sorted([module.UNTIMED, module.LATE])
    late = next(json.loads(r.fields) for r in rejects if r.reject_reason == module.LATE)
    assert late["user_id"] == "late" and late["charging_start_time"].startswith("2024-03-01")
    assert every == {"2024-03-01": 2, "2024-03-02": 3}


def test_nothing_stored_yet(spark, tmp_path):
    assert dicts(st.closed_days(spark, f"{tmp_path}/days")) == []
    assert dicts(st.closed_users(spark, f"{tmp_path}/days", by="month")) == []


def test_users_of_united_days(spark, tables, tmp_path):
    """A user of several days and batches counts once in a period; null is nobody; late sessions add none."""
    folder = str(tmp_path)

    def at(day, *users):
        return [{"charging_start_time": f"2024-{day} 10:00:00", "user_id": user} for user in users]

    feed(spark, folder, *at("02-29", "a", "b", None), *at("03-01", "a"))
    feed(spark, folder, *at("03-01", "c", "c"), *at("03-02", None), *at("03-04", "d"), *at("03-05", "e"))
    feed(spark, folder, *at("03-01", "late"))

    def users(by, **more):
        rows = st.closed_users(spark, f"{folder}/days", by, **more).collect()
        return {str(r.first_day): (r.days, r.unique_users) for r in rows}

    assert users("day") == {"2024-02-29": (1, 2), "2024-03-01": (1, 2), "2024-03-02": (1, 0), "2024-03-04": (1, 1)}
    assert users("week") == {"2024-02-26": (3, 3), "2024-03-04": (1, 1)}
    assert users("month") == {"2024-02-01": (1, 2), "2024-03-01": (3, 3)}
    assert users("year") == {"2024-01-01": (4, 4)}
    assert users("year", still_open=True) == {"2024-01-01": (5, 5)}
    with pytest.raises(ValueError, match="hour"):
        st.closed_users(spark, f"{folder}/days", by="hour")


def test_sketches_stay_within_their_error(spark, tables, tmp_path):
    """Many users on two days each, sketches of two precisions, and a part that was stored without one."""
    folder = str(tmp_path)
    users = spark.range(30000).select(F.concat(F.lit("u"), "id").alias("user_id"), "id")
    start = F.when(F.col("id") % 3 == 0, "2024-03-01 10:00:00").otherwise("2024-03-02 10:00:00").cast("timestamp_ntz")
    many = users.select("user_id", start.alias("charging_start_time"))
    many = many.union(many.select("user_id", F.lit("2024-03-03 10:00:00").cast("timestamp_ntz")))
    plain = sessions(spark, {"charging_start_time": "2024-03-09 08:00:00"})
    rows = plain.limit(0).unionByName(many, allowMissingColumns=True)
    for batch, precision in ((rows, 12), (plain, 10)):
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/feed")
        stream = spark.readStream.schema(plain.schema).parquet(f"{folder}/feed")
        st.start_closed_days(stream, f"{folder}/days", f"{folder}/state", interval=None, precision=precision).awaitTermination()
    found = {r.first_day.day: r.unique_users for r in st.closed_users(spark, f"{folder}/days").collect()}
    for day, exact in ((1, 10000), (2, 20000), (3, 30000)):
        assert abs(found[day] - exact) <= 3 * st.users_error(12) * exact
    month = st.closed_users(spark, f"{folder}/days", by="month", still_open=True).first()
    assert month.days == 4 and abs(month.unique_users - 30001) <= 3 * st.users_error(10) * 30001

    old = spark.read.parquet(f"{folder}/days/parts").where("date = '2024-03-01'").drop("users")
    old = old.withColumn("date", F.lit("2024-02-01")).withColumn("batch_id", F.lit(0))
    old.write.mode("append").partitionBy("date", "batch_id").parquet(f"{folder}/days/parts")
    months = {r.first_day.month: r.unique_users for r in st.closed_users(spark, f"{folder}/days", by="month").collect()}
    assert months[2] is None and months[3] is not None
