"""Rows at the edges: odd coordinates, no start times, white space, spellings, spoilt messages."""

import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from wattframe import operators as op
from wattframe import streaming as st
from wattframe.sources import read_sessions

from .frames import sessions, stations
from .test_ingest import _file, _line


def _km(lat, lon, at_lat, at_lon):
    a, b, c, d = map(math.radians, (lat, lon, at_lat, at_lon))
    chord = math.sin((a - c) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((b - d) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(min(1, chord)))


@pytest.mark.parametrize("point", [(38.7, -9.1), (0.1, 179.9), (-89.5, 20), (89.9, -170), (38.7, 350.9), (10, -180)])
def test_no_station_in_reach_is_lost(spark, point):
    rng = random.Random(str(point))
    places = [(38.7, 350.9), (38.7, -369.1), (141.3, 170.9)]
    for _ in range(300):
        lat = point[0] + rng.uniform(-3, 3)
        places.append((round(lat, 4), round(point[1] + rng.uniform(-8, 8) + rng.choice([0, 0, 360, -360]), 4)))
    rows = [{"station_id": f"s{k}", "latitude": a, "longitude": b} for k, (a, b) in enumerate(places)]
    got = op.stations_near_coordinates(stations(spark, *rows), *point, max_distance_km=250, limit=None)
    want = {f"s{k}" for k, (a, b) in enumerate(places) if round(_km(a, b, *point), 2) <= 250}
    assert {r.station_id for r in got.collect()} == want


def test_sessions_without_a_start_come_last(spark):
    rows = [{"id": k, "charging_start_time": f"2024-03-0{k} 08:00:00"} for k in (1, 2, 3)]
    table = sessions(spark, *rows, {"id": 4}).withColumn(
        "charging_start_time", F.when(F.col("id") != 4, F.col("charging_start_time"))
    )
    assert [r.id for r in op.newest_sessions(table).collect()] == [3, 2, 1, 4]
    assert [r.id for r in op.newest_sessions(table, 3).collect()] == [3, 2, 1]
    assert [r.id for r in op.newest_sessions(table, 2).collect()] == [3, 2]
    assert op.newest_sessions(table.where("id = 4"), 2).count() == 1


def test_reports_without_a_limit(spark):
    rows = [{"station_id": f"s{k}", "concelho": f"c{k}", "freguesia": f"f{k}"} for k in range(70)]
    table = stations(spark, *rows)
    assert op.stations_by_concelho(table).count() == op.stations_by_freguesia(table).count() == 50
    assert op.stations_by_concelho(table, limit=None).count() == op.stations_by_freguesia(table, limit=None).count() == 70
    assert op.station_density_by_area(table, 1).count() == 30
    assert op.station_density_by_area(table, 1, limit=None).count() == 70


def test_the_smallest_spelling_is_reported(spark):
    names = ["Évora", "evora", "EVORA"]
    for order in itertools.permutations(names):
        rows = [{"station_id": f"s{k}", "distrito": n, "concelho": n} for k, n in enumerate(order)]
        table = stations(spark, *rows).coalesce(1)
        (row,) = op.stations_by_concelho(table, collation="UNICODE_CI_AI").collect()
        assert (row.distrito, row.concelho, row.total_stations) == ("EVORA", "EVORA", 3)


def test_white_space_of_any_kind_goes(spark, tmp_path):
    line = _line(**{"Charging Station ID": "S1 ", "Charging Cost (EUR)": " 3,25 ", "Time of Day": '"\tNight　"'})
    (row,) = read_sessions(spark, _file(tmp_path / "s.csv", [line])).loaded.collect()
    assert (row.charging_station_id, str(row.charging_cost_eur), row.time_of_day) == ("S1", "3.25", "Night")


def test_a_spoilt_payload_stops_no_stream(spark, tmp_path):
    rows = [("topic/hello", p, dt.datetime(2024, 1, k + 1)) for k, p in enumerate([b"a", b"\xff\xfe", None, "é".encode()])]
    table = spark.createDataFrame(rows, "topic string, payload binary, ts timestamp")
    for part in (0, 1):
        table.write.mode("append").parquet(str(tmp_path / "in"))
        feed = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
        writer = st.messages_of(feed).writeStream.format("parquet").trigger(availableNow=True)
        writer.option("checkpointLocation", str(tmp_path / "state")).start(str(tmp_path / "out")).awaitTermination()
        got = spark.read.parquet(str(tmp_path / "out")).orderBy("ts").collect()
        assert len(got) == 4 * (part + 1)
    assert [(r.message, r.undecoded) for r in got[::2]] == [("a", None), (None, b"\xff\xfe"), (None, None), ("é", None)]
