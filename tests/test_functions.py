import datetime as dt
import math
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from wattframe import fixed_values as fixed
from wattframe.functions import calendar as cal
from wattframe.functions.bands import band_of, labels_of, position_in
from wattframe.functions.geodesy import distance_km, inside_box
from wattframe.functions.rounding import mean_of_parts, published, ratio


def _values(spark, numbers, kind):
    rows = [(None if n is None else Decimal(str(n)),) for n in numbers]
    return spark.createDataFrame(rows, f"x {kind}")


# --- calendar --------------------------------------------------------------------------


def test_weeks_of_seventy_years(spark):
    first, last = dt.date(1990, 1, 1), dt.date(2060, 12, 31)
    days = spark.range((last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))
    rows = days.select(
        "d", cal.week_in_calendar_year(F.col("d")).alias("week"), cal.iso_year_week(F.col("d")).alias("iso")
    ).collect()
    assert len(rows) == 25933
    for row in rows:
        iso_year, iso_week, _ = row.d.isocalendar()
        week = 0 if iso_year < row.d.year else 53 if iso_year > row.d.year else iso_week
        assert (row.week, row.iso) == (week, iso_year * 100 + iso_week)


@pytest.mark.parametrize(
    "day,week,iso",
    [("2021-01-01", 0, 202053), ("2024-12-30", 53, 202501), ("2024-01-01", 1, 202401), ("2020-12-31", 53, 202053)],
)
def test_year_ends(spark, day, week, iso):
    d = F.lit(dt.date.fromisoformat(day))
    assert spark.range(1).select(cal.week_in_calendar_year(d), cal.iso_year_week(d)).first() == (week, iso)


def test_labels(spark):
    row = spark.range(1).select(
        cal.week_label(F.lit(2024), F.lit(5)),
        cal.month_label(F.lit(2024), F.lit(3)),
        cal.month_title(F.lit(dt.date(2024, 3, 9))),
    )
    assert row.first() == ("2024-W05", "2024-03", "March 2024")


# --- bands -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "bands,numbers,expected",
    [
        (
            fixed.DURATION_BANDS,
            ["0", "0.499", "0.5", "1", "1.001", "2", "2.001", "4", "6", "6.001", None],
            [0, 0, 1, 1, 2, 2, 3, 3, 4, 5, None],
        ),
        (
            fixed.POWER_BANDS,
            ["49.99", "50", "100", "100.01", "150", "150.01", "300", "300.01", None],
            [0, 1, 1, 2, 2, 3, 3, 4, None],
        ),
        (fixed.POWER_USAGE_BANDS, ["49.99", "50", "100", "150", "150.01", None], [0, 1, 1, 2, 3, None]),
    ],
)
def test_band_edges(spark, bands, numbers, expected):
    df = _values(spark, numbers, "decimal(8,3)")
    labels = labels_of(bands)
    got = [r[0] for r in df.select(band_of(F.col("x"), bands)).collect()]
    assert got == [None if e is None else labels[e] for e in expected]


def test_position_of_labels(spark):
    df = spark.createDataFrame([("Night",), ("Noon",), ("Morning",), (None,)], "label string")
    places = df.select(position_in(F.col("label"), fixed.TIMES_OF_DAY)).collect()
    assert [p[0] for p in places] == [4, None, 1, None]


# --- rounding --------------------------------------------------------------------------


def test_half_cents_round_up(spark):
    df = _values(spark, ["1.005", "-1.005", "2.675"], "decimal(5,3)")
    assert [r[0] for r in df.select(published(F.col("x"))).collect()] == [1.01, -1.01, 2.68]


def test_ratio_without_divisor(spark):
    df = _values(spark, ["0", None], "decimal(5,2)")
    assert [r[0] for r in df.select(ratio(F.lit(Decimal("1.00")), F.col("x"))).collect()] == [None, None]


@settings(max_examples=25, deadline=None)
@given(some.lists(some.one_of(some.none(), some.integers(0, 999999)), min_size=1, max_size=40), some.sampled_from([2, 3]))
def test_average_of_parts_is_the_average(spark, units, scale):
    rows = [(i % 3, None if u is None else Decimal(u).scaleb(-scale)) for i, u in enumerate(units)]
    df = spark.createDataFrame(rows, f"part int, x decimal({4 + scale},{scale})")
    parts = df.groupBy("part").agg(F.sum("x").alias("s"), F.count("x").alias("n"))
    whole = df.agg(published(F.avg("x"))).first()[0]
    assert parts.agg(published(mean_of_parts(F.sum("s"), F.sum("n"), scale))).first()[0] == whole


# --- distance ---------------------------------------------------------------------------


def _distance(spark, a, b):
    one = spark.range(1).select(F.lit(a[0]).alias("lat"), F.lit(a[1]).alias("lon"))
    return one.select(distance_km(F.col("lat"), F.col("lon"), *b)).first()[0]


def test_known_distances(spark):
    assert _distance(spark, (38.7, -9.1), (38.7, -9.1)) == 0
    assert _distance(spark, (0.0, 0.0), (0.0, 180.0)) == pytest.approx(math.pi * 6371)
    assert _distance(spark, (90.0, 0.0), (-90.0, 77.0)) == pytest.approx(math.pi * 6371)
    assert _distance(spark, (0.0, 0.0), (1.0, 0.0)) == pytest.approx(math.pi * 6371 / 180)


@pytest.mark.parametrize("point", [(38.7, -9.1), (0.0, 179.9), (10.0, -179.95), (89.5, 20.0), (-88.0, 0.0), (60.0, 100.0)])
@pytest.mark.parametrize("km", [1, 60, 800, 11000, 25000])
def test_box_keeps_every_near_point(spark, point, km):
    grid = spark.range(181 * 181).select(
        ((F.col("id") % 181 - 90).cast("decimal(10,7)")).alias("lat"),
        (((F.col("id") / 181).cast("int") * 2 - 180).cast("decimal(10,7)")).alias("lon"),
    )
    close = spark.range(201 * 21).select(
        (F.lit(point[0]) + (F.col("id") % 21 - 10) * 0.08).cast("decimal(10,7)").alias("lat"),
        (F.lit(point[1]) + ((F.col("id") / 21).cast("int") - 100) * 0.05).cast("decimal(10,7)").alias("lon"),
    )
    wrapped = F.when(F.col("lon") > 180, F.col("lon") - 360).when(F.col("lon") < -180, F.col("lon") + 360)
    close = close.withColumn("lon", wrapped.otherwise(F.col("lon")).cast("decimal(10,7)")).where(F.abs("lat") <= 90)
    points = grid.unionByName(close)
    lat, lon = F.col("lat"), F.col("lon")
    near = points.where(distance_km(lat, lon, *point) <= km)
    lost = near.where(~inside_box(lat, lon, *point, km))
    assert lost.count() == 0
    if km == 60 and abs(point[0]) < 80:
        boxed = grid.where(inside_box(lat, lon, *point, km))
        assert boxed.count() < 20
