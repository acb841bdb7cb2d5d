import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wattframe import operators as op
from wattframe.plans.ranking import with_ranks
from wattframe.plans.staging import staged

from . import frames


def _check(groups, metrics):
    groups = staged(groups)
    got = with_ranks(groups, groups, {m: f"rank_{m}" for m in metrics})
    for metric in metrics:
        plain = F.rank().over(Window.orderBy(F.desc(metric)))
        wrong = got.withColumn("plain", plain).where(F.col("plain") != F.col(f"rank_{metric}"))
        assert wrong.count() == 0
    assert got.count() == groups.count()


def test_ranks_equal_the_window_function(spark):
    key = F.col("id")
    groups = spark.range(20000).select(
        key,
        (F.hash(key) % 50).alias("few_values"),
        (F.hash(key) % 1000003 * F.lit(0.01)).cast("decimal(16,2)").alias("many_values"),
        # a third of the rows share one value, some have none
        F.when(key % 3 == 0, F.lit(7)).when(key % 17 == 1, None).otherwise(key).alias("hot_value"),
        F.lit(None).cast("decimal(16,2)").alias("no_value"),
        F.lit(1).alias("one_value"),
        # beyond what a double tells apart
        (F.lit(10**17).cast("decimal(20,0)") + key % 300).alias("large_values"),
    )
    _check(groups, ["few_values", "many_values", "hot_value", "no_value", "one_value", "large_values"])


def test_ranks_of_one_row_and_none(spark):
    _check(spark.range(1).select("id", F.lit(3).alias("m")), ["m"])
    _check(spark.range(0).select("id", F.lit(3).alias("m")), ["m"])


def test_ranks_are_taken_over_all_rows_before_the_cut(spark):
    rows = [{"user_id": "busy", "charging_cost_eur": 1, "energy_consumed_kwh": None}] * 3
    rows += [{"user_id": f"rich{i}", "charging_cost_eur": 100, "energy_consumed_kwh": 5} for i in range(2)]
    top = op.top_users_ranking(frames.sessions(spark, *rows), limit=1)
    (row,) = frames.dicts(top)
    assert row["user_id"] == "busy"
    assert (row["rank_by_frequency"], row["rank_by_spending"], row["rank_by_energy"]) == (1, 3, 3)
    assert (row["total_spent"], row["total_energy"], row["avg_cost"]) == (3.0, None, 1.0)


@pytest.mark.parametrize("limit", [1, 3, 100])
def test_station_ranks_with_ties(spark, limit):
    rows = [{"charging_station_id": f"S{i % 4}", "user_id": f"U{i % 5}"} for i in range(18)]
    got = frames.dicts(op.top_stations_ranking(frames.sessions(spark, *rows), limit=limit))
    # S0 and S1 have five sessions, S2 and S3 four
    expected = [("S0", 5, 1), ("S1", 5, 1), ("S2", 4, 3), ("S3", 4, 3)][:limit]
    assert [(r["charging_station_id"], r["sessions"], r["rank_by_usage"]) for r in got] == expected


def test_ranks_and_places_with_very_many_partitions(spark):
    """One expression per slice edge, or a station row per slice, would not come to an end here."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    key = F.col("id")
    groups = staged(spark.range(30000).select(key, (F.hash(key) % 20011).alias("v"), F.when(key % 3 > 0, key).alias("w")))
    rows = [{"charging_station_id": f"S{i % 7}", "user_id": f"U{i % 11}"} for i in range(60)]
    places = [{"station_id": f"S{i}", "distrito": f"D{i % 2}"} for i in range(7)]
    usage = frames.dicts(op.usage_by_distrito(frames.sessions(spark, *rows), frames.stations(spark, *places)))
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    try:
        _check(groups, ["v", "w"])
        again = op.usage_by_distrito(frames.sessions(spark, *rows), frames.stations(spark, *places))
        assert frames.dicts(again) == usage
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
