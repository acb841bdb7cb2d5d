"""Times the reports and prints one JSON line.

BENCH_SF_DIR names the directory of the tables, BENCH_CPUS the number of local
cores. Sessions and stations are first stored the way the tables are stored
(timed as ``store_tables``); every report then runs on the stored tables and
its rows are written to Spark's no-op sink. File ingest and streams are timed
too, on the tables' whole content. ``value`` is the sum over all entries.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import registry, views  # noqa: E402
from wattframe import operators as op  # noqa: E402
from wattframe.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _reports(sessions, stations):
    """All reports with the arguments of the registry."""
    on_sessions = [
        op.daily_trends,
        op.weekly_trends,
        op.weekly_trends_iso,
        op.monthly_trends,
        op.monthly_trends_span,
        op.trend_comparison,
        op.hourly_distribution,
        op.total_energy_delivered,
        op.energy_by_vehicle_model,
        op.energy_by_station,
        op.daily_energy_delivered,
        op.duration_statistics,
        op.duration_distribution,
        op.duration_by_vehicle_model,
        op.duration_by_time_of_day,
        op.time_of_day_distribution,
        op.day_of_week_distribution,
        op.weekend_vs_weekday,
        op.cost_statistics,
        op.daily_cost_trends,
        op.weekly_cost_trends,
        op.monthly_cost_trends,
        op.cost_trends_by_time_of_day,
        op.usage_per_user,
        op.user_charging_frequency,
        op.user_daily_usage,
        op.top_users_ranking,
        op.station_daily_usage,
        op.station_utilization_rate,
        op.top_stations_ranking,
        op.newest_sessions,
        op.daily_overview,
    ]
    on_stations = [
        op.stations_by_distrito,
        op.stations_by_concelho,
        op.stations_by_freguesia,
        op.power_distribution,
        op.high_power_stations,
        op.connection_points_analysis,
        op.station_density_by_area,
    ]
    on_both = [
        op.usage_per_station,
        op.charging_sessions_with_location,
        op.usage_by_distrito,
        op.usage_by_concelho,
        op.stations_with_no_usage,
        op.power_vs_usage_analysis,
        op.geographic_coverage_stats,
        op.top_locations_by_revenue,
        op.table_profile,
        op.headline_figures,
    ]
    named = {f.__name__: (lambda f=f: f(sessions)) for f in on_sessions}
    named["station_peak_hours"] = lambda: op.station_peak_hours(sessions, registry.STATION)
    named |= {f.__name__: (lambda f=f: f(stations)) for f in on_stations}
    named["stations_near_coordinates"] = lambda: op.stations_near_coordinates(stations, *registry.POINT)
    named |= {f.__name__: (lambda f=f: f(sessions, stations)) for f in on_both}
    return named


def _timed(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"{folder}/checkpoints",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().collect()

    def store() -> None:
        rows = views.sessions(spark, SF_DIR).repartition(int(CPUS))
        rows.write.parquet(f"{folder}/sessions")
        views.stations(spark, SF_DIR).write.parquet(f"{folder}/stations")

    spent = {"store_tables": _timed(store)}
    sessions, stations = (spark.read.parquet(f"{folder}/{name}") for name in ("sessions", "stations"))
    for name, report in _reports(sessions, stations).items():
        spent[name] = _timed(lambda: _run(report()))
    queries = registry.queries()
    for name in (n for n in queries if n.startswith(("ingest", "loaded")) or n.endswith("_streamed")):
        if name.endswith("_padded"):  # the same work as without padding
            continue
        spent[name] = _timed(lambda: _run(queries[name](spark, SF_DIR)))
    print(
        json.dumps(
            {
                "metric": "all reports, ingest and streams",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
