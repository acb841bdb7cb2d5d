"""Every query by name: (spark, directory of the tables) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe import fixed_values as fixed
from wattframe import operators as op
from wattframe import streaming as st
from wattframe.operators import days
from wattframe.plans.staging import new_folder
from wattframe.sources import (
    create_tables,
    drop_tables,
    first_per_station,
    load_all,
    load_new_files,
    open_rejects,
    open_sessions,
    open_stations,
    query,
    read_sessions,
    read_stations,
)

from wattframe.sources.clustered import open_clustered_folder, refresh_clustered
from wattframe.sources.day_summary import open_days, refresh_days

from . import files, views

Query = Callable[[SparkSession, str], DataFrame]

USER = "U899"
STATION = "S66"
DISTRITO = "AMERICA"
CONCELHO = "NATION_11"
POINT = (38.7, -9.1, 60)
DENSE = 4
TOPIC = "topic/click"
MODEL = "1-URGENT"
DEAR = 50000
OF_DAYS = [f"{report.__name__}_of_days" for report in days.REPORTS] + ["daily_overview_of_days"]


def _sessions(report, **arguments) -> Query:
    return lambda spark, d: report(views.sessions(spark, d), **arguments)


def _stations(report, *values, **arguments) -> Query:
    return lambda spark, d: report(views.stations(spark, d), *values, **arguments)


def _both(report, **arguments) -> Query:
    return lambda spark, d: report(views.sessions(spark, d), views.stations(spark, d), **arguments)


def _mixed_spelling(stations: DataFrame) -> DataFrame:
    """Some distritos in small letters."""
    return stations.withColumn("distrito", F.when(F.col("pontos_ligacao") == 2, F.lower("distrito")).otherwise(F.col("distrito")))


def _wrapped(stations: DataFrame) -> DataFrame:
    """Some longitudes a whole turn further."""
    turned = (F.col("longitude") + 360).cast("decimal(10,7)")
    return stations.withColumn("longitude", F.when(F.col("pontos_ligacao") == 3, turned).otherwise(F.col("longitude")))


def _untimed(sessions: DataFrame) -> DataFrame:
    """Few sessions have a start time."""
    return sessions.withColumn("charging_start_time", F.when(F.col("id") % 1000 == 11, F.col("charging_start_time")))


def _newest_sessions(spark: SparkSession, d: str) -> DataFrame:
    return _doubles(op.newest_sessions(views.sessions(spark, d)))


def _doubles(df: DataFrame) -> DataFrame:
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in decimals})


# --- streams: run over all present input, then read what was written ----------------------


def _streamed_overview(spark: SparkSession, d: str) -> DataFrame:
    folder = new_folder(spark, "overview")
    name = "overview_" + folder.rsplit("-", 1)[1]
    st.start_daily_overview(views.streamed_sessions(spark, d), name, folder, interval=None).awaitTermination()
    return spark.table(name)


def _stored_overview(spark: SparkSession, d: str) -> DataFrame:
    """Sessions come in about the order of time, as two batches of one query and two of its restart; the table is read afterwards."""
    folder = new_folder(spark, "stored-overview")
    sessions = views.sessions(spark, d).select("id", "charging_start_time", "energy_consumed_kwh", "charging_cost_eur")
    late = F.year("charging_start_time") >= 1996
    # a batch has as many files as half the shuffle partitions, each written by a task of its own
    at_once = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    for part in (F.coalesce(~late, F.lit(True)), late):
        dealt = sessions.where(part).repartitionByRange(2 * at_once, "charging_start_time")
        dealt.write.mode("append").parquet(f"{folder}/feed")
        feed = spark.readStream.schema(sessions.schema).option("maxFilesPerTrigger", at_once).parquet(f"{folder}/feed")
        st.start_stored_overview(feed, f"{folder}/days", f"{folder}/state", interval=None).awaitTermination()
    return st.stored_overview(spark, f"{folder}/days")


def _appended(spark: SparkSession, result: DataFrame) -> DataFrame:
    folder = new_folder(spark, "stream")
    writer = result.writeStream.outputMode("append").format("parquet").trigger(availableNow=True)
    writer.option("checkpointLocation", f"{folder}/state").start(f"{folder}/rows").awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{folder}/rows")


def _on_events(report, **arguments) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _appended(spark, report(views.sessions_from_events(views.streamed(spark, d, "events")), **arguments))

    return run


def _with_closed_days(spark: SparkSession, d: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """Every tenth event comes when all others are through, most of them after their day was closed; the stream restarts twice."""
    folder = new_folder(spark, "closed-days")
    database = "checks_" + folder.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/tables'")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        create_tables(spark)
        events, held = views.table(spark, d, "events"), F.col("event_id") % 10 == 3
        early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
        for part in (~held & early, ~held & ~early, held):
            events.where(part).write.mode("append").parquet(f"{folder}/feed")
            feed = spark.readStream.schema(events.schema).parquet(f"{folder}/feed")
            sessions = views.sessions_from_events(feed)
            st.start_closed_days(sessions, f"{folder}/days", f"{folder}/state", interval=None).awaitTermination()
        return read(f"{folder}/days")
    finally:
        spark.catalog.setCurrentDatabase(before)


def _late_kept(spark: SparkSession, d: str) -> DataFrame:
    def read(folder: str) -> DataFrame:
        start = F.get_json_object("fields", "$.charging_start_time")
        late = open_rejects(spark).groupBy(F.to_date(F.substring(start, 1, 10)).alias("date"))
        found = st.closed_days(spark, folder).join(late.agg(F.count(F.lit(1)).alias("late")), "date", "left")
        return found.withColumn("late", F.coalesce("late", F.lit(0)))

    return _with_closed_days(spark, d, read)


def _users_of_closed_days(spark: SparkSession, d: str) -> DataFrame:
    """Per day, week and month the exact users on closed days, and whether the stored sketches tell them within three times their error."""
    events, held = views.table(spark, d, "events"), F.col("event_id") % 10 == 3
    last, in_time = events.agg(F.max("ts"), F.max(F.when(~held, F.col("ts")))).first()
    over = F.date_add(F.to_date("ts"), 1).cast("timestamp_ntz") + F.expr("INTERVAL 1 hour")
    counted = events.where((over <= F.lit(last)) & ~(held & (over <= F.lit(in_time))))
    days = counted.select(F.to_date("ts").alias("date"), "user_id").distinct()

    def period(folder: str, by: str) -> DataFrame:
        first = F.col("date") if by == "day" else F.trunc("date", by)
        exact = days.groupBy(first.alias("first_day")).agg(
            F.count_distinct("date").alias("days"), F.count_distinct("user_id").alias("unique_users")
        )
        guess = st.closed_users(spark, folder, by).withColumnRenamed("unique_users", "estimate")
        near = F.abs(F.col("estimate") - F.col("unique_users")) <= F.col("unique_users") * (3 * st.users_error())
        both = guess.join(exact, ["first_day", "days"], "full")
        return both.select(F.lit(by).alias("period"), "first_day", "days", "unique_users", near.cast("int").alias("estimate_is_near"))

    def read(folder: str) -> DataFrame:
        return period(folder, "day").union(period(folder, "week")).union(period(folder, "month"))

    return _with_closed_days(spark, d, read)


def _messages(spark: SparkSession, d: str) -> DataFrame:
    decoded = st.messages_of(views.messages_from_events(views.streamed(spark, d, "events")), TOPIC).drop("undecoded")
    # an instant is compared as local time
    return _appended(spark, decoded.withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def _bad_messages(spark: SparkSession, d: str) -> DataFrame:
    """Some payloads are not UTF-8; these come without a message, as they were."""
    events = views.streamed(spark, d, "events")
    decoded = st.messages_of(views.messages_from_events(events, spoilt=F.col("event_id") % 7 == 0), TOPIC)
    shown = decoded.select("topic", "message", F.col("ts").cast("timestamp_ntz").alias("ts"), F.hex("undecoded").alias("undecoded"))
    return _appended(spark, shown)


def _estimate_checked(spark: SparkSession, d: str) -> DataFrame:
    """Per day the exact users, and whether the estimate is within three times its stated error."""
    error = 0.05
    exact = _on_events(st.daily_users)(spark, d)
    guess = _on_events(st.daily_users_estimate, error=error)(spark, d).withColumnRenamed("unique_users", "estimate")
    near = F.abs(F.col("estimate") - F.col("unique_users")) <= F.col("unique_users") * (3 * error)
    return exact.join(guess, "date").select("date", "unique_users", near.cast("int").alias("estimate_is_near"))


def _chart(spark: SparkSession, d: str) -> DataFrame:
    """The chart arrays, unfolded to one row per series and label."""
    chart = st.chart_series(op.daily_overview(views.sessions(spark, d)))
    lines = chart.select("labels", F.explode(F.arrays_zip("series", "data")).alias("line"))
    points = lines.select("line.series", F.explode(F.arrays_zip("labels", F.col("line.data").alias("values"))).alias("p"))
    return points.select("series", F.col("p.labels").alias("label"), F.col("p.values").alias("value"))


# --- files: the tables written as separated text, then read back ---------------------------


def _read_session_files(spark: SparkSession, d: str):
    folder = new_folder(spark, "session-files")
    files.write(files.session_lines(views.sessions(spark, d)), folder)
    return read_sessions(spark, folder)


def _ingested_sessions(spark: SparkSession, d: str) -> DataFrame:
    return _doubles(_read_session_files(spark, d).loaded.drop("_order"))


def _ingest_outcome(spark: SparkSession, d: str) -> DataFrame:
    return _read_session_files(spark, d).counts()


def _ragged_outcome(spark: SparkSession, d: str) -> DataFrame:
    """Lines that end early and lines with a field too many: what is loaded, what is refused, and which ages are missing."""
    folder = new_folder(spark, "ragged-files")
    sessions = views.sessions(spark, d)
    key = F.col("_key")
    lines = files.session_lines(sessions.withColumn("_key", F.col("id")), "_key")
    files.write_ragged(lines, folder, short=key % 37 == 7, long=key % 41 == 9)
    lines = read_sessions(spark, folder).lines
    missing = F.count_if(F.col("vehicle_age_years").isNull()).alias("without_age")
    return lines.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("lines"), missing)


def _ingested_stations(spark: SparkSession, d: str) -> DataFrame:
    folder = new_folder(spark, "station-files")
    stations = views.stations(spark, d)
    files.write(files.station_lines(stations), f"{folder}/1-first")
    files.write(files.station_lines(files.altered(stations)), f"{folder}/2-copies")
    parsed = read_stations(spark, [f"{folder}/1-first", f"{folder}/2-copies"])
    kept = first_per_station(parsed.loaded)
    return _doubles(kept.withColumn("warnings", F.array_join("warnings", ",")))


def _padded_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Values with white space of many kinds around them, and empty lines' worth of it."""
    lines = files.session_lines(views.sessions(spark, d))
    around = {"charging_station_id": "{}\u00a0", "charging_cost_eur": "\u00a0{}\u2003", "time_of_day": "\u3000{}\u0085"}
    around |= {"user_id": "\u2009{}", "vehicle_model": "{}\u202f"}
    padded = {name: F.concat(F.lit(how.split("{}")[0]), name, F.lit(how.split("{}")[1])) for name, how in around.items()}
    folder = new_folder(spark, "padded-files")
    files.write(lines.withColumns(padded), folder)
    return _doubles(read_sessions(spark, folder).loaded.drop("_order"))


def _stored(spark: SparkSession, d: str, work, packed: bool = False) -> DataFrame:
    """Files for both tables in a database of their own; ``work`` loads them and says what is seen there."""
    folder = new_folder(spark, "load")
    files.write(files.session_lines(views.sessions(spark, d)), f"{folder}/session-files", packed)
    files.write(files.station_lines(views.stations(spark, d)), f"{folder}/station-files", packed)
    database = "checks_" + folder.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/tables'")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        return work(f"{folder}/session-files", f"{folder}/station-files")
    finally:
        spark.catalog.setCurrentDatabase(before)


def _loaded_tables(spark: SparkSession, d: str) -> DataFrame:
    """Files to stored tables, then the profile of the tables."""

    def work(sessions, stations):
        load_all(spark, sessions, stations)
        return op.table_profile(open_sessions(spark), open_stations(spark))

    return _stored(spark, d, work)


def _replaced_tables(spark: SparkSession, d: str) -> DataFrame:
    """Loaded twice, the second time in place of the first, and opened as by another process; the files are compressed."""

    def work(sessions, stations):
        load_all(spark, sessions, stations)
        load_all(spark, sessions, stations, replace=True)
        for name in (fixed.SESSIONS_TABLE, fixed.STATIONS_TABLE, fixed.REJECTS_TABLE):
            spark.sql(f"DROP TABLE {name}")
        create_tables(spark)
        return op.table_profile(open_sessions(spark), open_stations(spark))

    return _stored(spark, d, work, packed=True)


def _recreated_tables(spark: SparkSession, d: str) -> DataFrame:
    """Loaded, dropped, created and loaded: nothing of the first load is left."""

    def work(sessions, stations):
        load_all(spark, sessions, stations)
        drop_tables(spark)
        create_tables(spark)
        load_all(spark, sessions, stations)
        return op.table_profile(open_sessions(spark), open_stations(spark))

    return _stored(spark, d, work)


def _files_taken_once(spark: SparkSession, d: str) -> DataFrame:
    """All files but one, the same folder again, and once more with the file that was missing."""

    def work(sessions, stations):
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path
        store = path(sessions).getFileSystem(context._jsc.hadoopConfiguration())
        names = [s.getPath() for s in store.listStatus(path(sessions)) if s.getPath().getName().endswith(".csv")]
        late, ledger = path(f"{sessions}-late.csv"), f"{sessions}-ledger"
        store.rename(names[0], late)
        for _ in range(2):
            load_new_files(spark, sessions, stations, ledger)
        store.rename(late, names[0])
        load_new_files(spark, sessions, stations, ledger)
        return op.table_profile(open_sessions(spark), open_stations(spark))

    return _stored(spark, d, work)


def _rejected_lines(spark: SparkSession, d: str) -> DataFrame:
    """The refused lines that a load has kept, by reason."""

    def work(sessions, stations):
        load_all(spark, sessions, stations)
        return open_rejects(spark).groupBy("for_table", "reject_reason").agg(F.count(F.lit(1)).alias("lines"))

    return _stored(spark, d, work)


# --- the stored summary of days --------------------------------------------------------------

_SUMMARIES: dict[tuple[str, str], str] = {}


def _summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary of all sessions, stored once per application; its last months are refreshed a second time."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SUMMARIES:
        folder = new_folder(spark, "day-summary")
        sessions = views.sessions(spark, d)
        refresh_days(sessions, folder)
        months = open_days(spark, folder).select("start_month").distinct().orderBy(F.desc("start_month")).limit(2)
        refresh_days(sessions, folder, [row[0] for row in months.collect()])
        _SUMMARIES[key] = folder
    return open_days(spark, _SUMMARIES[key])


def _from_days(report) -> Query:
    return lambda spark, d: report(_summary(spark, d))


# --- SQL text with bound values ----------------------------------------------------------------


_COPIES: dict[tuple[str, str], str] = {}


def _clustered(spark: SparkSession, d: str) -> DataFrame:
    """A copy of all sessions laid out by user and station, stored once per application; every February is laid out a second time."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _COPIES:
        folder = new_folder(spark, "clustered")
        sessions = views.sessions(spark, d)
        refresh_clustered(sessions, folder)
        month = F.trunc(F.to_date("charging_start_time"), "month")
        months = sessions.where(F.month(month) == 2).select(month).distinct()
        refresh_clustered(sessions, folder, [row[0] for row in months.collect()])
        _COPIES[key] = folder
    return open_clustered_folder(spark, _COPIES[key])


def _from_clustered(report, **arguments) -> Query:
    return lambda spark, d: report(_clustered(spark, d), **arguments)


def _bound_query(spark: SparkSession, d: str) -> DataFrame:
    text = """
        SELECT charging_station_id, count(*) AS sessions, CAST(max(charging_cost_eur) AS DOUBLE) AS dearest
        FROM {sessions} WHERE vehicle_model = :model AND charging_cost_eur >= :least GROUP BY charging_station_id
    """
    return query(spark, text, {"model": MODEL, "least": DEAR}, sessions=views.sessions(spark, d))


def queries() -> dict[str, Query]:
    return {
        # over time
        "daily_trends": _sessions(op.daily_trends),
        "weekly_trends": _sessions(op.weekly_trends),
        "weekly_trends_iso": _sessions(op.weekly_trends_iso),
        "monthly_trends": _sessions(op.monthly_trends),
        "monthly_trends_span": _sessions(op.monthly_trends_span),
        "trend_comparison": _sessions(op.trend_comparison),
        "hourly_distribution": _sessions(op.hourly_distribution),
        "hourly_distribution_wide": _sessions(op.hourly_distribution, wide=True),
        # energy
        "total_energy_delivered": _sessions(op.total_energy_delivered),
        "energy_by_vehicle_model": _sessions(op.energy_by_vehicle_model),
        "energy_by_station": _sessions(op.energy_by_station),
        "daily_energy_delivered": _sessions(op.daily_energy_delivered),
        # duration
        "duration_statistics": _sessions(op.duration_statistics),
        "duration_distribution": _sessions(op.duration_distribution),
        "duration_by_vehicle_model": _sessions(op.duration_by_vehicle_model),
        "duration_by_time_of_day": _sessions(op.duration_by_time_of_day),
        # over the day and week
        "time_of_day_distribution": _sessions(op.time_of_day_distribution),
        "day_of_week_distribution": _sessions(op.day_of_week_distribution),
        "weekend_vs_weekday": _sessions(op.weekend_vs_weekday),
        # cost
        "cost_statistics": _sessions(op.cost_statistics),
        "daily_cost_trends": _sessions(op.daily_cost_trends),
        "weekly_cost_trends": _sessions(op.weekly_cost_trends),
        "monthly_cost_trends": _sessions(op.monthly_cost_trends),
        "cost_trends_by_time_of_day": _sessions(op.cost_trends_by_time_of_day),
        # users
        "usage_per_user": _sessions(op.usage_per_user),
        "usage_per_user_chart": lambda spark, d: op.usage_per_user(views.sessions(spark, d)).limit(fixed.CHART_ROWS),
        "user_charging_frequency": _sessions(op.user_charging_frequency),
        "user_daily_usage": _sessions(op.user_daily_usage),
        "user_daily_usage_of_one": _sessions(op.user_daily_usage, user_id=USER),
        "top_users_ranking": _sessions(op.top_users_ranking),
        # stations
        "usage_per_station": _both(op.usage_per_station),
        "station_daily_usage": _sessions(op.station_daily_usage),
        "station_daily_usage_of_one": _sessions(op.station_daily_usage, station_id=STATION),
        "station_utilization_rate": _sessions(op.station_utilization_rate),
        "top_stations_ranking": _sessions(op.top_stations_ranking),
        "station_peak_hours": _sessions(op.station_peak_hours, station_id=STATION),
        # geography
        "stations_by_distrito": _stations(op.stations_by_distrito),
        "stations_by_distrito_chart": lambda spark, d: op.stations_by_distrito(views.stations(spark, d)).limit(fixed.CHART_ROWS),
        "stations_by_concelho": _stations(op.stations_by_concelho),
        "stations_by_concelho_in_distrito": _stations(op.stations_by_concelho, distrito=DISTRITO),
        "stations_by_concelho_any_case": _stations(
            op.stations_by_concelho, distrito=DISTRITO.lower(), collation="UNICODE_CI_AI"
        ),
        "stations_by_freguesia": _stations(op.stations_by_freguesia),
        "stations_by_freguesia_in_concelho": _stations(op.stations_by_freguesia, concelho=CONCELHO),
        "power_distribution": _stations(op.power_distribution),
        "high_power_stations": _stations(op.high_power_stations),
        "connection_points_analysis": _stations(op.connection_points_analysis),
        "stations_near_coordinates": _stations(op.stations_near_coordinates, *POINT),
        "stations_near_coordinates_wrapped": lambda spark, d: op.stations_near_coordinates(
            _wrapped(views.stations(spark, d)), *POINT
        ),
        "stations_near_coordinates_all": _stations(op.stations_near_coordinates, *POINT[:2], 400, limit=None),
        "stations_by_distrito_any_spelling": lambda spark, d: op.stations_by_distrito(
            _mixed_spelling(views.stations(spark, d)), collation="UNICODE_CI_AI"
        ),
        "station_density_by_area": _stations(op.station_density_by_area),
        "station_density_by_area_from_4": _stations(op.station_density_by_area, min_stations=DENSE),
        # sessions at stations
        "charging_sessions_with_location": _both(op.charging_sessions_with_location),
        "usage_by_distrito": _both(op.usage_by_distrito),
        "usage_by_concelho": _both(op.usage_by_concelho),
        "usage_by_concelho_all": _both(op.usage_by_concelho, limit=None),
        "usage_by_distrito_any_spelling": lambda spark, d: op.usage_by_distrito(
            views.sessions(spark, d), _mixed_spelling(views.stations(spark, d)), collation="UNICODE_CI_AI"
        ),
        "usage_by_concelho_in_distrito": _both(op.usage_by_concelho, distrito=DISTRITO),
        "stations_with_no_usage": _both(op.stations_with_no_usage),
        "power_vs_usage_analysis": _both(op.power_vs_usage_analysis),
        "geographic_coverage_stats": _both(op.geographic_coverage_stats),
        "top_locations_by_revenue": _both(op.top_locations_by_revenue),
        # whole tables
        "table_profile": _both(op.table_profile),
        "headline_figures": _both(op.headline_figures),
        "newest_sessions": _newest_sessions,
        "newest_sessions_untimed": lambda spark, d: _doubles(op.newest_sessions(_untimed(views.sessions(spark, d)))),
        "daily_overview": _sessions(op.daily_overview),
        "daily_overview_chart": _chart,
        # streams
        "daily_overview_streamed": _streamed_overview,
        "daily_overview_stored": _stored_overview,
        "daily_windows_streamed": _on_events(st.daily_windows),
        "closed_days_with_late_sessions": _late_kept,
        "closed_users_by_period": _users_of_closed_days,
        "daily_users_streamed": _on_events(st.daily_users),
        "daily_users_estimate_streamed": _on_events(st.daily_users_estimate),
        "daily_users_estimate_checked": _estimate_checked,
        "messages_streamed": _messages,
        "messages_streamed_with_bad_payloads": _bad_messages,
        # files
        "ingested_sessions": _ingested_sessions,
        "ingest_outcome": _ingest_outcome,
        "ragged_lines_outcome": _ragged_outcome,
        "ingested_stations": _ingested_stations,
        "ingested_sessions_padded": _padded_sessions,
        "loaded_tables": _loaded_tables,
        "replaced_tables": _replaced_tables,
        "recreated_tables": _recreated_tables,
        "rejected_lines": _rejected_lines,
        "files_taken_once": _files_taken_once,
        # from the stored summary of days
        **{f"{report.__name__}_of_days": _from_days(report) for report in days.REPORTS},
        "daily_overview_of_days": _from_days(lambda summary: days.daily_overview(summary, fixed.OVERVIEW_DAYS)),
        # SQL text
        "user_daily_usage_clustered": _from_clustered(op.user_daily_usage, user_id=USER),
        "station_daily_usage_clustered": _from_clustered(op.station_daily_usage, station_id=STATION),
        "station_peak_hours_clustered": _from_clustered(op.station_peak_hours, station_id=STATION),
        "bound_query": _bound_query,
    }
