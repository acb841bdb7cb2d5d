"""Where stations are and how places are used."""

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.bands import band_of, labels_of, position_in
from ..functions.geodesy import distance_km, inside_box
from ..functions.rounding import count_as_decimal, mean_of_parts, published, ratio
from ..plans import measures as m
from ..plans.locations import collated, locate, locate_spread, per_station, plain
from ..plans.shares import share_of_bands, share_of_rows

# --- stations alone -----------------------------------------------------------------


def _points(name: str = "total_connection_points") -> Column:
    return F.sum(m.POINTS).alias(name)


def stations_by_distrito(stations: DataFrame, collation: str | None = None) -> DataFrame:
    """Stations, power and connection points per distrito."""
    areas = collated(stations, collation).groupBy("distrito").agg(
        m.rows("total_stations"),
        m.mean(m.POWER, "avg_power_kw"),
        m.lowest(m.POWER, "min_power_kw"),
        m.highest(m.POWER, "max_power_kw"),
        _points(),
    )
    ranked = m.ranked_by(areas, "total_stations", "distrito")
    return plain(ranked, collation)


def stations_by_concelho(
    stations: DataFrame,
    distrito: str | None = None,
    collation: str | None = None,
    limit: int | None = fixed.TOP_ROWS,
) -> DataFrame:
    """Stations per concelho: all of one distrito, or the largest of the country (without a limit all)."""
    stations = collated(stations, collation)
    if distrito:
        stations = stations.where(F.col("distrito") == F.lit(distrito))
    areas = stations.groupBy("distrito", "concelho").agg(
        m.rows("total_stations"), m.mean(m.POWER, "avg_power_kw"), _points()
    )
    limit = None if distrito else limit
    ranked = m.ranked_by(areas, "total_stations", "distrito", "concelho", limit=limit)
    return plain(ranked, collation)


def stations_by_freguesia(
    stations: DataFrame,
    concelho: str | None = None,
    collation: str | None = None,
    limit: int | None = fixed.TOP_ROWS,
) -> DataFrame:
    """Stations per freguesia: all of one concelho, or the largest of the country (without a limit all)."""
    stations = collated(stations, collation)
    if concelho:
        stations = stations.where(F.col("concelho") == F.lit(concelho))
    areas = stations.groupBy("distrito", "concelho", "freguesia").agg(
        m.rows("total_stations"), m.mean(m.POWER, "avg_power_kw")
    )
    limit = None if concelho else limit
    ranked = m.ranked_by(areas, "total_stations", "distrito", "concelho", "freguesia", limit=limit)
    return plain(ranked, collation)


def power_distribution(stations: DataFrame) -> DataFrame:
    """Stations per power band, as a share of all stations, those without a power included."""
    bands = stations.groupBy(band_of(F.col(m.POWER), fixed.POWER_BANDS).alias("power_category")).agg(
        m.rows("station_count"), m.mean(m.POWER, "avg_power"), _points()
    )
    shares = share_of_bands(bands, "station_count").where(F.col("power_category").isNotNull())
    return shares.select(
        "power_category", "station_count", "percentage", "avg_power", "total_connection_points"
    ).orderBy(position_in(F.col("power_category"), labels_of(fixed.POWER_BANDS)))


def high_power_stations(
    stations: DataFrame, min_power: float = fixed.HIGH_POWER_KW, limit: int = fixed.TOP_ROWS
) -> DataFrame:
    """Strongest stations from a minimum power up."""
    # compared with the next amount that can be stored, so the bare column reaches the file scan
    least = Decimal(str(min_power)).quantize(Decimal("0.01"), ROUND_CEILING)
    strong = stations.where(F.col(m.POWER) >= F.lit(least))
    return m.ranked_by(strong, m.POWER, "station_id", limit=limit).select(
        "station_id",
        "distrito",
        "concelho",
        "freguesia",
        published(F.col(m.POWER)).alias("power_kw"),
        F.col(m.POINTS).alias("connection_points"),
        published(F.col("latitude"), 5).alias("lat"),
        published(F.col("longitude"), 5).alias("lon"),
    )


def connection_points_analysis(stations: DataFrame) -> DataFrame:
    """Stations per number of connection points, as a share of all stations."""
    sizes = stations.where(F.col(m.POINTS).isNotNull()).groupBy(F.col(m.POINTS).alias("connection_points")).agg(
        m.rows("station_count"), m.mean(m.POWER, "avg_power_kw")
    )
    shares = share_of_rows(sizes, stations, "station_count")
    return shares.select("connection_points", "station_count", "percentage", "avg_power_kw").orderBy(
        "connection_points"
    )


def stations_near_coordinates(
    stations: DataFrame,
    latitude: float,
    longitude: float,
    max_distance_km: float = fixed.NEAR_KM,
    limit: int | None = fixed.NEAR_ROWS,
) -> DataFrame:
    """Stations within a distance, nearest first; without a limit all.

    A box around the point is tested first with comparisons the file scan can
    use. It is wider by half of the last reported digit, because the rounded
    distance decides.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    candidates = stations.where(inside_box(lat, lon, latitude, longitude, max_distance_km + 0.005))
    distance = F.round(distance_km(lat, lon, latitude, longitude), 2)
    near = (
        candidates.where(lat.isNotNull() & lon.isNotNull())
        .withColumn("distance_km", distance)
        .where(F.col("distance_km") <= F.lit(float(max_distance_km)))
    )
    ranked = near.orderBy("distance_km", "station_id")
    if limit is not None:
        ranked = ranked.limit(limit)
    return ranked.select(
        "station_id",
        "distrito",
        "concelho",
        "freguesia",
        published(F.col(m.POWER)).alias("power_kw"),
        m.POINTS,
        published(lat, 6).alias("lat"),
        published(lon, 6).alias("lon"),
        "distance_km",
    )


def station_density_by_area(
    stations: DataFrame,
    min_stations: int = fixed.DENSITY_MIN_STATIONS,
    collation: str | None = None,
    limit: int | None = fixed.DENSITY_ROWS,
) -> DataFrame:
    """Dense concelhos, with their stations relative to the concelhos of the distrito.

    The concelhos of a distrito are counted on the aggregated rows, of which
    there is one per concelho. Stations without a distrito have no such ratio.
    """
    areas = collated(stations, collation).groupBy("distrito", "concelho").agg(
        m.rows("station_count"), _points(), m.mean(m.POWER, "avg_power")
    )
    neighbours = F.count("concelho").over(Window.partitionBy("distrito"))
    counted = areas.withColumn("_concelhos", F.when(F.col("distrito").isNotNull(), neighbours))
    dense = counted.where(F.col("station_count") >= F.lit(min_stations)).withColumn(
        "stations_per_concelho_in_distrito",
        published(ratio(count_as_decimal(F.col("station_count")), count_as_decimal(F.col("_concelhos")))),
    )
    ranked = m.ranked_by(dense.drop("_concelhos"), "station_count", "distrito", "concelho", limit=limit)
    return plain(ranked, collation)


# --- sessions at stations -------------------------------------------------------------


def charging_sessions_with_location(
    sessions: DataFrame, stations: DataFrame, limit: int = fixed.LOCATION_ROWS
) -> DataFrame:
    """Busiest stations with their location; unknown stations have none."""
    usage = per_station(
        sessions,
        m.rows("sessions"),
        m.mean(m.ENERGY, "avg_energy"),
        m.mean(m.COST, "avg_cost"),
        m.mean(m.HOURS, "avg_duration"),
    )
    located = locate(usage, stations, "left").select(
        m.STATION,
        "distrito",
        "concelho",
        "freguesia",
        *usage.columns[1:],
        published(F.col(m.POWER)).alias("station_power_kw"),
        F.col(m.POINTS).alias("connection_points"),
    )
    return m.ranked_by(located, "sessions", m.STATION, limit=limit)


def usage_by_distrito(sessions: DataFrame, stations: DataFrame, collation: str | None = None) -> DataFrame:
    """Sessions, users, energy and revenue per distrito.

    Distinct users need the users of each station. Sessions are added up per
    station and user first; those pairs meet the stations spread over slices.
    """
    places = collated(stations, collation).where(F.col("distrito").isNotNull()).select("station_id", "distrito")
    # names that are equal have one spelling by now; pairs are grouped by its bytes, since groups of collated text are sorted
    places = plain(places, collation)
    pairs = sessions.groupBy(m.STATION, m.USER).agg(*m.parts(m.ENERGY, m.COST))
    areas = locate_spread(pairs, places, m.USER, sessions.count()).groupBy("distrito").agg(
        m.distinct(m.STATION, "stations_used"),
        m.rows_of_parts("total_sessions"),
        m.distinct(m.USER, "unique_users"),
        m.total_of_parts(m.ENERGY, "total_energy_kwh"),
        m.mean_of_summed_parts(m.ENERGY, "avg_energy_per_session"),
        m.total_of_parts(m.COST, "total_revenue"),
        m.mean_of_summed_parts(m.COST, "avg_cost_per_session"),
    )
    if collation is not None:
        areas = areas.withColumn("distrito", F.collate("distrito", collation))
    ranked = m.ranked_by(areas, "total_sessions", "distrito")
    return plain(ranked, collation)


def usage_by_concelho(
    sessions: DataFrame,
    stations: DataFrame,
    distrito: str | None = None,
    collation: str | None = None,
    limit: int | None = fixed.CONCELHO_USAGE_ROWS,
) -> DataFrame:
    """Usage per concelho: all of one distrito, or the busiest of the country (without a limit all)."""
    places = collated(stations, collation).where(F.col("concelho").isNotNull())
    if distrito:
        places = places.where(F.col("distrito") == F.lit(distrito))
    areas = locate(per_station(sessions, *m.parts(m.ENERGY, m.COST)), places).groupBy("distrito", "concelho").agg(
        m.distinct(m.STATION, "stations_used"),
        m.rows_of_parts("total_sessions"),
        m.total_of_parts(m.ENERGY, "total_energy_kwh"),
        m.total_of_parts(m.COST, "total_revenue"),
    )
    limit = None if distrito else limit
    ranked = m.ranked_by(areas, "total_sessions", "distrito", "concelho", limit=limit)
    return plain(ranked, collation)


def top_locations_by_revenue(
    sessions: DataFrame, stations: DataFrame, limit: int = fixed.REVENUE_ROWS, collation: str | None = None
) -> DataFrame:
    """Concelhos that earn most."""
    named = F.col("distrito").isNotNull() & F.col("concelho").isNotNull()
    places = collated(stations, collation).where(named)
    areas = locate(per_station(sessions, *m.parts(m.COST, m.ENERGY)), places).groupBy("distrito", "concelho").agg(
        m.distinct(m.STATION, "stations"),
        m.rows_of_parts("sessions"),
        m.total_of_parts(m.COST, "total_revenue"),
        m.mean_of_summed_parts(m.COST, "avg_cost_per_session"),
        m.total_of_parts(m.ENERGY, "total_energy_kwh"),
    )
    ranked = m.ranked_by(areas, "total_revenue", "distrito", "concelho", limit=limit)
    return plain(ranked, collation)


def stations_with_no_usage(
    sessions: DataFrame, stations: DataFrame, limit: int = fixed.UNUSED_STATION_ROWS
) -> DataFrame:
    """Strongest stations that no session names.

    Sessions shrink to their distinct station ids before the anti-join.
    """
    used = sessions.select(m.STATION).distinct()
    unused = stations.join(used, stations["station_id"] == used[m.STATION], "left_anti")
    return m.ranked_by(unused, m.POWER, "station_id", limit=limit).select(
        "station_id",
        "distrito",
        "concelho",
        "freguesia",
        published(F.col(m.POWER)).alias("power_kw"),
        m.POINTS,
    )


def power_vs_usage_analysis(sessions: DataFrame, stations: DataFrame) -> DataFrame:
    """Usage per power band of the station.

    The average station power counts a station once per session, and an unused
    station once.
    """
    usage = per_station(sessions, *m.parts(m.ENERGY, m.HOURS), F.count("id").alias("ids"))
    powered = stations.where(F.col(m.POWER).isNotNull()).select("station_id", m.POWER)
    joined = powered.join(usage, powered["station_id"] == usage[m.STATION], "left").withColumn(
        "weight", F.coalesce(F.col("n"), F.lit(1))
    )
    weighted = mean_of_parts(F.sum(F.col(m.POWER) * F.col("weight")), F.sum("weight"), 2)
    bands = joined.groupBy(band_of(F.col(m.POWER), fixed.POWER_USAGE_BANDS).alias("power_range")).agg(
        m.distinct("station_id", "total_stations"),
        m.distinct(m.STATION, "stations_with_usage"),
        F.coalesce(F.sum("ids"), F.lit(0)).alias("total_sessions"),
        m.mean_of_summed_parts(m.ENERGY, "avg_energy_per_session"),
        m.mean_of_summed_parts(m.HOURS, "avg_duration_hours"),
        published(weighted).alias("avg_station_power"),
    )
    return bands.orderBy("avg_station_power", "power_range")


def geographic_coverage_stats(sessions: DataFrame, stations: DataFrame) -> DataFrame:
    """Places and stations in total, and those that have sessions.

    The average power of the second row counts a station once per session.
    """
    areas = [
        m.distinct("distrito", "distritos"),
        m.distinct("concelho", "concelhos"),
        m.distinct("freguesia", "freguesias"),
    ]
    everywhere = stations.agg(*areas, m.rows("total_stations"), m.mean(m.POWER, "avg_power"))
    used = locate(per_station(sessions, m.rows("n")), stations)
    has_power = F.col(m.POWER).isNotNull()
    weighted = mean_of_parts(F.sum(F.col(m.POWER) * F.col("n")), F.sum(F.when(has_power, F.col("n"))), 2)
    with_sessions = used.agg(
        *areas, m.distinct("station_id", "total_stations"), published(weighted).alias("avg_power")
    )

    def labelled(row: DataFrame, metric: str) -> DataFrame:
        return row.select(F.lit(metric).alias("metric"), "*")

    return labelled(everywhere, fixed.TOTAL_COVERAGE).unionByName(
        labelled(with_sessions, fixed.COVERAGE_WITH_SESSIONS)
    )
