"""For each query the SQL that gives the same rows on the plain tables.

Amounts are whole hundredths or thousandths here (``_c`` and ``_m`` columns) and
all rounding is integer arithmetic, half away from zero on amounts that are
never negative.
"""

from .registry import CONCELHO, DEAR, DENSE, DISTRITO, MODEL, OF_DAYS, POINT, STATION, TOPIC, USER

_SES = """ses AS (
  SELECT l_orderkey*10 + l_linenumber AS id, concat('U', o_custkey) AS user_id, o_orderpriority AS vehicle_model,
    4000 + (o_custkey % 7)*1000 AS battery_c,
    concat('S', CASE WHEN l_suppkey % 10 = 3 THEN l_suppkey + 1 ELSE l_suppkey END) AS charging_station_id,
    l_shipdate + to_minutes((l_orderkey*17 + l_linenumber*131) % 1440) AS charging_start_time,
    CAST(l_shipdate AS DATE) AS day,
    CASE WHEN l_orderkey % 50 <> 0 THEN CAST(round(l_quantity*100) AS BIGINT) END AS energy_c,
    CASE WHEN l_orderkey % 70 <> 1 THEN CAST(round(l_tax*100) AS BIGINT)*1000 + l_linenumber*125 END AS hours_m,
    CAST(round(l_quantity*300) AS BIGINT) AS rate_c,
    CASE WHEN l_orderkey % 90 <> 2 THEN CAST(round(l_extendedprice*100) AS BIGINT) END AS cost_c,
    CASE l_linenumber % 5 WHEN 1 THEN 'Morning' WHEN 2 THEN 'Afternoon' WHEN 3 THEN 'Evening' WHEN 4 THEN 'Night' END
      AS time_of_day,
    dayname(l_shipdate) AS day_of_week
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_STA = """sta AS (
  SELECT concat(CASE WHEN s_suppkey % 25 = 7 THEN 'X' ELSE 'S' END, s_suppkey) AS station_id,
    r_name AS distrito, n_name AS concelho, concat(n_name, '/', s_suppkey % 3) AS freguesia,
    3700 + s_suppkey*37 % 500 AS lat_c, -950 + s_suppkey*53 % 300 AS lon_c,
    CASE WHEN s_acctbal >= 0 THEN CAST(floor(s_acctbal) AS BIGINT) % 400 * 100 END AS power_c,
    CASE WHEN s_suppkey % 20 <> 0 THEN CAST(s_suppkey % 8 + 1 AS INTEGER) END AS pontos_ligacao
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_EVT = """evt AS (
  SELECT ts, CAST(ts AS DATE) AS day, user_id,
    CASE WHEN event_type <> 'error' THEN CAST(round(value*100) AS BIGINT) END AS energy_c,
    CAST(round(value*200) AS BIGINT) AS cost_c, event_id % 9000 AS hours_m
  FROM events),
closed AS (
  SELECT * FROM evt WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR)"""


# sessions of closed days; every tenth came when the others were through
_TOLD = """told AS (
  SELECT *, hours_m % 10 = 3 AND day + INTERVAL 25 HOUR <= (SELECT max(ts) FROM evt WHERE hours_m % 10 <> 3) AS late
  FROM closed)"""


def _ses(body: str) -> str:
    return f"WITH {_SES}\n{body}"


def _sta(body: str) -> str:
    return f"WITH {_STA}\n{body}"


def _both(body: str) -> str:
    return f"WITH {_SES},\n{_STA}\n{body}"


def _evt(body: str) -> str:
    return f"WITH {_EVT}\n{body}"


# --- rounding ------------------------------------------------------------------------------


def _hundredths(number: str) -> str:
    return f"CAST({number} AS DOUBLE)/100"


def _mean6(total: str, n: str) -> str:
    """Average of hundredths (or thousandths) with four more digits."""
    return f"(({total})*20000 + ({n}))//(2*({n}))"


def avg_c(column: str) -> str:
    return _hundredths(f"({_mean6(f'sum({column})', f'count({column})')} + 5000)//10000")


def avg_c_of(total: str, n: str) -> str:
    return _hundredths(f"({_mean6(total, n)} + 5000)//10000")


def avg_m(column: str) -> str:
    return _hundredths(f"({_mean6(f'sum({column})', f'count({column})')} + 50000)//100000")


def minutes_m(column: str) -> str:
    return _hundredths(f"(({_mean6(f'sum({column})', f'count({column})')})*60 + 50000)//100000")


def sum_c(column: str) -> str:
    return _hundredths(f"sum({column})")


def sum_m(column: str) -> str:
    return _hundredths(f"(sum({column}) + 5)//10")


def one_c(value: str) -> str:
    return _hundredths(value)


def one_m(value: str) -> str:
    return _hundredths(f"({value} + 5)//10")


def std(column: str, unit: int) -> str:
    return f"round(stddev_pop({column}/{unit}.0), 2)"


def ratio(part: str, whole: str) -> str:
    """part/whole to two digits."""
    return _hundredths(f"(({part})*200 + ({whole}))//(2*({whole}))")


def percent(part: str, whole: str) -> str:
    return ratio(f"100*({part})", whole)


# --- calendar and bands ------------------------------------------------------------------------

YEAR = "CAST(year(day) AS INTEGER)"
MONTH = "CAST(month(day) AS INTEGER)"
WEEK = (
    "CAST(CASE WHEN isoyear(day) < year(day) THEN 0 WHEN isoyear(day) > year(day) THEN 53 ELSE week(day) END AS INTEGER)"
)
WEEK_LABEL = f"concat({YEAR}, '-W', lpad(CAST({WEEK} AS VARCHAR), 2, '0'))"
MONTH_LABEL = "strftime(day, '%Y-%m')"
HOUR = "CAST(hour(charging_start_time) AS INTEGER)"

DURATION_BAND = """CASE WHEN hours_m < 500 THEN '< 30 min' WHEN hours_m <= 1000 THEN '30 min - 1 hour'
  WHEN hours_m <= 2000 THEN '1-2 hours' WHEN hours_m <= 4000 THEN '2-4 hours'
  WHEN hours_m <= 6000 THEN '4-6 hours' ELSE '> 6 hours' END"""
POWER_BAND = """CASE WHEN power_c < 5000 THEN '< 50 kW (Slow)' WHEN power_c <= 10000 THEN '50-100 kW (Medium)'
  WHEN power_c <= 15000 THEN '100-150 kW (Fast)' WHEN power_c <= 30000 THEN '150-300 kW (Very Fast)'
  ELSE '> 300 kW (Ultra Fast)' END"""
USAGE_BAND = """CASE WHEN power_c < 5000 THEN '< 50 kW' WHEN power_c <= 10000 THEN '50-100 kW'
  WHEN power_c <= 15000 THEN '100-150 kW' ELSE '> 150 kW' END"""

VOLUME = f"""count(*) AS total_sessions, {sum_c('energy_c')} AS total_energy_kwh, {avg_c('energy_c')} AS avg_energy_kwh,
  {sum_c('cost_c')} AS total_revenue, {avg_c('cost_c')} AS avg_cost, {avg_m('hours_m')} AS avg_duration_hours"""
USERS = "count(DISTINCT user_id) AS unique_users"
STATIONS_USED = "count(DISTINCT charging_station_id) AS stations_used"
POINTS = "CAST(sum(pontos_ligacao) AS BIGINT) AS total_connection_points"


def _period_average(name: str, key: str) -> str:
    return f"""SELECT '{name}' AS period_type,
  {_hundredths(f"({_mean6('sum(n)', 'count(n)')} + 50)//100")} AS avg_sessions,
  {avg_c('e')} AS avg_energy_kwh, {avg_c('c')} AS avg_revenue
FROM (SELECT count(*) AS n, sum(energy_c) AS e, sum(cost_c) AS c FROM ses GROUP BY {key})"""


def _users(limit: str = "") -> str:
    return _ses(
        f"""SELECT user_id, vehicle_model, count(*) AS total_sessions, {sum_c('cost_c')} AS total_spent,
  {avg_c('cost_c')} AS avg_cost_per_session, {sum_c('energy_c')} AS total_energy_kwh,
  {avg_c('energy_c')} AS avg_energy_per_session, {avg_m('hours_m')} AS avg_duration_hours,
  count(DISTINCT charging_station_id) AS stations_used, count(DISTINCT day) AS days_active
FROM ses GROUP BY ALL ORDER BY total_sessions DESC, user_id, vehicle_model {limit}"""
    )


def _user_days(where: str = "") -> str:
    return _ses(
        f"""SELECT user_id, day AS date, count(*) AS sessions_that_day, {sum_c('cost_c')} AS daily_cost,
  {sum_c('energy_c')} AS daily_energy
FROM ses {where} GROUP BY ALL"""
    )


def _station_days(where: str = "") -> str:
    return _ses(
        f"""SELECT charging_station_id, day AS date, count(*) AS sessions_that_day, {USERS},
  {sum_c('cost_c')} AS daily_revenue, {sum_c('energy_c')} AS daily_energy
FROM ses {where} GROUP BY ALL"""
    )


def _distritos(limit: str = "") -> str:
    return _sta(
        f"""SELECT distrito, count(*) AS total_stations, {avg_c('power_c')} AS avg_power_kw,
  {one_c('min(power_c)')} AS min_power_kw, {one_c('max(power_c)')} AS max_power_kw, {POINTS}
FROM sta GROUP BY ALL ORDER BY total_stations DESC, distrito {limit}"""
    )


def _concelhos(where: str, limit: str) -> str:
    return _sta(
        f"""SELECT distrito, concelho, count(*) AS total_stations, {avg_c('power_c')} AS avg_power_kw, {POINTS}
FROM sta {where} GROUP BY ALL ORDER BY total_stations DESC, distrito, concelho {limit}"""
    )


def _freguesias(where: str, limit: str) -> str:
    return _sta(
        f"""SELECT distrito, concelho, freguesia, count(*) AS total_stations, {avg_c('power_c')} AS avg_power_kw
FROM sta {where} GROUP BY ALL ORDER BY total_stations DESC, distrito, concelho, freguesia {limit}"""
    )


def _density(least: int) -> str:
    return _sta(
        f"""SELECT distrito, concelho, count(*) AS station_count, {POINTS}, {avg_c('power_c')} AS avg_power,
  {ratio('count(*)', 'any_value(concelhos)')} AS stations_per_concelho_in_distrito
FROM sta LEFT JOIN (SELECT distrito, count(DISTINCT concelho) AS concelhos FROM sta GROUP BY ALL) USING (distrito)
GROUP BY distrito, concelho HAVING count(*) >= {least}
ORDER BY station_count DESC, distrito, concelho LIMIT 30"""
    )


def _concelho_usage(where: str, limit: str) -> str:
    return _both(
        f"""SELECT distrito, concelho, {STATIONS_USED}, count(*) AS total_sessions,
  {sum_c('energy_c')} AS total_energy_kwh, {sum_c('cost_c')} AS total_revenue
FROM ses JOIN sta ON charging_station_id = station_id WHERE concelho IS NOT NULL {where}
GROUP BY ALL ORDER BY total_sessions DESC, distrito, concelho {limit}"""
    )


def _near(km: int = POINT[2], limit: str = "LIMIT 50", lon_c: str = "lon_c") -> str:
    latitude, longitude, _ = POINT
    return _sta(
        f"""SELECT * FROM (
  SELECT station_id, distrito, concelho, freguesia, {one_c('power_c')} AS power_kw, pontos_ligacao,
    lat_c/100.0 AS lat, {lon_c}/100.0 AS lon,
    round(6371*2*asin(sqrt(least(1.0, power(sin((radians(lat_c/100.0) - radians({latitude}))/2), 2)
      + cos(radians({latitude}))*cos(radians(lat_c/100.0))
      * power(sin((radians({lon_c}/100.0) - radians({longitude}))/2), 2)))), 2) AS distance_km
  FROM sta)
WHERE distance_km <= {km} ORDER BY distance_km, station_id {limit}"""
    )


_OVERVIEW = f"""SELECT day AS date, count(*) AS sessions, {sum_c('energy_c')} AS energy, {avg_c('cost_c')} AS avg_cost
FROM ses GROUP BY ALL ORDER BY date DESC LIMIT 10"""

_SESSION_LINES = """lines AS (
  SELECT *, CASE WHEN id % 97 = 5 THEN 'bad time: charging_end_time'
    WHEN id % 101 = 3 THEN 'bad number: charging_cost_eur' END AS reject_reason
  FROM ses)"""


_INGESTED = f"""WITH {_SES}, {_SESSION_LINES}
SELECT user_id, vehicle_model, battery_c/100.0 AS battery_capacity_kwh, charging_station_id, charging_start_time,
  charging_start_time + INTERVAL 45 MINUTE AS charging_end_time, energy_c/100.0 AS energy_consumed_kwh,
  hours_m/1000.0 AS charging_duration_hours, rate_c/100.0 AS charging_rate_kw, cost_c/100.0 AS charging_cost_eur,
  time_of_day, day_of_week, (id % 60*10 + 5)/10.0 AS state_of_charge_start_pct,
  ((id % 40 + 60)*100 + 25)/100.0 AS state_of_charge_end_pct, (id % 1000*100 + 13)/100.0 AS distance_driven_km,
  CAST(id % 55 - 20 AS DOUBLE) AS temperature_c,
  CASE WHEN id % 13 <> 0 THEN CAST(id % 12 AS INTEGER) END AS vehicle_age_years
FROM lines WHERE reject_reason IS NULL"""

_LOADED = f"""WITH {_SES}, {_STA}, {_SESSION_LINES},
loaded AS (SELECT * FROM lines WHERE reject_reason IS NULL)
SELECT 'sessions' AS metric, count(*) AS value FROM loaded
UNION ALL SELECT 'users', count(DISTINCT user_id) FROM loaded
UNION ALL SELECT 'stations_used', count(DISTINCT charging_station_id) FROM loaded
UNION ALL SELECT 'vehicle_models', count(DISTINCT vehicle_model) FROM loaded
UNION ALL SELECT 'stations', count(*) FROM sta
UNION ALL SELECT 'distritos', count(DISTINCT distrito) FROM sta
UNION ALL SELECT 'concelhos', count(DISTINCT concelho) FROM sta"""


def _newest(start: str) -> str:
    return _ses(
        f"""SELECT id, user_id, vehicle_model, battery_c/100.0 AS battery_capacity_kwh, charging_station_id,
  {start} AS charging_start_time, energy_c/100.0 AS energy_consumed_kwh, hours_m/1000.0 AS charging_duration_hours,
  rate_c/100.0 AS charging_rate_kw, cost_c/100.0 AS charging_cost_eur, time_of_day, day_of_week
FROM ses
ORDER BY {start} DESC NULLS LAST, id, user_id, vehicle_model, battery_c, charging_station_id,
  energy_c NULLS FIRST, hours_m NULLS FIRST, rate_c, cost_c NULLS FIRST, time_of_day NULLS FIRST, day_of_week
LIMIT 100"""
    )


def _spelled(query: str) -> str:
    """A report by distrito, under the smallest spelling of each; see the registry for how they are spelt."""
    return f"""SELECT q.* REPLACE (spelling AS distrito) FROM ({query}) q JOIN (
  SELECT distrito AS name, min(CASE WHEN pontos_ligacao = 2 THEN lower(distrito) ELSE distrito END) AS spelling
  FROM (WITH {_STA} SELECT * FROM sta) GROUP BY 1) ON name = q.distrito"""


_BY_DISTRITO = _both(
    f"""SELECT distrito, {STATIONS_USED}, count(*) AS total_sessions, {USERS},
  {sum_c('energy_c')} AS total_energy_kwh, {avg_c('energy_c')} AS avg_energy_per_session,
  {sum_c('cost_c')} AS total_revenue, {avg_c('cost_c')} AS avg_cost_per_session
FROM ses JOIN sta ON charging_station_id = station_id WHERE distrito IS NOT NULL GROUP BY ALL"""
)


def oracle_sql() -> dict[str, str]:
    found = {
        "daily_trends": _ses(f"SELECT day AS date, {VOLUME}, {USERS}, {STATIONS_USED} FROM ses GROUP BY ALL"),
        "weekly_trends": _ses(
            f"""SELECT {YEAR} AS year, {WEEK} AS week_number, {WEEK_LABEL} AS year_week, min(day) AS week_start,
  max(day) AS week_end, {VOLUME}, {USERS} FROM ses GROUP BY ALL"""
        ),
        "weekly_trends_iso": _ses(
            f"""SELECT CAST(yearweek(day) AS INTEGER) AS yearweek, min(day) AS week_start, max(day) AS week_end,
  {VOLUME}, {USERS} FROM ses GROUP BY ALL"""
        ),
        "monthly_trends": _ses(
            f"""SELECT {MONTH_LABEL} AS month, {YEAR} AS year, {MONTH} AS month_number,
  strftime(min(day), '%B %Y') AS month_name, {VOLUME}, {USERS}, {STATIONS_USED} FROM ses GROUP BY ALL"""
        ),
        "monthly_trends_span": _ses(
            f"""SELECT {MONTH_LABEL} AS month, min(day) AS month_start, max(day) AS month_end,
  {VOLUME}, {USERS}, {STATIONS_USED} FROM ses GROUP BY ALL"""
        ),
        "trend_comparison": _ses(
            " UNION ALL ".join(
                [
                    _period_average("Daily Average", "day"),
                    _period_average("Weekly Average", f"{YEAR}, {WEEK}"),
                    _period_average("Monthly Average", f"{YEAR}, {MONTH}"),
                ]
            )
        ),
        "hourly_distribution": _ses(
            f"SELECT {HOUR} AS hour, count(*) AS session_count, {avg_c('cost_c')} AS avg_cost FROM ses GROUP BY ALL"
        ),
        "hourly_distribution_wide": _ses(
            f"""SELECT {HOUR} AS hour, count(*) AS session_count, {avg_c('cost_c')} AS avg_cost,
  {avg_c('energy_c')} AS avg_energy, {avg_m('hours_m')} AS avg_duration FROM ses GROUP BY ALL"""
        ),
        "total_energy_delivered": _ses(
            f"""SELECT count(*) AS total_sessions, {sum_c('energy_c')} AS total_energy_delivered_kwh,
  {avg_c('energy_c')} AS avg_energy_per_session, {one_c('min(energy_c)')} AS min_energy_kwh,
  {one_c('max(energy_c)')} AS max_energy_kwh, {std('energy_c', 100)} AS energy_std_dev
FROM ses WHERE energy_c IS NOT NULL"""
        ),
        "energy_by_vehicle_model": _ses(
            f"""SELECT vehicle_model, count(*) AS sessions, {sum_c('energy_c')} AS total_energy_kwh,
  {avg_c('energy_c')} AS avg_energy_per_session, {avg_c('battery_c')} AS avg_battery_capacity,
  {percent(_mean6('sum(energy_c)', 'count(*)'), _mean6('sum(battery_c)', 'count(*)'))} AS avg_battery_pct_charged
FROM ses WHERE energy_c IS NOT NULL AND battery_c IS NOT NULL GROUP BY ALL"""
        ),
        "energy_by_station": _ses(
            f"""SELECT charging_station_id, count(*) AS sessions, {sum_c('energy_c')} AS total_energy_delivered_kwh,
  {avg_c('energy_c')} AS avg_energy_per_session, {avg_c('rate_c')} AS avg_charging_rate_kw
FROM ses WHERE energy_c IS NOT NULL GROUP BY ALL
ORDER BY total_energy_delivered_kwh DESC, charging_station_id LIMIT 50"""
        ),
        "daily_energy_delivered": _ses(
            f"""SELECT day AS date, count(*) AS sessions, {sum_c('energy_c')} AS total_energy_kwh,
  {avg_c('energy_c')} AS avg_energy_kwh, {ratio('sum(energy_c)*10', 'sum(hours_m)')} AS avg_power_kw
FROM ses WHERE energy_c IS NOT NULL AND hours_m > 0 GROUP BY ALL"""
        ),
        "duration_statistics": _ses(
            f"""SELECT count(*) AS total_sessions, {avg_m('hours_m')} AS avg_duration_hours,
  {one_m('min(hours_m)')} AS min_duration_hours, {one_m('max(hours_m)')} AS max_duration_hours,
  {std('hours_m', 1000)} AS duration_std_dev, {minutes_m('hours_m')} AS avg_duration_minutes
FROM ses WHERE hours_m IS NOT NULL"""
        ),
        "duration_distribution": _ses(
            f"""SELECT {DURATION_BAND} AS duration_range, count(*) AS session_count, {avg_c('energy_c')} AS avg_energy_kwh,
  {avg_c('cost_c')} AS avg_cost, {percent('count(*)', '(SELECT count(*) FROM ses)')} AS percentage
FROM ses WHERE hours_m IS NOT NULL GROUP BY 1"""
        ),
        "duration_by_vehicle_model": _ses(
            f"""SELECT vehicle_model, count(*) AS sessions, {avg_m('hours_m')} AS avg_duration_hours,
  {minutes_m('hours_m')} AS avg_duration_minutes, {one_m('min(hours_m)')} AS min_duration_hours,
  {one_m('max(hours_m)')} AS max_duration_hours
FROM ses WHERE hours_m IS NOT NULL GROUP BY ALL"""
        ),
        "duration_by_time_of_day": _ses(
            f"""SELECT time_of_day, count(*) AS sessions, {avg_m('hours_m')} AS avg_duration_hours,
  {minutes_m('hours_m')} AS avg_duration_minutes, {avg_c('energy_c')} AS avg_energy_kwh
FROM ses WHERE time_of_day IS NOT NULL AND hours_m IS NOT NULL GROUP BY ALL"""
        ),
        "time_of_day_distribution": _ses(
            f"""SELECT time_of_day, count(*) AS session_count,
  {percent('count(*)', '(SELECT count(time_of_day) FROM ses)')} AS percentage, {avg_c('cost_c')} AS avg_cost,
  {avg_c('energy_c')} AS avg_energy, {avg_m('hours_m')} AS avg_duration_hours
FROM ses WHERE time_of_day IS NOT NULL GROUP BY 1"""
        ),
        "day_of_week_distribution": _ses(
            f"""SELECT day_of_week, count(*) AS session_count,
  {percent('count(*)', '(SELECT count(day_of_week) FROM ses)')} AS percentage, {avg_c('cost_c')} AS avg_cost,
  {avg_c('energy_c')} AS avg_energy
FROM ses WHERE day_of_week IS NOT NULL GROUP BY 1"""
        ),
        "weekend_vs_weekday": _ses(
            f"""SELECT CASE WHEN day_of_week IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END AS period_type,
  count(*) AS session_count, {avg_c('cost_c')} AS avg_cost, {avg_c('energy_c')} AS avg_energy,
  {avg_m('hours_m')} AS avg_duration
FROM ses WHERE day_of_week IS NOT NULL GROUP BY 1"""
        ),
        "cost_statistics": _ses(
            f"""SELECT count(*) AS total_sessions, {avg_c('cost_c')} AS avg_cost, {one_c('min(cost_c)')} AS min_cost,
  {one_c('max(cost_c)')} AS max_cost, {sum_c('cost_c')} AS total_revenue, {std('cost_c', 100)} AS cost_std_dev
FROM ses WHERE cost_c IS NOT NULL"""
        ),
        "daily_cost_trends": _ses(
            f"""SELECT day AS date, count(*) AS sessions, {sum_c('cost_c')} AS total_cost,
  {avg_c('cost_c')} AS avg_cost_per_session, {one_c('min(cost_c)')} AS min_cost, {one_c('max(cost_c)')} AS max_cost
FROM ses WHERE cost_c IS NOT NULL GROUP BY ALL"""
        ),
        "weekly_cost_trends": _ses(
            f"""SELECT {WEEK_LABEL} AS year_week, min(day) AS week_start, count(*) AS sessions,
  {sum_c('cost_c')} AS total_cost, {avg_c('cost_c')} AS avg_cost_per_session
FROM ses WHERE cost_c IS NOT NULL GROUP BY 1"""
        ),
        "monthly_cost_trends": _ses(
            f"""SELECT {MONTH_LABEL} AS month, strftime(min(day), '%B %Y') AS month_name, count(*) AS sessions,
  {sum_c('cost_c')} AS total_cost, {avg_c('cost_c')} AS avg_cost_per_session, {sum_c('energy_c')} AS total_energy,
  {ratio('sum(cost_c)', 'sum(energy_c)')} AS cost_per_kwh
FROM ses WHERE cost_c IS NOT NULL AND energy_c > 0 GROUP BY 1"""
        ),
        "cost_trends_by_time_of_day": _ses(
            f"""SELECT day AS date, time_of_day, count(*) AS sessions, {avg_c('cost_c')} AS avg_cost
FROM ses WHERE time_of_day IS NOT NULL AND cost_c IS NOT NULL GROUP BY ALL"""
        ),
        "usage_per_user": _users(),
        "usage_per_user_chart": _users("LIMIT 10"),
        "user_charging_frequency": _ses(
            f"""SELECT user_id, count(*) AS total_sessions, min(day) AS first_charge, max(day) AS last_charge,
  CAST(max(day) - min(day) AS INTEGER) AS days_span, {ratio('count(*)', '(max(day) - min(day))')} AS sessions_per_day
FROM ses GROUP BY user_id HAVING max(day) > min(day)"""
        ),
        "user_daily_usage": _user_days(),
        "user_daily_usage_of_one": _user_days(f"WHERE user_id = '{USER}'"),
        "top_users_ranking": _ses(
            f"""SELECT user_id, vehicle_model, count(*) AS sessions, {sum_c('cost_c')} AS total_spent,
  {sum_c('energy_c')} AS total_energy, {sum_m('hours_m')} AS total_hours, {avg_c('cost_c')} AS avg_cost,
  rank() OVER (ORDER BY count(*) DESC) AS rank_by_frequency,
  rank() OVER (ORDER BY sum(cost_c) DESC NULLS LAST) AS rank_by_spending,
  rank() OVER (ORDER BY sum(energy_c) DESC NULLS LAST) AS rank_by_energy
FROM ses GROUP BY user_id, vehicle_model ORDER BY sessions DESC, user_id, vehicle_model LIMIT 50"""
        ),
        "usage_per_station": _both(
            f"""SELECT charging_station_id, distrito, concelho, freguesia, {one_c('power_c')} AS station_power_kw,
  pontos_ligacao AS connection_points, count(*) AS total_sessions, {USERS}, {sum_c('cost_c')} AS total_revenue,
  {avg_c('cost_c')} AS avg_revenue_per_session, {sum_c('energy_c')} AS total_energy_delivered,
  {avg_c('energy_c')} AS avg_energy_per_session, {avg_m('hours_m')} AS avg_duration_hours,
  {avg_c('rate_c')} AS avg_charging_rate_kw, count(DISTINCT day) AS days_active
FROM ses LEFT JOIN sta ON charging_station_id = station_id
GROUP BY charging_station_id, distrito, concelho, freguesia, power_c, pontos_ligacao"""
        ),
        "station_daily_usage": _station_days(),
        "station_daily_usage_of_one": _station_days(f"WHERE charging_station_id = '{STATION}'"),
        "station_utilization_rate": _ses(
            f"""SELECT charging_station_id, count(*) AS total_sessions, min(day) AS first_use, max(day) AS last_use,
  CAST(max(day) - min(day) + 1 AS INTEGER) AS days_in_operation,
  {ratio('count(*)', '(max(day) - min(day) + 1)')} AS sessions_per_day,
  {ratio('sum(hours_m)', '(1000*(max(day) - min(day) + 1))')} AS hours_used_per_day
FROM ses GROUP BY ALL"""
        ),
        "top_stations_ranking": _ses(
            f"""SELECT charging_station_id, count(*) AS sessions, {sum_c('cost_c')} AS revenue,
  {sum_c('energy_c')} AS energy_delivered, {USERS},
  rank() OVER (ORDER BY count(*) DESC) AS rank_by_usage,
  rank() OVER (ORDER BY sum(cost_c) DESC NULLS LAST) AS rank_by_revenue,
  rank() OVER (ORDER BY count(DISTINCT user_id) DESC) AS rank_by_user_diversity
FROM ses GROUP BY charging_station_id ORDER BY sessions DESC, charging_station_id LIMIT 50"""
        ),
        "station_peak_hours": _ses(
            f"""SELECT {HOUR} AS hour, count(*) AS sessions, {avg_m('hours_m')} AS avg_duration
FROM ses WHERE charging_station_id = '{STATION}' GROUP BY ALL"""
        ),
        "stations_by_distrito": _distritos(),
        "stations_by_distrito_chart": _distritos("LIMIT 10"),
        "stations_by_concelho": _concelhos("", "LIMIT 50"),
        "stations_by_concelho_in_distrito": _concelhos(f"WHERE distrito = '{DISTRITO}'", ""),
        "stations_by_concelho_any_case": _concelhos(f"WHERE lower(distrito) = '{DISTRITO.lower()}'", ""),
        "stations_by_freguesia": _freguesias("", "LIMIT 50"),
        "stations_by_freguesia_in_concelho": _freguesias(f"WHERE concelho = '{CONCELHO}'", ""),
        "power_distribution": _sta(
            f"""SELECT {POWER_BAND} AS power_category, count(*) AS station_count,
  {percent('count(*)', '(SELECT count(*) FROM sta)')} AS percentage, {avg_c('power_c')} AS avg_power, {POINTS}
FROM sta WHERE power_c IS NOT NULL GROUP BY 1"""
        ),
        "high_power_stations": _sta(
            f"""SELECT station_id, distrito, concelho, freguesia, {one_c('power_c')} AS power_kw,
  pontos_ligacao AS connection_points, lat_c/100.0 AS lat, lon_c/100.0 AS lon
FROM sta WHERE power_c >= 15000 ORDER BY power_c DESC, station_id LIMIT 50"""
        ),
        "connection_points_analysis": _sta(
            f"""SELECT pontos_ligacao AS connection_points, count(*) AS station_count,
  {percent('count(*)', '(SELECT count(*) FROM sta)')} AS percentage, {avg_c('power_c')} AS avg_power_kw
FROM sta WHERE pontos_ligacao IS NOT NULL GROUP BY 1"""
        ),
        "stations_near_coordinates": _near(),
        "stations_near_coordinates_wrapped": _near(
            lon_c="(CASE WHEN pontos_ligacao = 3 THEN lon_c + 36000 ELSE lon_c END)"
        ),
        "stations_near_coordinates_all": _near(400, ""),
        "stations_by_distrito_any_spelling": _spelled(_distritos()),
        "station_density_by_area": _density(10),
        "station_density_by_area_from_4": _density(DENSE),
        "charging_sessions_with_location": _both(
            f"""SELECT charging_station_id, distrito, concelho, freguesia, count(*) AS sessions,
  {avg_c('energy_c')} AS avg_energy, {avg_c('cost_c')} AS avg_cost, {avg_m('hours_m')} AS avg_duration,
  {one_c('power_c')} AS station_power_kw, pontos_ligacao AS connection_points
FROM ses LEFT JOIN sta ON charging_station_id = station_id
GROUP BY charging_station_id, distrito, concelho, freguesia, power_c, pontos_ligacao
ORDER BY sessions DESC, charging_station_id LIMIT 100"""
        ),
        "usage_by_distrito": _BY_DISTRITO,
        "usage_by_distrito_any_spelling": _spelled(_BY_DISTRITO),
        "usage_by_concelho_all": _concelho_usage("", ""),
        "usage_by_concelho": _concelho_usage("", "LIMIT 30"),
        "usage_by_concelho_in_distrito": _concelho_usage(f"AND distrito = '{DISTRITO}'", ""),
        "stations_with_no_usage": _both(
            f"""SELECT station_id, distrito, concelho, freguesia, {one_c('power_c')} AS power_kw, pontos_ligacao
FROM sta WHERE station_id NOT IN (SELECT charging_station_id FROM ses)
ORDER BY power_c DESC NULLS LAST, station_id LIMIT 100"""
        ),
        "power_vs_usage_analysis": _both(
            f"""SELECT {USAGE_BAND} AS power_range, count(DISTINCT station_id) AS total_stations,
  count(DISTINCT charging_station_id) AS stations_with_usage, count(id) AS total_sessions,
  {avg_c('energy_c')} AS avg_energy_per_session, {avg_m('hours_m')} AS avg_duration_hours,
  {avg_c('power_c')} AS avg_station_power
FROM sta LEFT JOIN ses ON charging_station_id = station_id WHERE power_c IS NOT NULL GROUP BY 1"""
        ),
        "geographic_coverage_stats": _both(
            f"""SELECT 'Total Coverage' AS metric, count(DISTINCT distrito) AS distritos,
  count(DISTINCT concelho) AS concelhos, count(DISTINCT freguesia) AS freguesias, count(*) AS total_stations,
  {avg_c('power_c')} AS avg_power FROM sta
UNION ALL SELECT 'With Charging Sessions', count(DISTINCT distrito), count(DISTINCT concelho),
  count(DISTINCT freguesia), count(DISTINCT station_id), {avg_c('power_c')}
FROM sta JOIN ses ON charging_station_id = station_id"""
        ),
        "top_locations_by_revenue": _both(
            f"""SELECT distrito, concelho, count(DISTINCT charging_station_id) AS stations, count(*) AS sessions,
  {sum_c('cost_c')} AS total_revenue, {avg_c('cost_c')} AS avg_cost_per_session, {sum_c('energy_c')} AS total_energy_kwh
FROM ses JOIN sta ON charging_station_id = station_id WHERE distrito IS NOT NULL AND concelho IS NOT NULL
GROUP BY ALL ORDER BY total_revenue DESC, distrito, concelho LIMIT 20"""
        ),
        "table_profile": _both(
            """SELECT 'sessions' AS metric, count(*) AS value FROM ses
UNION ALL SELECT 'users', count(DISTINCT user_id) FROM ses
UNION ALL SELECT 'stations_used', count(DISTINCT charging_station_id) FROM ses
UNION ALL SELECT 'vehicle_models', count(DISTINCT vehicle_model) FROM ses
UNION ALL SELECT 'stations', count(*) FROM sta
UNION ALL SELECT 'distritos', count(DISTINCT distrito) FROM sta
UNION ALL SELECT 'concelhos', count(DISTINCT concelho) FROM sta"""
        ),
        "headline_figures": _both(
            """SELECT count(*) AS total_sessions, count(DISTINCT user_id) AS active_users,
  (SELECT count(*) FROM sta) AS total_stations, CAST((sum(energy_c) + 50)//100 AS DOUBLE) AS total_energy_kwh
FROM ses"""
        ),
        "newest_sessions": _newest("charging_start_time"),
        "newest_sessions_untimed": _newest("CASE WHEN id % 1000 = 11 THEN charging_start_time END"),
        "daily_overview": _ses(_OVERVIEW),
        "daily_overview_chart": f"""WITH {_SES}, days AS ({_OVERVIEW})
SELECT 'Sessions' AS series, date AS label, CAST(sessions AS DOUBLE) AS value FROM days
UNION ALL SELECT 'Avg Cost', date, avg_cost FROM days""",
        "daily_overview_streamed": _ses(_OVERVIEW),
        "daily_overview_stored": _ses(_OVERVIEW),
        "daily_windows_streamed": _evt(f"SELECT day AS date, {VOLUME} FROM closed GROUP BY ALL"),
        "closed_days_with_late_sessions": f"""WITH {_EVT}, {_TOLD},
counted AS (SELECT day AS date, {VOLUME} FROM told WHERE NOT late GROUP BY ALL),
kept AS (SELECT day AS date, count(*) AS late FROM told WHERE late GROUP BY ALL)
SELECT counted.*, coalesce(kept.late, 0) AS late FROM counted LEFT JOIN kept USING (date)""",
        "closed_users_by_period": f"""WITH {_EVT}, {_TOLD},
counted AS (SELECT day, user_id, unnest(['day', 'week', 'month']) AS period FROM told WHERE NOT late)
SELECT period, CAST(date_trunc(period, day) AS DATE) AS first_day, count(DISTINCT day) AS days,
  count(DISTINCT user_id) AS unique_users, 1 AS estimate_is_near
FROM counted GROUP BY 1, 2""",
        "daily_users_streamed": _evt(
            "SELECT day AS date, count(DISTINCT user_id) AS unique_users FROM closed GROUP BY ALL"
        ),
        "daily_users_estimate_checked": _evt(
            "SELECT day AS date, count(DISTINCT user_id) AS unique_users, 1 AS estimate_is_near FROM closed GROUP BY ALL"
        ),
        "messages_streamed_with_bad_payloads": f"""SELECT concat('topic/', event_type) AS topic, ts,
  CASE WHEN event_id % 7 <> 0 THEN props END AS message, CASE WHEN event_id % 7 = 0 THEN concat('FF', hex(props)) END AS undecoded
FROM events WHERE concat('topic/', event_type) = '{TOPIC}'""",
        "messages_streamed": f"""SELECT concat('topic/', event_type) AS topic, props AS message, ts
FROM events WHERE concat('topic/', event_type) = '{TOPIC}'""",
        "ingested_sessions": _INGESTED,
        "ingested_sessions_padded": _INGESTED,
        "ingest_outcome": f"""WITH {_SES}, {_SESSION_LINES}
SELECT reject_reason, count(*) AS lines FROM lines GROUP BY ALL""",
        "ragged_lines_outcome": f"""WITH {_SES}, {_SESSION_LINES}
SELECT CASE WHEN id % 41 = 9 THEN 'too many fields' ELSE reject_reason END AS reject_reason, count(*) AS lines,
  count(*) FILTER (id % 13 = 0 OR (id % 37 = 7 AND id % 41 <> 9)) AS without_age
FROM lines GROUP BY 1""",
        "ingested_stations": _sta(
            """SELECT station_id, distrito, concelho, freguesia, lat_c/100.0 AS latitude,
  CASE WHEN pontos_ligacao IS DISTINCT FROM 8 THEN lon_c/100.0 END AS longitude,
  power_c/100.0 AS potencia_maxima_kw, pontos_ligacao,
  CASE WHEN pontos_ligacao = 8 THEN 'bad number: longitude' ELSE '' END AS warnings
FROM sta"""
        ),
        "loaded_tables": _LOADED,
        "replaced_tables": _LOADED,
        "recreated_tables": _LOADED,
        "files_taken_once": _LOADED,
        "rejected_lines": f"""WITH {_SES}, {_SESSION_LINES}
SELECT 'ev_charging_data' AS for_table, reject_reason, count(*) AS lines
FROM lines WHERE reject_reason IS NOT NULL GROUP BY ALL""",
        "bound_query": _ses(
            f"""SELECT charging_station_id, count(*) AS sessions, {one_c('max(cost_c)')} AS dearest
FROM ses WHERE vehicle_model = '{MODEL}' AND cost_c >= {DEAR * 100} GROUP BY ALL"""
        ),
    }
    # a copy laid out otherwise holds the same sessions
    found["user_daily_usage_clustered"] = found["user_daily_usage_of_one"]
    found["station_daily_usage_clustered"] = found["station_daily_usage_of_one"]
    found["station_peak_hours_clustered"] = found["station_peak_hours"]
    # reports from the stored summary give what the reports from all sessions give
    return found | {name: found[name.removesuffix("_of_days")] for name in OF_DAYS}
