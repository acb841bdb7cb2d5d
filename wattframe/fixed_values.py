"""Values that define the data model and the reports.

Everything in this module is a fixed value: header names, column types, labels,
band edges, physical constants and default arguments. Results are only right
with exactly these, so they are stated once, as plain text, and imported from
here by the rest of the package.
"""

# --- table names -----------------------------------------------------------
SESSIONS_TABLE = "ev_charging_data"
STATIONS_TABLE = "ev_stations"
REJECTS_TABLE = "ev_rejected_lines"

# --- session file: header, column, type (text length or decimal p,s) ---------
SESSION_COLUMNS = [
    ("User ID", "user_id", "varchar(50)"),
    ("Vehicle Model", "vehicle_model", "varchar(100)"),
    ("Battery Capacity (kWh)", "battery_capacity_kwh", "decimal(5,2)"),
    ("Charging Station ID", "charging_station_id", "varchar(50)"),
    ("Charging Start Time", "charging_start_time", "timestamp_ntz"),
    ("Charging End Time", "charging_end_time", "timestamp_ntz"),
    ("Energy Consumed (kWh)", "energy_consumed_kwh", "decimal(6,2)"),
    ("Charging Duration (hours)", "charging_duration_hours", "decimal(5,3)"),
    ("Charging Rate (kW)", "charging_rate_kw", "decimal(6,2)"),
    ("Charging Cost (EUR)", "charging_cost_eur", "decimal(8,2)"),
    ("Time of Day", "time_of_day", "varchar(20)"),
    ("Day of Week", "day_of_week", "varchar(20)"),
    ("State of Charge (Start %)", "state_of_charge_start_pct", "decimal(5,2)"),
    ("State of Charge (End %)", "state_of_charge_end_pct", "decimal(5,2)"),
    ("Distance Driven (since last charge) (km)", "distance_driven_km", "decimal(7,2)"),
    ("Temperature (C)", "temperature_c", "decimal(4,2)"),
    ("Vehicle Age (years)", "vehicle_age_years", "int"),
]

# --- station file ------------------------------------------------------------
STATION_COLUMNS = [
    ("Station ID", "station_id", "varchar(50)"),
    ("Distrito", "distrito", "varchar(100)"),
    ("Concelho", "concelho", "varchar(100)"),
    ("Freguesia", "freguesia", "varchar(100)"),
    ("Latitude", "latitude", "decimal(10,7)"),
    ("Longitude", "longitude", "decimal(10,7)"),
    ("Potência Máxima Admissível (kW)", "potencia_maxima_kw", "decimal(8,2)"),
    ("Pontos de ligação para instalações de PCVE", "pontos_ligacao", "int"),
]

# --- file format ---------------------------------------------------------------
FIELD_SEPARATOR = ";"
DECIMAL_MARK = ","
# white space that goes at both ends of a header name or value
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
# day/month/two-digit-year hour:minute; years 69-99 are 19xx, 00-68 are 20xx
TIME_SHAPE = r"^(\d{1,2})/(\d{1,2})/(\d{2})\s+(\d{1,2}):(\d{1,2})$"
FIRST_YEAR_OF_1900S = 69

# --- labels, in report order -----------------------------------------------------
TIMES_OF_DAY = ["Morning", "Afternoon", "Evening", "Night"]
DAYS_OF_WEEK = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEEKEND_DAYS = ["Saturday", "Sunday"]
WEEKEND = "Weekend"
WEEKDAY = "Weekday"

# --- bands: label, upper edge; the first band excludes its edge, later ones include it
DURATION_BANDS = [
    ("< 30 min", "0.5"),
    ("30 min - 1 hour", "1"),
    ("1-2 hours", "2"),
    ("2-4 hours", "4"),
    ("4-6 hours", "6"),
    ("> 6 hours", None),
]
POWER_BANDS = [
    ("< 50 kW (Slow)", "50"),
    ("50-100 kW (Medium)", "100"),
    ("100-150 kW (Fast)", "150"),
    ("150-300 kW (Very Fast)", "300"),
    ("> 300 kW (Ultra Fast)", None),
]
POWER_USAGE_BANDS = [
    ("< 50 kW", "50"),
    ("50-100 kW", "100"),
    ("100-150 kW", "150"),
    ("> 150 kW", None),
]

# --- period and coverage rows ------------------------------------------------------
DAILY_AVERAGE = "Daily Average"
WEEKLY_AVERAGE = "Weekly Average"
MONTHLY_AVERAGE = "Monthly Average"
TOTAL_COVERAGE = "Total Coverage"
COVERAGE_WITH_SESSIONS = "With Charging Sessions"

# --- geography -----------------------------------------------------------------------
EARTH_RADIUS_KM = 6371

# --- default arguments ---------------------------------------------------------------
TOP_ROWS = 50
LOCATION_ROWS = 100
REVENUE_ROWS = 20
CONCELHO_USAGE_ROWS = 30
DENSITY_ROWS = 30
DENSITY_MIN_STATIONS = 10
UNUSED_STATION_ROWS = 100
HIGH_POWER_KW = 150
NEAR_KM = 10
NEAR_ROWS = 50
NEWEST_ROWS = 100
OVERVIEW_DAYS = 10
CHART_ROWS = 10

# --- messages and charts ----------------------------------------------------------------
REFRESH_INTERVAL = "30 seconds"
MESSAGE_TOPIC = "topic/hello"
CHART_SERIES = ["Sessions", "Avg Cost"]
