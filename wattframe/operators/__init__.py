"""The reports. Each takes the sessions and/or stations frame and returns a frame."""

from .cost import (
    cost_statistics,
    cost_trends_by_time_of_day,
    daily_cost_trends,
    monthly_cost_trends,
    weekly_cost_trends,
)
from .distribution import day_of_week_distribution, time_of_day_distribution, weekend_vs_weekday
from .duration import (
    duration_by_time_of_day,
    duration_by_vehicle_model,
    duration_distribution,
    duration_statistics,
)
from .energy import (
    daily_energy_delivered,
    energy_by_station,
    energy_by_vehicle_model,
    total_energy_delivered,
)
from .explore import daily_overview, headline_figures, newest_sessions, table_profile
from .geography import (
    charging_sessions_with_location,
    connection_points_analysis,
    geographic_coverage_stats,
    high_power_stations,
    power_distribution,
    power_vs_usage_analysis,
    station_density_by_area,
    stations_by_concelho,
    stations_by_distrito,
    stations_by_freguesia,
    stations_near_coordinates,
    stations_with_no_usage,
    top_locations_by_revenue,
    usage_by_concelho,
    usage_by_distrito,
)
from .stations import (
    station_daily_usage,
    station_peak_hours,
    station_utilization_rate,
    top_stations_ranking,
    usage_per_station,
)
from .trends import (
    daily_trends,
    hourly_distribution,
    monthly_trends,
    monthly_trends_span,
    trend_comparison,
    weekly_trends,
    weekly_trends_iso,
)
from .users import top_users_ranking, usage_per_user, user_charging_frequency, user_daily_usage

__all__ = [
    name
    for name, value in list(globals().items())
    if callable(value) and getattr(value, "__module__", "").startswith(__name__ + ".")
]
