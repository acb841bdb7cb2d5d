"""Streaming forms of the daily report, message decoding and chart arrays."""

from .closing import closed_days, closed_users, start_closed_days, users_error
from .daily import daily_users, daily_users_estimate, daily_windows, start_daily_overview
from .messages import messages_of
from .overview import start_stored_overview, stored_days, stored_overview
from .series import chart_series

__all__ = [
    "chart_series",
    "closed_days",
    "closed_users",
    "daily_users",
    "daily_users_estimate",
    "daily_windows",
    "messages_of",
    "start_closed_days",
    "start_daily_overview",
    "start_stored_overview",
    "stored_days",
    "stored_overview",
    "users_error",
]
