"""Files and tables."""

from .ingest import Parsed, first_per_station, read_sessions, read_stations
from .ledger import load_new_files
from .tables import (
    create_tables,
    drop_tables,
    keep_clustered,
    keep_summary,
    load_all,
    load_sessions,
    load_stations,
    open_clustered,
    open_rejects,
    open_sessions,
    open_stations,
    open_summary,
    query,
)

__all__ = [
    "Parsed",
    "create_tables",
    "drop_tables",
    "first_per_station",
    "keep_clustered",
    "keep_summary",
    "load_all",
    "load_new_files",
    "load_sessions",
    "load_stations",
    "open_clustered",
    "open_rejects",
    "open_sessions",
    "open_stations",
    "open_summary",
    "query",
    "read_sessions",
    "read_stations",
]
