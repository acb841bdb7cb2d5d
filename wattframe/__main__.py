"""Loads files and prints a report: python -m wattframe --sessions a.csv --stations b.csv --report power_distribution

Runs under spark-submit as well. Without files the stored tables are used as they are.
"""

import argparse
import inspect

from . import operators
from .session import build_session
from .sources import create_tables, load_sessions, load_stations, open_sessions, open_stations


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wattframe", description=__doc__.splitlines()[0])
    parser.add_argument("--sessions", nargs="+", help="session files or folders to load")
    parser.add_argument("--stations", nargs="+", help="station files or folders to load")
    parser.add_argument("--tables", help="folder of the stored tables; by default that of the current database")
    parser.add_argument("--replace", action="store_true", help="loaded sessions take the place of stored ones")
    parser.add_argument("--report", default="power_distribution", choices=sorted(operators.__all__))
    parser.add_argument("--set", nargs="+", default=[], metavar="NAME=VALUE", help="arguments of the report")
    parser.add_argument("--rows", type=int, default=5, help="rows to print")
    parser.add_argument("--master")
    return parser.parse_args()


def run(report: str, values: dict[str, str], sessions, stations):
    """Calls a report by name with the tables and the text values it takes."""
    function = getattr(operators, report)
    wanted = inspect.signature(function).parameters
    tables = {"sessions": sessions, "stations": stations}
    given = {name: _converted(wanted[name], text) for name, text in values.items()}
    return function(**{name: table for name, table in tables.items() if name in wanted}, **given)


def _converted(parameter: inspect.Parameter, text: str):
    kinds = {bool: lambda t: t.lower() in ("1", "true", "yes"), int: int, float: float}
    return kinds.get(parameter.annotation, str)(text)


def main() -> None:
    given = _arguments()
    spark = build_session(master=given.master)
    create_tables(spark, given.tables)
    if given.sessions:
        print("sessions:", load_sessions(spark, given.sessions, given.replace)[0])
    if given.stations:
        print("stations:", load_stations(spark, given.stations)[0])
    values = dict(pair.split("=", 1) for pair in given.set)
    report = run(given.report, values, open_sessions(spark), open_stations(spark))
    report.show(given.rows, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
