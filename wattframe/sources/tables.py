"""The two stored tables: create, fill, open and drop."""

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import replace as replaced
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..plans.staging import shuffles_released
from .clustered import open_clustered_folder, refresh_clustered, stored_parts
from .day_summary import open_days, refresh_days, stale_months
from .ingest import REASON, Parsed, first_per_station, read_sessions, read_stations
from .schema import BATCH, MONTH, REJECT_DDL, SESSION_DDL, STATION_DDL

# table property: the first session id that is not used yet
NEXT_ID = "wattframe.next_id"
# beside the folder of the sessions: a replacement in the making, and what it takes the place of
REPLACEMENT, PREVIOUS = "_replacement", "_previous"
# beside the tables, once it is asked for: the summary of days
SUMMARY = "ev_day_summary"
# likewise: the sessions laid out by user and station
CLUSTERED = "ev_clustered_sessions"
# of the stored files; while sessions are replaced, old and new ones are there
CODEC = "zstd"


_SESSIONS = f"{SESSION_DDL}, {MONTH} date, {BATCH} string"


def create_tables(spark: SparkSession, location: str | None = None) -> None:
    """Creates the tables if absent, or adopts what is stored in their folders.

    Tables live in folders below ``location``, by default that of the current
    database, and outlast the session; another process finds them there.
    Sessions are kept in one folder per start month and load. A replacement that broke
    off is finished or undone first.
    """
    base = (location or spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri).rstrip("/")
    sessions = f"{base}/{fixed.SESSIONS_TABLE}"
    if spark.catalog.tableExists(fixed.SESSIONS_TABLE):
        sessions = _folder(spark, fixed.SESSIONS_TABLE)
    settle(spark, sessions)
    _declare(spark, fixed.SESSIONS_TABLE, _SESSIONS, sessions, f"PARTITIONED BY ({MONTH}, {BATCH})")
    _declare(spark, fixed.STATIONS_TABLE, STATION_DDL, f"{base}/{fixed.STATIONS_TABLE}")
    rejects = f"{base}/{fixed.REJECTS_TABLE}"
    _declare(spark, fixed.REJECTS_TABLE, f"{REJECT_DDL}, {BATCH} string", rejects, f"PARTITIONED BY ({BATCH})")


def _declare(spark: SparkSession, name: str, columns: str, folder: str, partitioned: str = "") -> None:
    if spark.catalog.tableExists(name):
        return
    _files(spark, folder).mkdirs(_path(spark, folder))
    place = folder.replace("'", "\\'")
    # an overwrite replaces the folders it writes to, not all
    options = f"OPTIONS ('partitionOverwriteMode' 'dynamic', 'compression' '{CODEC}')" if partitioned else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {options} {partitioned} LOCATION '{place}'")
    if partitioned:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def settle(spark: SparkSession, sessions: str) -> None:
    """Brings the folder of the sessions to either the old or the new rows, whole, after a broken replacement.

    The new rows stay once their files are complete and the old ones were put
    aside; before that the old ones stay.
    """
    files = _files(spark, sessions)
    here, new, old = (_path(spark, sessions + end) for end in ("", REPLACEMENT, PREVIOUS))
    if not files.exists(here):
        if files.exists(_path(spark, f"{sessions}{REPLACEMENT}/_SUCCESS")):
            files.rename(new, here)
        elif files.exists(old):
            files.rename(old, here)
    for left in (new, old):
        if files.exists(left):
            files.delete(left, True)


def _swap(spark: SparkSession, sessions: str) -> None:
    """Puts a complete replacement in the place of the stored sessions, in steps that :func:`settle` can go on from."""
    files = _files(spark, sessions)
    here, new, old = (_path(spark, sessions + end) for end in ("", REPLACEMENT, PREVIOUS))
    files.rename(here, old)
    files.rename(new, here)
    files.delete(old, True)


def drop_tables(spark: SparkSession) -> None:
    """Drops the tables if present, with their files, and what a broken replacement has left."""
    for table in (fixed.SESSIONS_TABLE, fixed.STATIONS_TABLE, fixed.REJECTS_TABLE):
        if spark.catalog.tableExists(table):
            folder = _folder(spark, table)
            spark.sql(f"DROP TABLE {table}")
            for end in ("", REPLACEMENT, PREVIOUS):
                _files(spark, folder).delete(_path(spark, folder + end), True)
            if table == fixed.SESSIONS_TABLE:
                for kept in (SUMMARY, CLUSTERED):
                    _files(spark, folder).delete(_path(spark, _beside(folder, kept)), True)


def _folder(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type


def _path(spark: SparkSession, folder: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder)


def _files(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


def open_sessions(spark: SparkSession, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """The stored sessions, from one start time on and up to, not including, another.

    A limit also restricts the month folders, so only those are read.
    """
    stored = spark.table(fixed.SESSIONS_TABLE)
    start, month = F.col("charging_start_time"), F.col(MONTH)
    if since is not None:
        stored = stored.where((start >= _clock(since)) & (month >= F.lit(since.date().replace(day=1))))
    if until is not None:
        stored = stored.where((start < _clock(until)) & (month <= F.lit(until.date())))
    return stored.drop(MONTH, BATCH)


def _beside(folder: str, name: str = SUMMARY) -> str:
    return f"{folder.rstrip('/').rsplit('/', 1)[0]}/{name}"


def keep_summary(spark: SparkSession, months: Sequence[date | None] | None = None) -> list[date | None]:
    """Stores the summary of days, or brings it up to date; from then on every load keeps it up.

    Without ``months`` the months are found whose sessions changed since they
    were summarised, for instance by a load that broke off in between; that reads
    one narrow column of the table. Returns the months that were read anew; only
    their folders are read and rewritten.
    """
    folder = _beside(_folder(spark, fixed.SESSIONS_TABLE))
    stored = spark.table(fixed.SESSIONS_TABLE)
    if not _files(spark, folder).exists(_path(spark, f"{folder}/days/_SUCCESS")):
        refresh_days(stored.drop(MONTH), folder)
        return [row[0] for row in open_days(spark, folder).select(MONTH).distinct().collect()]
    if months is None:
        months = stale_months(stored, open_days(spark, folder))
    if months:
        known = [month for month in months if month is not None]
        wanted = F.col(MONTH).isin(known) if known else F.lit(False)
        refresh_days(stored.where(wanted | F.col(MONTH).isNull() if None in months else wanted).drop(MONTH), folder, months)
    return list(months)


def keep_clustered(spark: SparkSession, months: Sequence[date | None] | None = None) -> list[date | None]:
    """Stores a copy of the sessions laid out for reports on one user or station, or brings it up to date.

    From then on every load keeps it up, as with :func:`keep_summary`: the months
    a load touched are laid out anew. Without ``months`` those are found that
    differ from the stored sessions. Returns the months that were written.
    """
    folder = _beside(_folder(spark, fixed.SESSIONS_TABLE), CLUSTERED)
    stored = spark.table(fixed.SESSIONS_TABLE)
    if not _files(spark, folder).exists(_path(spark, f"{folder}/_SUCCESS")):
        refresh_clustered(stored.drop(MONTH), folder)
        return [row[0] for row in stored.select(MONTH).distinct().collect()]
    if months is None:
        months = stale_months(stored, stored_parts(open_clustered_folder(spark, folder)))
    if months:
        known = [month for month in months if month is not None]
        wanted = F.col(MONTH).isin(known) if known else F.lit(False)
        rows = stored.where(wanted | F.col(MONTH).isNull() if None in months else wanted)
        refresh_clustered(rows.drop(MONTH), folder, months)
    return list(months)


def open_clustered(spark: SparkSession) -> DataFrame:
    """The stored sessions from the copy of :func:`keep_clustered`: the same rows, for reports on one user or station."""
    return open_clustered_folder(spark, _beside(_folder(spark, fixed.SESSIONS_TABLE), CLUSTERED)).drop(MONTH)


def open_summary(spark: SparkSession) -> DataFrame:
    """The summary of days of the stored sessions, for the reports in ``operators.days``."""
    return open_days(spark, _beside(_folder(spark, fixed.SESSIONS_TABLE)))


def open_stations(spark: SparkSession) -> DataFrame:
    return spark.table(fixed.STATIONS_TABLE)


def query(
    spark: SparkSession, text: str, values: Mapping[str, Any] | Sequence[Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """SQL over the tables, and over frames named in braces.

    Values are bound (``:name`` or ``?``), never pasted into the text.
    """
    return spark.sql(text, args=values, **frames)


def load_sessions(
    spark: SparkSession,
    paths: str | Sequence[str],
    replace: bool = False,
    multiline: bool = False,
    batch: str | None = None,
) -> tuple[dict[str, int], Parsed]:
    """Adds the session files to the table, or puts them in place of its rows.

    There is no key to recognise a session by: adding a file twice stores it
    twice, unless both loads bear the same name of a ``batch``: rows of the
    second then take the place of those of the first, also where the first broke
    off. ``load_new_files`` remembers which files it took. Added rows become visible month by month when the write commits; a
    write that fails before that adds none. A replacement is written to a folder
    of its own, which takes the place of the other once it is complete; whenever
    it breaks, the next call finds all old or all new rows. Shuffled rows are
    deleted when their write ends. One load at a time: two at once could take the
    same ids.

    Returns the number of imported and skipped lines, and the lines with the
    number refused for each reason; all are counted in the writing pass.
    """
    parsed = read_sessions(spark, paths, multiline)
    first_id = 0 if replace else _take_next_id(spark)
    rows = parsed.lines.select(
        (F.monotonically_increasing_id() + F.lit(first_id)).alias("id"),
        *[name for _, name, _ in fixed.SESSION_COLUMNS],
        F.current_timestamp().alias("created_at"),
        F.trunc(F.to_date("charging_start_time"), "month").alias(MONTH),
        F.lit(batch or _own_batch()).alias(BATCH),
        REASON,
    )
    # balances the write by month: large months are split, small ones share a task; the hint needs adaptive execution
    if spark.conf.get("spark.sql.adaptive.enabled") != "true":
        raise RuntimeError("set spark.sql.adaptive.enabled, or a large month is written by one task")
    balanced = rows.hint("rebalance", MONTH)
    reasons = {f"reason_{k}": reason for k, reason in enumerate(parsed.reasons)}
    # counted in the writing stage, where each row is counted once even if tasks are repeated
    seen = Observation("sessions")
    counted = balanced.observe(
        seen,
        F.count_if(F.col(REASON).isNull()).alias("imported"),
        F.count_if(F.col(REASON).isNotNull()).alias("skipped"),
        F.coalesce(F.max("id"), F.lit(first_id - 1)).alias("last_id"),
        F.collect_set(F.when(F.col(REASON).isNull(), F.col(MONTH))).alias("months"),
        F.count_if(F.col(REASON).isNull() & F.col(MONTH).isNull()).alias("untimed"),
        *[F.count_if(F.col(REASON) == F.lit(reason)).alias(key) for key, reason in reasons.items()],
    )
    good = counted.where(F.col(REASON).isNull()).drop(REASON)
    if replace:
        folder = _folder(spark, fixed.SESSIONS_TABLE)
        settle(spark, folder)
        with shuffles_released(spark):
            good.write.partitionBy(MONTH, BATCH).parquet(folder + REPLACEMENT, compression=CODEC)
        _swap(spark, folder)
        # the table knows its months anew
        spark.sql(f"DROP TABLE {fixed.SESSIONS_TABLE}")
        _declare(spark, fixed.SESSIONS_TABLE, _SESSIONS, folder, f"PARTITIONED BY ({MONTH}, {BATCH})")
    else:
        with shuffles_released(spark):
            good.write.insertInto(fixed.SESSIONS_TABLE, overwrite=True)
    counts = dict(seen.get)
    _note_next_id(spark, counts.pop("last_id") + 1)
    by_reason = {reason: n for key, reason in reasons.items() if (n := counts.pop(key))}
    months, untimed = list(counts.pop("months")), counts.pop("untimed")
    summary = _beside(_folder(spark, fixed.SESSIONS_TABLE))
    if _files(spark, summary).exists(_path(spark, f"{summary}/days")):
        if replace:
            refresh_days(spark.table(fixed.SESSIONS_TABLE).drop(MONTH), summary)
        else:
            keep_summary(spark, months + [None] * bool(untimed))
    copy = _beside(_folder(spark, fixed.SESSIONS_TABLE), CLUSTERED)
    if _files(spark, copy).exists(_path(spark, copy)):
        if replace:
            refresh_clustered(spark.table(fixed.SESSIONS_TABLE).drop(MONTH), copy)
        else:
            keep_clustered(spark, months + [None] * bool(untimed))
    return counts, replaced(parsed, refused=by_reason)


def _own_batch() -> str:
    return f"load-{uuid.uuid4().hex}"


def load_stations(
    spark: SparkSession, paths: str | Sequence[str], multiline: bool = False
) -> tuple[dict[str, int], Parsed]:
    """Adds stations whose id is not stored yet; of several rows with one id the first stays."""
    parsed = read_stations(spark, paths, multiline)
    known = open_stations(spark).select("station_id")
    new = first_per_station(parsed.loaded).join(known, "station_id", "left_anti")
    written = Observation("stations")
    new.select(
        *[name for _, name, _ in fixed.STATION_COLUMNS], F.current_timestamp().alias("created_at")
    ).observe(written, F.count(F.lit(1)).alias("inserted")).write.insertInto(fixed.STATIONS_TABLE)
    lines = {row[REASON]: row.lines for row in parsed.counts().collect()}
    counts = {"processed": lines.pop(None, 0), "skipped": sum(lines.values()), **written.get}
    return counts, replaced(parsed, refused=lines)


def load_all(
    spark: SparkSession,
    session_paths: str | Sequence[str],
    station_paths: str | Sequence[str],
    replace: bool = False,
) -> dict[str, dict[str, Any]]:
    """Creates the tables if needed, loads both kinds of files and keeps the lines it refuses."""
    create_tables(spark)
    session_counts, sessions = load_sessions(spark, session_paths, replace)
    station_counts, stations = load_stations(spark, station_paths)
    for table, counts, parsed in (
        (fixed.SESSIONS_TABLE, session_counts, sessions),
        (fixed.STATIONS_TABLE, station_counts, stations),
    ):
        if counts["skipped"]:
            keep_rejects(spark, table, parsed)
            counts["reasons"] = dict(parsed.refused)
    return {fixed.SESSIONS_TABLE: session_counts, fixed.STATIONS_TABLE: station_counts}


def keep_rejects(spark: SparkSession, table: str, parsed: Parsed, batch: str | None = None) -> None:
    """Adds the refused lines of a read to the table of rejects: why, from where, and what the line held.

    Files with refused lines are read once more for that; loads without any
    don't come here. Those of a named batch take the place of earlier ones of it.
    """
    fields = F.to_json("fields", {"ignoreNullFields": "false"})
    rows = parsed.rejects.select(
        F.lit(table).alias("for_table"), REASON, "file", "start", "_line", fields.alias("fields"), F.current_timestamp(),
        F.lit(f"{table}-{batch or _own_batch()}"),
    )
    rows.write.insertInto(fixed.REJECTS_TABLE, overwrite=True)


def open_rejects(spark: SparkSession) -> DataFrame:
    return spark.table(fixed.REJECTS_TABLE).drop(BATCH)


def _clock(moment: datetime) -> Column:
    """As text, because a datetime literal would be shifted to the session's time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _take_next_id(spark: SparkSession) -> int:
    """The first free session id, which the last load has noted at the table.

    The note is taken away until this load has written its rows. If it is
    missing because a load broke off, the stored ids are read instead.
    """
    notes = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {fixed.SESSIONS_TABLE}").collect()}
    spark.sql(f"ALTER TABLE {fixed.SESSIONS_TABLE} UNSET TBLPROPERTIES IF EXISTS ('{NEXT_ID}')")
    if NEXT_ID in notes:
        return int(notes[NEXT_ID])
    highest = spark.table(fixed.SESSIONS_TABLE).agg(F.max("id").alias("id")).first()["id"]
    return 0 if highest is None else highest + 1


def _note_next_id(spark: SparkSession, free: int) -> None:
    spark.sql(f"ALTER TABLE {fixed.SESSIONS_TABLE} SET TBLPROPERTIES ('{NEXT_ID}' = '{free}')")
