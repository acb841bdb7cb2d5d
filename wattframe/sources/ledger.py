"""Files that are loaded once, however often a load is repeated."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .tables import create_tables, keep_rejects, load_sessions, load_stations

#: Files in one batch at most; their names are all that the driver sees of them.
FILES_AT_ONCE = 1000
_FILE = "path string, modificationTime timestamp, length long, content binary"
Counts = dict[str, int]


def load_new_files(
    spark: SparkSession,
    session_folder: str,
    station_folder: str,
    ledger: str,
    files_at_once: int = FILES_AT_ONCE,
) -> dict[str, Counts]:
    """Loads the files of two folders that were not loaded before, stations first.

    ``ledger`` is a folder that remembers which files were taken: the checkpoint
    of a stream over file names, which ends when all present files are taken. A
    file counts as the same by its path; a file that changes later isn't read
    again. Files are taken in batches. The sessions of a batch go to folders that
    bear its number, so a batch that broke off, even after its rows were stored,
    is loaded again in its own place; a repeated load goes on from there. One
    ledger belongs to one pair of tables; one load at a time.

    Returns the lines that this call imported, skipped, processed and inserted,
    by table, and how many files it took.
    """
    create_tables(spark)
    counts: dict[str, Counts] = {fixed.STATIONS_TABLE: {}, fixed.SESSIONS_TABLE: {}}

    def stations(paths: list[str], batch: str) -> None:
        found, parsed = load_stations(spark, paths)
        if found["skipped"]:
            keep_rejects(spark, fixed.STATIONS_TABLE, parsed, batch)
        _add(counts[fixed.STATIONS_TABLE], found, len(paths))

    def sessions(paths: list[str], batch: str) -> None:
        found, parsed = load_sessions(spark, paths, batch=batch)
        if found["skipped"]:
            keep_rejects(spark, fixed.SESSIONS_TABLE, parsed, batch)
        _add(counts[fixed.SESSIONS_TABLE], found, len(paths))

    _take(spark, station_folder, f"{ledger}/stations", files_at_once, stations)
    _take(spark, session_folder, f"{ledger}/sessions", files_at_once, sessions)
    return counts


def _add(counts: Counts, found: Counts, files: int) -> None:
    for name, n in {**found, "files": files}.items():
        counts[name] = counts.get(name, 0) + n


def _take(spark: SparkSession, folder: str, ledger: str, at_once: int, load: Callable[[list[str], str], None]) -> None:
    """Hands the names of files that the ledger doesn't know to ``load``, batch by batch."""
    files = spark.readStream.schema(_FILE).format("binaryFile").option("maxFilesPerTrigger", at_once)
    # only names are asked for, so no file is opened here
    names = files.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(folder).select("path")

    def batch(found: DataFrame, number: int) -> None:
        paths = sorted(row.path for row in found.select(F.col("path")).collect())
        if paths:
            load(paths, f"batch-{number:06d}")

    writer = names.writeStream.foreachBatch(batch).option("checkpointLocation", ledger)
    writer.trigger(availableNow=True).start().awaitTermination()
