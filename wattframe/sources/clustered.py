"""A copy of the sessions laid out for reports on one user or one station.

What an index is to a database: a report on one key reads the few row groups
that can hold it instead of all sessions.
"""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import measures as m
from .day_summary import PARTS
from .schema import MONTH, SESSION_DDL

#: Sessions in a row group at most: what a report on one key reads or leaves out.
GROUP_ROWS = 100_000
#: Bits of a user's and of a station's hash that order the rows.
_BITS = 16
KEYS = (m.USER, m.STATION)


def refresh_clustered(
    sessions: DataFrame, folder: str, months: Sequence[date | None] | None = None, group_rows: int = GROUP_ROWS
) -> None:
    """Writes the copy of some months (first days; None for sessions without a start time), or of all.

    Inside a month rows are ordered by the interleaved bits of the hashes of user
    and station, so of n row groups a user is in about the square root of n, and
    so is a station; each row group has a bloom filter on both. Rows of one user
    and station follow each other by time and may fill several tasks and files.
    Users or stations that are null are kept, and are a key like others. Columns
    beyond those of ``SESSION_DDL`` are left out; missing ones are null in the copy.

    Only the folders of the given months are rewritten, and one that no session
    is left in stays as it was; without ``months`` all is written anew. The write
    samples the rows for its ranges, so they are read twice.
    """
    if months is not None:
        month = F.trunc(F.to_date(m.START), "month")
        known = [value for value in months if value is not None]
        wanted = month.isin(known) if known else F.lit(False)
        sessions = sessions.where(wanted | month.isNull() if None in months else F.coalesce(wanted, F.lit(False)))
    names = [name for name in (c.split(" ")[0] for c in SESSION_DDL.split(", ")) if name in sessions.columns]
    rows = sessions.select(*names, F.trunc(F.to_date(m.START), "month").alias(MONTH), _interleaved(*KEYS).alias("_place"))
    order = MONTH, "_place", m.START, "id"
    laid_out = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_place")
    writer = laid_out.write.mode("overwrite").partitionBy(MONTH)
    for key in KEYS:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", True)
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", True).option("parquet.block.row.count.limit", group_rows)
    writer.option("partitionOverwriteMode", "static" if months is None else "dynamic").parquet(folder)
    sessions.sparkSession.catalog.refreshByPath(folder)


def _interleaved(*columns: str) -> Column:
    """Bits of the columns' hashes in turn: binary digits read as digits of base 4 leave a free place after each."""
    place = F.lit(0).cast("long")
    for column in columns:
        bits = F.bin(F.pmod(F.xxhash64(column), F.lit(1 << _BITS)))
        place = place * 2 + F.conv(bits, 4, 10).cast("long")
    return place


def open_clustered_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The copy with the columns of the sessions and their month."""
    return spark.read.schema(f"{SESSION_DDL}, {MONTH} date").parquet(folder)


def stored_parts(clustered: DataFrame) -> DataFrame:
    """How many sessions of each month the copy has, and when the newest was stored, as ``stale_months`` compares it."""
    found = clustered.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("as_of"))
    return found.withColumn("kind", F.lit(PARTS))
