"""Sessions of each day as parts that add up, and as bitmaps of the users and stations seen.

A report on days, weeks or months then reads some rows per day instead of all
sessions. Sums, counts and bitmaps of days are merged to those of any period.
"""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rounding import squared_units
from ..plans import measures as m
from ..plans.staging import staged
from .schema import MONTH

PARTS, USER_BITS, STATION_BITS = "parts", "users", "stations"
_AMOUNT = "decimal(38,3)"
#: Amounts of a day, by name: what is added up, and of which sessions.
_SUMS = {
    "energy_sum": m.ENERGY,
    "cost_sum": m.COST,
    "hours_sum": m.HOURS,
    # sessions with a price that delivered energy
    "charged_cost": f"CASE WHEN {m.ENERGY} > 0 THEN {m.COST} END",
    "charged_energy": f"CASE WHEN {m.ENERGY} > 0 AND {m.COST} IS NOT NULL THEN {m.ENERGY} END",
    # sessions with known energy that took time
    "timed_energy": f"CASE WHEN {m.HOURS} > 0 THEN {m.ENERGY} END",
    "timed_hours": f"CASE WHEN {m.HOURS} > 0 AND {m.ENERGY} IS NOT NULL THEN {m.HOURS} END",
}
COUNTS = {name.removesuffix("_sum") + "_n": value for name, value in _SUMS.items() if name not in ("charged_energy", "timed_hours")}
#: Sums of squares, in units of the last digit.
_SQUARES = {"energy_squares": m.ENERGY, "cost_squares": m.COST, "hours_squares": m.HOURS}
_MEASURES = {"energy": m.ENERGY, "cost": m.COST, "hours": m.HOURS}
SUMS, SQUARES, EXTREMES = list(_SUMS), list(_SQUARES), [f"{c}_{end}" for c in _MEASURES for end in ("min", "max")]
#: kind tells a day's parts from the words of its bitmaps; as_of is when its newest session was stored.
SUMMARY_DDL = ", ".join(
    ["date date", "kind string", "word bigint", "bits bigint", "n bigint", "as_of timestamp"]
    + [f"{c} {_AMOUNT}" for c in SUMS]
    + [f"{c} decimal(38,0)" for c in SQUARES]
    + [f"{c} bigint" for c in COUNTS]
    + [f"{c} {_AMOUNT}" for c in EXTREMES]
    + [f"{MONTH} date"]
)
#: In storage the figures are one column: it is null in the many rows of words, so that sorting them takes little memory.
_FIGURES = ["n", "as_of", *SUMS, *SQUARES, *COUNTS, *EXTREMES]
_DAYS = "figures_of_days"
#: Bits of a word of a bitmap, as a power of two.
_WORD = 6


def refresh_days(sessions: DataFrame, folder: str, months: Sequence[date | None] | None = None) -> None:
    """Summarises the days of some months (first days; None for sessions without a start time), or of all.

    ``sessions`` are all sessions of these months; others are left out. Only the
    folders of these months are rewritten, so a repeated call changes nothing,
    and a broken one can be repeated. Without ``months`` the whole summary is
    written anew.

    Users and stations get dense numbers once, in two dictionaries beside the
    summary; numbers stay. Sessions shrink to pairs of day and user before they
    meet the dictionary, so a busy user or day is no hot key, and 64 users share
    a word of the day's bitmap. No distinct count expands its input.
    """
    spark = sessions.sparkSession
    day = F.to_date(F.col(m.START)).alias("date")
    if months is not None:
        month = F.trunc(F.to_date(F.col(m.START)), "month")
        known = [value for value in months if value is not None]
        wanted = month.isin(known) if known else F.lit(False)
        sessions = sessions.where(wanted | month.isNull() if None in months else F.coalesce(wanted, F.lit(False)))
    stored = F.max("created_at") if "created_at" in sessions.columns else F.lit(None)
    parts = sessions.groupBy(day).agg(
        F.count(F.lit(1)).alias("n"),
        stored.cast("timestamp").alias("as_of"),
        *(F.sum(F.expr(value)).cast(_AMOUNT).alias(name) for name, value in _SUMS.items()),
        *(F.count(F.expr(value)).alias(name) for name, value in COUNTS.items()),
        *(F.sum(squared_units(F.col(c), m.SCALES[c])).alias(name) for name, c in _SQUARES.items()),
        *(F.min(c).cast(_AMOUNT).alias(f"{name}_min") for name, c in _MEASURES.items()),
        *(F.max(c).cast(_AMOUNT).alias(f"{name}_max") for name, c in _MEASURES.items()),
    )
    stored_types = {c.split(" ")[0]: c.split(" ")[1] for c in SUMMARY_DDL.split(", ")}
    figures = F.struct(*(F.col(c).cast(stored_types[c]).alias(c) for c in _FIGURES)).alias(_DAYS)
    rows = parts.select("date", F.lit(PARTS).alias("kind"), figures)
    for kind, column in ((USER_BITS, m.USER), (STATION_BITS, m.STATION)):
        pairs = sessions.where(F.col(column).isNotNull()).select(day, F.col(column).alias("value")).distinct()
        pairs = staged(pairs)
        numbers = _numbered(pairs.select("value").distinct(), f"{folder}/{kind}")
        found = pairs.join(numbers, "value").select("date", F.shiftright("number", _WORD).alias("word"), _bit("number"))
        bits = found.groupBy("date", "word").agg(F.bit_or("bit").alias("bits"))
        rows = rows.unionByName(bits.withColumn("kind", F.lit(kind)), allowMissingColumns=True)
    rows = rows.withColumn(MONTH, F.trunc("date", "month"))
    writer = rows.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH)
    mode = "static" if months is None else "dynamic"
    writer.option("partitionOverwriteMode", mode).parquet(f"{folder}/days")
    spark.catalog.refreshByPath(folder)


def _bit(number: str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (F.col(number) % (1 << _WORD)).cast("int")).alias("bit")


def _numbered(values: DataFrame, folder: str) -> DataFrame:
    """The numbers of distinct values, from a dictionary that new ones are added to."""
    spark = values.sparkSession
    known = _dictionary(spark, folder)
    new = values.join(known, "value", "left_anti").select("value", F.monotonically_increasing_id().alias("place"))
    new = staged(new)
    # one row per task from here on
    sizes = new.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    within = F.col("place") - F.shiftleft(F.shiftright("place", 33), 33)
    added = new.join(F.broadcast(starts), F.shiftright("place", 33) == F.col("part"))
    added = added.select("value", (F.lit(first) + F.col("start") + within).cast("long").alias("number"))
    added.write.mode("append").parquet(folder)
    return _dictionary(spark, folder)


def _dictionary(spark: SparkSession, folder: str) -> DataFrame:
    schema = "value string, number long"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def open_days(spark: SparkSession, folder: str) -> DataFrame:
    """The stored summary, for the reports in ``operators.days``; also one whose figures were stored as columns of their own."""
    types = dict(c.split(" ") for c in SUMMARY_DDL.split(", "))
    figures = ", ".join(f"{c}: {types[c]}" for c in _FIGURES)
    rows = spark.read.schema(f"{SUMMARY_DDL}, {_DAYS} struct<{figures}>").parquet(f"{folder}/days")
    return rows.select(*(F.coalesce(f"{_DAYS}.{c}", c).alias(c) if c in _FIGURES else F.col(c) for c in types))


def _added_up() -> list[Column]:
    kept = [F.sum(c).alias(c) for c in ("n", *SUMS, *SQUARES, *COUNTS)]
    kept += [(F.min if c.endswith("_min") else F.max)(c).alias(c) for c in EXTREMES]
    return [*kept, *(F.min(c).alias(c) for c in ("first_day", "first_priced", "first_charged")), F.max("last_day").alias("last_day")]


def summed(summary: DataFrame, **period: Column) -> DataFrame:
    """One row per period of days: sums, counts, extremes, first_day and last_day. No bitmap is read."""
    days = summary.where(F.col("kind") == PARTS).withColumns(
        {
            **dict.fromkeys(("first_day", "last_day"), F.col("date")),
            "first_priced": F.when(F.col("cost_n") > 0, F.col("date")),
            "first_charged": F.when(F.col("charged_cost_n") > 0, F.col("date")),
        }
    )
    return days.groupBy(*(value.alias(name) for name, value in period.items())).agg(*_added_up())


def merged(summary: DataFrame, **period: Column) -> DataFrame:
    """One row per period of days: what :func:`summed` gives, unique_users and stations_used.

    Equal words of the period's days are united before their bits are counted.
    Words are many, so they are grouped without the figures of days.
    """
    keys = list(period)
    words = summary.where(F.col("kind") != PARTS).groupBy(*(v.alias(k) for k, v in period.items()), "kind", "word")
    united = words.agg(F.bit_count(F.bit_or("bits")).cast("long").alias("seen"))
    names = {"unique_users": USER_BITS, "stations_used": STATION_BITS}
    seen = united.groupBy(*keys).agg(*(F.sum(F.when(F.col("kind") == kind, F.col("seen"))).alias(c) for c, kind in names.items()))
    both = summed(summary, **period).unionByName(seen, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*_added_up(), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names))


def stale_months(sessions: DataFrame, summary: DataFrame) -> list[date | None]:
    """Months whose stored sessions (with start month and created_at) differ from the summary in number or in time of storing."""
    now = sessions.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("as_of"))
    then = summary.where(F.col("kind") == PARTS).groupBy(F.col(MONTH).alias("then")).agg(
        F.sum("n").alias("then_n"), F.max("as_of").alias("then_as_of")
    )
    both = now.join(then, F.col(MONTH).eqNullSafe(F.col("then")), "full")
    odd = ~(F.col("n").eqNullSafe(F.col("then_n")) & F.col("as_of").eqNullSafe(F.col("then_as_of")))
    return [row[0] for row in both.where(odd).select(F.coalesce(MONTH, "then")).collect()]
