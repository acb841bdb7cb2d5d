"""Days of a stream stored once they are over, and the sessions that came too late for them."""

from datetime import datetime
from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as fixed
from ..functions import calendar as cal
from ..functions.rounding import mean_of_parts, published
from ..plans import measures as m
from ..sources.schema import BATCH, REJECT_DDL

LATE, UNTIMED = "came after its day was closed", "no start time"
_MEASURES = {m.ENERGY: "energy", m.COST: "cost", m.HOURS: "hours"}
_PARTS = "n bigint, " + ", ".join(f"{c}_sum decimal(38,3), {c}_n bigint" for c in _MEASURES.values())
_PARTS += ", users binary, date date, batch_id bigint"
_MARKS = "batch_id bigint, newest timestamp_ntz, slot int"
#: Registers of a sketch of users, as a power of two: 4096 of a byte each.
PRECISION = 12
_PERIODS = ("day", "week", "month", "year")


def start_closed_days(
    sessions: DataFrame,
    folder: str,
    checkpoint: str,
    delay: str = "1 hour",
    interval: str | None = fixed.REFRESH_INTERVAL,
    precision: int = PRECISION,
) -> StreamingQuery:
    """Keeps figures of each day in ``folder``; sessions that no figure counts go to the table of rejects.

    A day is closed once a batch has begun after a session was seen that started
    ``delay`` after the day's end. A session of a closed day is late: it changes
    nothing any more and is kept, with all its fields, in the table of rejects
    (see ``create_tables``), as is a session without a start time. Counted and
    kept sessions are all sessions.

    A batch writes what it adds to a day to a folder of its own, so one that
    broke off comes again in its own place; its figures count once its mark, the
    newest time seen so far, is stored. The two newest marks are kept; nothing
    else comes to the driver. Days and marks belong to one checkpoint. Without
    an interval all present input is processed and the query ends.

    The figures of a day include a sketch of its users, of about 2 to the power
    of ``precision`` bytes (4 to 21); see :func:`closed_users`.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = [row for row in _marks(spark, folder).collect() if row.batch_id < number]
        newest = max((row.newest for row in seen if row.newest is not None), default=None)
        batch = batch.persist()
        try:
            day = cal.day_of(m.START)
            reason = F.when(F.col(m.START).isNull(), UNTIMED).when(_closed(day, newest, delay), LATE)
            rows = batch.select("*", reason.alias("_reason"))
            parts = rows.where("_reason IS NULL").groupBy(day.alias("date")).agg(
                F.count(F.lit(1)).alias("n"),
                *(F.sum(c).cast("decimal(38,3)").alias(f"{name}_sum") for c, name in _MEASURES.items()),
                *(F.count(c).alias(f"{name}_n") for c, name in _MEASURES.items()),
                F.hll_sketch_agg(m.USER, F.lit(precision)).alias("users"),
            )
            _put(parts.withColumn("batch_id", F.lit(number).cast("long")), f"{folder}/parts", "date", "batch_id")
            _keep(rows.where("_reason IS NOT NULL"), f"{folder.rstrip('/').rsplit('/', 1)[-1]}-{number:06d}")
            mark = batch.agg(F.max(m.START).alias("newest")).select(
                F.lit(number).cast("long").alias("batch_id"),
                F.greatest("newest", _clock(newest)).alias("newest"),
                F.lit(number % 2).alias("slot"),
            )
            _put(mark, f"{folder}/marks", "slot")
        finally:
            batch.unpersist()

    when = {"processingTime": interval} if interval else {"availableNow": True}
    writer = sessions.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**when).start()


def _clock(moment: datetime | None) -> Column:
    return F.lit(None if moment is None else moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _closed(day: Column, newest: datetime | None, delay: str) -> Column:
    """Whether nothing is added to a day any more, from the newest start time that was seen."""
    over = F.date_add(day, 1).cast("timestamp_ntz") + F.expr(f"INTERVAL {delay}")
    return F.coalesce(over <= _clock(newest), F.lit(False))


def _put(rows: DataFrame, folder: str, *parts: str) -> None:
    """Replaces the folders that the rows belong to."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(folder)


def _keep(rows: DataFrame, batch: str) -> None:
    names = [c for c in rows.columns if c != "_reason"]
    kept = rows.select(
        F.lit(fixed.SESSIONS_TABLE),
        "_reason",
        F.lit(None).cast("string"),
        F.lit(None).cast("long"),
        F.lit(None).cast("string"),
        F.to_json(F.struct(*(F.col(f"`{c}`") for c in names)), {"ignoreNullFields": "false"}),
        F.current_timestamp(),
        F.lit(batch),
    ).toDF(*(c.split(" ")[0] for c in REJECT_DDL.split(", ")), BATCH)
    kept.write.insertInto(fixed.REJECTS_TABLE, overwrite=True)


def _marks(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(spark, f"{folder}/marks", _MARKS)


def _stored(spark: SparkSession, folder: str, columns: str) -> DataFrame:
    """What is stored in a folder; nothing, before the first batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(folder)


def _counted(spark: SparkSession, folder: str, delay: str, still_open: bool) -> DataFrame:
    """The stored parts of days that count, one row per day and batch."""
    marks = _marks(spark, folder).orderBy(F.desc("batch_id")).limit(1).collect()
    last, newest = (marks[0].batch_id, marks[0].newest) if marks else (-1, None)
    parts = _stored(spark, f"{folder}/parts", _PARTS).where(F.col("batch_id") <= last)
    return parts if still_open else parts.where(_closed(F.col("date"), newest, delay))


def closed_days(spark: SparkSession, folder: str, delay: str = "1 hour", still_open: bool = False) -> DataFrame:
    """Volume of each day that can no longer change, or of ``still_open`` ones too; what ``daily_windows`` gives, with late rows kept.

    Closed is what the next batch will take for closed. Parts of a batch that
    broke off are not counted.
    """
    parts = _counted(spark, folder, delay, still_open)
    sums = [c for c in parts.columns if c not in ("users", "date", "batch_id")]
    found = parts.groupBy("date").agg(*(F.sum(c).alias(c) for c in sums))

    def mean(name: str, scale: int) -> Column:
        return published(mean_of_parts(F.col(f"{name}_sum"), F.col(f"{name}_n"), scale))

    return found.select(
        "date",
        F.col("n").alias("total_sessions"),
        published(F.col("energy_sum")).alias("total_energy_kwh"),
        mean("energy", 2).alias("avg_energy_kwh"),
        published(F.col("cost_sum")).alias("total_revenue"),
        mean("cost", 2).alias("avg_cost"),
        mean("hours", 3).alias("avg_duration_hours"),
    )


def closed_users(
    spark: SparkSession, folder: str, by: str = "day", delay: str = "1 hour", still_open: bool = False
) -> DataFrame:
    """Estimated distinct users per day, week (from Monday), month or year, from the stored sketches of days.

    No session is read: sketches of the period's days are united, so a year costs
    some kilobytes a day. The relative standard error is :func:`users_error` for
    every period, however many days are united; small numbers are exact. Which
    days count is as in :func:`closed_days`; ``days`` says how many did. Users
    that are null count for nobody. If the precision was changed in between, the
    lower one holds for what is united. Days that were stored without a sketch
    give no estimate (null) for their period, rather than one too low.
    """
    if by not in _PERIODS:
        raise ValueError(f"by must be one of {', '.join(_PERIODS)}, not {by!r}")
    first = F.col("date") if by == "day" else F.trunc("date", by)
    united = _counted(spark, folder, delay, still_open).groupBy(first.alias("first_day")).agg(
        F.count_distinct("date").alias("days"),
        F.hll_union_agg("users", F.lit(True)).alias("users"),
        F.bool_or(F.col("users").isNull()).alias("lacking"),
    )
    return united.select(
        "first_day", "days", F.when(~F.col("lacking"), F.hll_sketch_estimate("users")).alias("unique_users")
    )


def users_error(precision: int = PRECISION) -> float:
    """Relative standard error of an estimate of users from sketches of this precision."""
    return 1.04 / sqrt(1 << precision)
