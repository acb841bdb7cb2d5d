"""The daily overview as a stored table that a stream keeps up."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as fixed
from ..functions import calendar as cal
from ..functions.rounding import mean_of_parts, published
from ..plans import measures as m

#: The day in the folder names; sessions without a start time have one of their own.
_DAY = "day"
_COLUMNS = (
    f"date date, sessions bigint, {m.ENERGY}_sum decimal(38,2), {m.COST}_sum decimal(38,2), {m.COST}_n bigint, "
    f"batch_id bigint, {_DAY} date"
)


def start_stored_overview(
    sessions: DataFrame, folder: str, checkpoint: str, interval: str | None = fixed.REFRESH_INTERVAL
) -> StreamingQuery:
    """Keeps figures of every day in ``folder``, one folder per day.

    The stream's state is one row per day. A batch hands on the days it changed
    with all they have so far, and only their folders are rewritten, by the
    executors; the driver holds no rows. A batch that broke off, before, while or
    after it wrote, comes again under its number with the same days and puts the
    same rows in their place, so nothing is counted twice or lost. Without an
    interval all present input is processed and the query ends.
    """
    days = sessions.groupBy(cal.day_of(m.START).alias("date")).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum(m.ENERGY).cast("decimal(38,2)").alias(f"{m.ENERGY}_sum"),
        F.sum(m.COST).cast("decimal(38,2)").alias(f"{m.COST}_sum"),
        F.count(m.COST).alias(f"{m.COST}_n"),
    )

    def store(changed: DataFrame, batch_id: int) -> None:
        rows = changed.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn(_DAY, F.col("date"))
        writer = rows.repartition(_DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(_DAY).parquet(folder)

    when = {"processingTime": interval} if interval else {"availableNow": True}
    writer = days.writeStream.outputMode("update").foreachBatch(store)
    return writer.option("checkpointLocation", checkpoint).trigger(**when).start()


def stored_days(spark: SparkSession, folder: str) -> DataFrame:
    """All days that the stream has stored: date, sessions, sums and counts, and the batch that changed the day last."""
    return spark.read.schema(_COLUMNS).parquet(folder).drop(_DAY)


def stored_overview(spark: SparkSession, folder: str, days: int = fixed.OVERVIEW_DAYS) -> DataFrame:
    """The newest days, as ``operators.daily_overview`` gives them; days without a date come last."""
    rows = stored_days(spark, folder).select(
        "date",
        "sessions",
        published(F.col(f"{m.ENERGY}_sum")).alias("energy"),
        published(mean_of_parts(F.col(f"{m.COST}_sum"), F.col(f"{m.COST}_n"), 2)).alias("avg_cost"),
    )
    return rows.orderBy(F.desc("date")).limit(days)
