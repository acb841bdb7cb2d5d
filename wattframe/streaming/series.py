"""Rows to the arrays a chart reads."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed


def chart_series(overview: DataFrame) -> DataFrame:
    """One row (series, data, labels) from the daily overview, newest day first.

    The input is a cut report of a few days, never the sessions themselves.
    """
    points = F.collect_list(F.struct("date", F.col("sessions").cast("double").alias("sessions"), "avg_cost"))
    newest_first = F.reverse(F.array_sort(points))

    def field(name: str):
        return F.transform("points", lambda point: point[name])

    return overview.agg(newest_first.alias("points")).select(
        F.array(*[F.lit(name) for name in fixed.CHART_SERIES]).alias("series"),
        F.array(field("sessions"), field("avg_cost")).alias("data"),
        field("date").alias("labels"),
    )
