"""Percentages of a total."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rounding import count_as_decimal, published, ratio
from .staging import staged


def percent(part: Column, whole: Column) -> Column:
    return published(ratio(count_as_decimal(part) * 100, count_as_decimal(whole)))


def share_of_bands(banded: DataFrame, count: str, name: str = "percentage") -> DataFrame:
    """Share of each band among all bands, the NULL band included.

    Bands come from a fixed list, so the unpartitioned window sees a handful of
    rows whatever the size of the data.
    """
    everything = F.sum(count).over(Window.partitionBy())
    return banded.withColumn(name, percent(F.col(count), everything))


def share_of_labels(labelled: DataFrame, count: str, name: str = "percentage") -> DataFrame:
    """Share of each label among all labels.

    Labels are free text and may be many. The aggregated rows are staged, so
    the one-row total does not read the sessions a second time.
    """
    labelled = staged(labelled)
    everything = labelled.agg(F.sum(count)).scalar()
    return labelled.withColumn(name, percent(F.col(count), everything))


def share_of_rows(part: DataFrame, whole: DataFrame, count: str, name: str = "percentage") -> DataFrame:
    """Share of each group among all rows of a table, which reads no column of it."""
    everything = whole.agg(F.count(F.lit(1))).scalar()
    return part.withColumn(name, percent(F.col(count), everything))
