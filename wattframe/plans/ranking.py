"""Rank over a whole table without pulling it into one task."""

from collections.abc import Mapping

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# holds every metric: counts, and sums of amounts
_VALUE = "decimal(38,6)"


def with_ranks(top: DataFrame, groups: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
    """Adds to ``top`` the descending rank its rows have among all ``groups``.

    ``metrics`` maps metric column to rank column. ``groups`` is read twice and
    should be staged; ``top`` is a part of its rows, each of which has a key of
    its own. All metrics are ranked in one pass, as rows of metric and value;
    their ranks meet only the values that ``top`` has.
    """
    names = list(metrics)
    row = F.struct(*top.columns).alias("_row")
    shown = top.select(row, F.inline(_as_rows(names)))
    ranks = _ranks(groups.select(F.inline(_as_rows(names))), _edges(groups, names))
    same = (F.col("_metric") == F.col("_of")) & F.col("_value").eqNullSafe(F.col("_ranked"))
    found = shown.join(ranks, same)
    wide = found.groupBy("_row").agg(
        *[F.max(F.when(F.col("_metric") == k, F.col("_rank"))).alias(metrics[name]) for k, name in enumerate(names)]
    )
    return wide.select("_row.*", *metrics.values())


def _as_rows(names: list[str]) -> Column:
    """A row's metrics, each with its number."""
    pairs = [F.struct(F.lit(k).alias("_metric"), F.col(n).cast(_VALUE).alias("_value")) for k, n in enumerate(names)]
    return F.array(*pairs)


def _edges(groups: DataFrame, metrics: list[str]) -> list[list[float]]:
    """Slice edges per metric, as plain numbers.

    Any edges give right ranks, they only balance the slices. Being plain
    numbers they put a value into the same slice in every run of a task.
    """
    slices = max(2, int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    points = [i / slices for i in range(1, slices)]
    found = groups.approxQuantile(metrics, points, 0.25 / slices)
    return [sorted(set(edges)) for edges in found]


def _ranks(values: DataFrame, edges: list[list[float]]) -> DataFrame:
    """One row per metric and value: how many groups lie above it, plus one.

    Equal values are counted together first, so a value shared by most groups
    is one row. Running counts are taken inside each slice and shifted by the
    rows of all higher slices. Missing values form the last slice.
    """
    ties = values.groupBy("_metric", "_value").agg(F.count(F.lit(1)).alias("_ties"))
    sliced = _sliced(ties, edges)

    # one row per metric and slice from here on, as many slices as the session has shuffle partitions
    heights = sliced.groupBy("_metric", "_slice").agg(F.sum("_ties").alias("_rows"))
    above = Window.partitionBy("_metric").orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = heights.select("_metric", "_slice", F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_above"))

    higher = Window.partitionBy("_metric", "_slice").orderBy(F.desc("_value"))
    higher = higher.rowsBetween(Window.unboundedPreceding, -1)
    running = sliced.withColumn("_higher", F.coalesce(F.sum("_ties").over(higher), F.lit(0)))
    ranked = running.join(F.broadcast(offsets), ["_metric", "_slice"])
    rank = F.col("_above") + F.col("_higher") + 1
    return ranked.select(F.col("_metric").alias("_of"), F.col("_value").alias("_ranked"), rank.alias("_rank"))


def _sliced(ties: DataFrame, edges: list[list[float]]) -> DataFrame:
    """Adds the slice of each value, found by binary search among the edges of its metric; -1 for missing values."""
    out, slices = ties, []
    for k, found in enumerate(edges):
        own = F.when(F.col("_metric") == k, F.col("_value").cast("double"))
        if not found:
            slices.append(F.when(own.isNotNull(), F.lit(0)))
            continue
        splits = [float("-inf"), *found, float("inf")]
        search = Bucketizer(splits=splits, inputCol=f"_own{k}", outputCol=f"_slice{k}", handleInvalid="keep")
        out = search.transform(out.withColumn(f"_own{k}", own))
        # a missing value has no slice of its metric
        slices.append(F.when(own.isNotNull(), F.col(f"_slice{k}").cast("int")))
    return out.select(*ties.columns, F.coalesce(*slices, F.lit(-1)).alias("_slice"))
