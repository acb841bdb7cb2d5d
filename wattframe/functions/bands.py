"""Labels for value ranges and the order in which labels are reported."""

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def band_of(value: Column, bands: Sequence[tuple[str, str | None]]) -> Column:
    """Label of the first band that holds the value; NULL stays NULL.

    The lowest band ends just below its edge, every later one includes its
    upper edge, and the last one takes the rest.
    """
    (lowest, lowest_edge), *middle = bands[:-1]
    label = F.when(value < F.lit(Decimal(lowest_edge)), F.lit(lowest))
    for name, edge in middle:
        label = label.when(value <= F.lit(Decimal(edge)), F.lit(name))
    return label.when(value.isNotNull(), F.lit(bands[-1][0]))


def position_in(label: Column, order: Sequence[str]) -> Column:
    """1-based position of a label, NULL (sorted first) for a label outside the list."""
    place = F.array_position(F.array(*[F.lit(name) for name in order]), label)
    return F.nullif(place, F.lit(0).cast("bigint"))


def labels_of(bands: Sequence[tuple[str, str | None]]) -> list[str]:
    return [name for name, _ in bands]
