"""Text to typed values. A text that does not fit its type gives NULL."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed


def as_decimal(text: Column, decimal_type: str) -> Column:
    """Decimal comma or point; surplus digits are rounded, too large a number is NULL."""
    return F.replace(text, F.lit(fixed.DECIMAL_MARK), F.lit(".")).try_cast(decimal_type)


def as_int(text: Column) -> Column:
    return text.try_cast("int")


def is_whole_number(text: Column) -> Column:
    return text.rlike(r"^[+-]?\d+$")


def as_timestamp(text: Column) -> Column:
    """Day/month/year hour:minute without a time zone, one or two digits each.

    Text of that shape loses its slashes when it is rewritten; any other text
    keeps them or never had them.
    """
    rewritten = F.struct(text.alias("text"), F.regexp_replace(text, fixed.TIME_SHAPE, "20$3-$2-$1 $4:$5:00").alias("rewritten"))
    return bound(bound(rewritten, _moment), _in_century)


def _moment(time: Column) -> Column:
    has_shape = time["text"].contains("/") & ~time["rewritten"].contains("/")
    return F.when(has_shape, time["rewritten"]).try_cast("timestamp_ntz")


def _in_century(moment: Column) -> Column:
    last_century = F.year(moment) >= F.lit(2000 + fixed.FIRST_YEAR_OF_1900S)
    return F.when(last_century, moment - F.make_ym_interval(F.lit(100))).otherwise(moment)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that is computed once, however often ``use`` names it.

    A projection with such a value is compiled in small methods in any session;
    one that spells everything out is a single method that the JVM leaves uncompiled.
    """
    return F.transform(F.array(value), use)[0]
