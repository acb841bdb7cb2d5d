"""Files to typed rows: what is loaded, what is refused and why."""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from . import parsing
from .csv_files import BLOCK, FIELDS, LINE, read_lines
from .schema import text_length

REASON = "reject_reason"
ORDER = "_order"
RAW = "_raw"

# text columns in which a present but empty field stays empty text
_KEEP_EMPTY = {"user_id", "vehicle_model", "charging_station_id", "station_id", "distrito", "concelho", "freguesia"}

Declared = Sequence[tuple[str, str, str]]


@dataclass(frozen=True)
class Parsed:
    """All lines of one read: typed columns plus the reason why a line is refused."""

    lines: DataFrame
    columns: Sequence[str]
    # the reasons there can be, and how many lines a load has refused for each
    reasons: Sequence[str] = ()
    refused: Mapping[str, int] = field(default_factory=dict)
    # what tells each reason, in the order in which they count
    problems: Mapping[str, Column] = field(default_factory=dict)

    @property
    def loaded(self) -> DataFrame:
        return self.lines.where(F.col(REASON).isNull()).select(*self.columns)

    @property
    def rejects(self) -> DataFrame:
        lines = self.lines
        if self.refused and all(reason in self.problems for reason in self.refused):
            # after a load only its reasons are looked for; values that none of them needs aren't parsed again
            lines = lines.withColumn(REASON, _first([c for reason, c in self.problems.items() if reason in self.refused]))
        refused = lines.where(F.col(REASON).isNotNull())
        return refused.select(REASON, f"{ORDER}.file", f"{ORDER}.start", LINE, F.col(RAW).alias("fields"))

    def counts(self) -> DataFrame:
        """Loaded and skipped lines, one row per reason; loaded lines have none."""
        return self.lines.groupBy(REASON).agg(F.count(F.lit(1)).alias("lines"))


def read_sessions(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False) -> Parsed:
    """Session files. A line is refused if its shape, a time or a value does not fit."""
    typed = _typed(read_lines(spark, paths, multiline), fixed.SESSION_COLUMNS, _value)
    return _parsed(typed, fixed.SESSION_COLUMNS, _problems(typed, fixed.SESSION_COLUMNS))


def read_stations(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False) -> Parsed:
    """Station files. A value that does not fit is dropped or cut and listed in ``warnings``."""
    typed = _typed(read_lines(spark, paths, multiline), fixed.STATION_COLUMNS, _fitted_value)
    warnings = F.array(*_problems(typed, fixed.STATION_COLUMNS, too_long="cut")).cast("array<string>")
    noted = typed.withColumn("warnings", F.array_compact(warnings))
    return _parsed(noted, fixed.STATION_COLUMNS, [], "warnings")


def first_per_station(stations: DataFrame) -> DataFrame:
    """Of several rows with one station id the first in file order.

    Rows are compared as they are grouped, so copies shrink before the shuffle.
    """
    rest = [c for c in stations.columns if c not in ("station_id", ORDER)]
    first = F.min_by(F.struct(*rest), F.col(ORDER)).alias("_first")
    return stations.groupBy("station_id").agg(first).select("station_id", "_first.*")


# --- values ------------------------------------------------------------------------------


def _typed(lines: DataFrame, columns: Declared, value: Callable[[Column, str, str], Column]) -> DataFrame:
    """Typed values beside the fields as read.

    Each value is computed once: the row number in this projection keeps later
    conditions on the values from being moved below it and computed again.
    """
    values = [value(_text(lines, header, name), name, kind).alias(name) for header, name, kind in columns]
    fields = [lines[f"`{c}`"].alias(c) for c in lines.columns if c not in (LINE, FIELDS, BLOCK)]
    place = F.struct(f"{BLOCK}.file", f"{BLOCK}.start", F.monotonically_increasing_id().alias("row"))
    return lines.select(*values, LINE, FIELDS, F.struct(*fields).alias(RAW), place.alias(ORDER))


def _text(lines: DataFrame, header: str, name: str) -> Column:
    """Field text; empty is kept for names, NULL for a field the line or the file lacks."""
    if header not in lines.columns:
        return F.lit(None).cast("string")
    text = lines[f"`{header}`"]
    if name not in _KEEP_EMPTY:
        return text
    place = lines.columns.index(header)
    return F.when(lines[FIELDS] > place, F.coalesce(text, F.lit("")))


def _value(text: Column, name: str, kind: str) -> Column:
    if text_length(kind) is not None:
        return text if name in _KEEP_EMPTY else F.nullif(text, F.lit(""))
    if kind == "timestamp_ntz":
        return parsing.as_timestamp(text)
    return parsing.as_int(text) if kind == "int" else parsing.as_decimal(text, kind)


def _fitted_value(text: Column, name: str, kind: str) -> Column:
    """As above, but text is cut to its length and a key is never missing."""
    value = _value(text, name, kind)
    length = text_length(kind)
    if length is None:
        return value
    return F.left(F.coalesce(value, F.lit("")) if name == "station_id" else value, F.lit(length))


# --- problems ----------------------------------------------------------------------------


def _problems(typed: DataFrame, columns: Declared, too_long: str = "too long") -> list[Column]:
    present = typed.schema[RAW].dataType.names
    return [_problem(header, name, kind, too_long) for header, name, kind in columns if header in present]


def _problem(header: str, name: str, kind: str, too_long: str) -> Column:
    """What is wrong with a value, NULL if nothing."""
    note = _reason(name, kind, too_long)
    text, value = F.col(RAW).getField(header), F.col(name)
    length = text_length(kind)
    if length is not None:
        return _note(F.length(text) > length, note)
    if kind == "timestamp_ntz":
        return _note(value.isNull(), note)
    if kind == "int":
        # text that is no number is only dropped; a number beyond the type is a problem
        return _note(value.isNull() & parsing.is_whole_number(text), note)
    return _note(value.isNull() & (text != F.lit("")), note)


def _reason(name: str, kind: str, too_long: str = "too long") -> str:
    if text_length(kind) is not None:
        return f"{too_long}: {name}"
    kinds = {"timestamp_ntz": "bad time", "int": "out of range"}
    return f"{kinds.get(kind, 'bad number')}: {name}"


def _note(condition: Column, text: str) -> Column:
    return F.when(condition, F.lit(text))


def _parsed(typed: DataFrame, columns: Declared, problems: list[Column], *extra: str) -> Parsed:
    """A column the files lack refuses every line; otherwise surplus fields refuse theirs."""
    present = typed.schema[RAW].dataType.names
    missing = [header for header, _, _ in columns if header not in present]
    if missing:
        # a condition on the line, so that refused lines are still read and counted
        problems = [_note(F.col(FIELDS) > 0, f"missing column: {missing[0]}")]
    else:
        problems = [_note(F.col(FIELDS) > len(present), "too many fields"), *problems]
    names = [name for _, name, _ in columns]
    reasons = [f"missing column: {missing[0]}"] if missing else ["too many fields"]
    if not missing and len(problems) > 1:
        reasons += [_reason(name, kind) for _, name, kind in columns]
    found = dict(zip(reasons, problems, strict=True))
    return Parsed(typed.withColumn(REASON, _first(problems)), [*names, *extra, ORDER], reasons, problems=found)


def _first(problems: list[Column]) -> Column:
    """The first problem of a line.

    No row number is below 0; a reason that names it keeps the projection of the
    values, below which no condition moves, also where the order is dropped: else
    each value is computed again wherever a problem names it.
    """
    return F.when(F.col(f"{ORDER}.row") >= 0, F.coalesce(*problems))
