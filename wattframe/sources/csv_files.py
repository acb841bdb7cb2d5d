"""Reading separated text files as trimmed strings, with the shape of each line."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fixed

LINE = "_line"
FIELDS = "_fields"
BLOCK = "_block"
_ONE_BYTE = "".join(c for c in fixed.WHITE_SPACE if c.isascii())


def read_lines(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """Every line of the files that isn't empty, all fields as text under trimmed header names.

    Added columns: the line itself if its number of fields differs from the
    header's, that number of fields, and the block of the file it is in. All
    files of one call share one header. ``multiline`` admits line breaks inside
    quotes, at the price that a file is read by one task.
    """
    reader = spark.read.options(
        sep=fixed.FIELD_SEPARATOR,
        header=True,
        quote='"',
        escape='"',
        encoding="UTF-8",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=LINE,
        multiLine=multiline,
        # a line's shape is only seen when all its fields are parsed
        columnPruning=False,
        # a file whose header differs from the first one's is an error, not read by position
        enforceSchema=False,
    )
    paths = [paths] if isinstance(paths, str) else list(paths)
    header = reader.csv(paths).columns
    if not header:
        raise ValueError(f"no header line in {', '.join(paths)}")
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in [*header, LINE]])
    lines = reader.schema(as_text).csv(paths)
    block = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    width = F.lit(len(header))
    # a line whose last column holds a value has all fields; naming that column also
    # keeps Spark from refusing a query that asks for nothing but odd lines
    at_least = F.when(F.col(f"`{header[-1]}`").isNotNull(), width)
    counted = F.greatest(_count_fields(F.col(LINE)), at_least)
    fields = F.when(F.col(LINE).isNull(), width).otherwise(counted)
    return lines.select(
        *[_trimmed(F.col(f"`{name}`")).alias(name.strip()) for name in header],
        LINE,
        fields.alias(FIELDS),
        block.alias(BLOCK),
    )


def _trimmed(text: Column) -> Column:
    """Without white space at both ends; text of single bytes can only have the few kinds that are one."""
    kinds = F.when(F.length(text) == F.octet_length(text), F.lit(_ONE_BYTE)).otherwise(F.lit(fixed.WHITE_SPACE))
    return F.btrim(text, kinds)


def _count_fields(line: Column) -> Column:
    unquoted = F.regexp_replace(line, r'"(?:[^"]|"")*"', "q")
    return F.size(F.split(unquoted, fixed.FIELD_SEPARATOR))
