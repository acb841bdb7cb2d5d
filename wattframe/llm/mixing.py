"""Mixing sources to target weights that change during training."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import word_count, written

#: (progress, weight) knots from progress 0 to 1; linear in between.
Schedule = Sequence[tuple[float, float]]
#: Slices of a source, by the first digits of a document's key.
_DIGITS = 3


def integral(schedule: Schedule) -> float:
    """The area under a schedule: the weight of its source over the whole training."""
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:], strict=False))


def progress_at(share: Column, schedule: Schedule) -> Column:
    """The progress at which a source with this schedule has used so much of its demand (0 to 1).

    Cumulative demand is a parabola between knots; each piece is inverted.
    """
    whole, done = integral(schedule), 0.0
    found = F.lit(1.0)
    pieces = []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        area = (t1 - t0) * (w0 + w1) / 2
        pieces.append((t0, w0, t1, w1, done, done + area))
        done += area
    for t0, w0, t1, w1, before, after in reversed(pieces):
        rest = share * F.lit(whole) - F.lit(before)
        if w1 == w0:
            inverse = F.lit(t0) + rest / F.lit(w0 if w0 else 1.0)
        else:
            slope = (w1 - w0) / (t1 - t0)
            under = F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * rest)
            inverse = F.lit(t0) + (F.sqrt(under) - F.lit(w0)) / F.lit(slope)
        found = F.when(share * F.lit(whole) <= F.lit(after), inverse).otherwise(found)
    return found


def targets(sizes: DataFrame, schedules: Sequence[Schedule], most_passes: int = 3) -> DataFrame:
    """Words that each source shall give, from rows (source, size).

    Sources take the schedules in turn, in code point order, NULL last. Together
    they give as many words as there are, shared by the schedules' integrals; a
    source gives at most ``most_passes`` times its words, and what it can't give
    is shared among the others. One row per source goes through one window; the
    rows are sources, not documents.
    """
    named = sizes.withColumn("name", _name("source"))
    weight = F.element_at(
        F.array(*(F.lit(float(integral(s))) for s in schedules)), F.pmod("nth", F.lit(len(schedules))) + 1
    )
    per = named.groupBy("name").agg(F.max("source").alias("source"), F.sum("size").alias("source_size"))
    by_code_point = Window.orderBy(F.asc_nulls_last("source"))
    per = per.withColumn("nth", (F.row_number().over(by_code_point) - 1).cast("int")).withColumn("weight", weight)
    per = per.withColumn("most", F.col("source_size") * most_passes)
    # sources reach their limit in the order of limit per weight; from the first that doesn't, all share by weight
    full = Window.orderBy(F.col("most") / F.col("weight"), "nth")
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    per = per.withColumn("level", left.cast("double") / F.sum("weight").over(after))
    per = per.withColumn("rank", F.row_number().over(full))
    level = F.min_by("level", F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("rank"))).over(everything)
    target = F.least(F.col("most").cast("double"), level * F.col("weight"))
    return per.select("name", "source_size", "nth", target.alias("target"))


def _name(source: str) -> Column:
    """A source as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def mix(docs: DataFrame, schedules: Sequence[Schedule], most_passes: int = 3) -> DataFrame:
    """How often each document of ``docs`` (doc_id, text, source) is used, and where in training.

    A source gives whole passes over its documents, then a last pass over those
    that come first by the MD5 of their doc_id until the target is met to half a
    document. Sizes are words (NULL text: 0). NULL doc_ids count as one id, and
    NULL as a source of its own. Repeated rows are documents of their own. Other
    columns are ignored; an empty table gives an empty result.

    Returns doc_id, source, size, source_size, target, taken (words used, all
    passes), passes, and position: the progress (0 to 1) of the first use, NULL
    if there is none; also nth, the source's number, and start, the words of its
    source before it. Each further use comes when the source has given as many
    words more as it has. Prefix sums within a source go in two steps, first
    over slices by the key, so a source with a third of all rows is spread.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"))
    rows = written(rows.withColumns({"slice": F.substring("key", 1, _DIGITS), "name": _name("source")}), "sizes")

    slices = rows.groupBy("name", "slice").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("name", "slice", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    slices = slices.join(targets(rows, schedules, most_passes), "name")
    inside = Window.partitionBy("name", "slice").orderBy("key", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(slices, ["name", "slice"])

    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    start = F.col("offset") + F.col("within")
    rest = F.col("target") - whole * F.col("source_size")
    more = start + F.col("size") / 2 <= rest
    passes = F.least(F.lit(most_passes), whole + F.when(more, 1).otherwise(0)).cast("long")
    return rows.withColumn("passes", passes).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size")).alias("taken"),
        "passes",
        F.when(F.col("passes") > 0, _position(start, schedules)).alias("position"),
        "nth",
        start.alias("start"),
    )


def _position(start: Column, schedules: Sequence[Schedule]) -> Column:
    """Where in training a source's words from ``start`` on are used."""
    share = F.least(F.lit(1.0), (start + F.col("size") / 2) / F.greatest("target", F.lit(1.0)))
    return F.coalesce(
        *(F.when(F.pmod("nth", F.lit(len(schedules))) == k, progress_at(share, s)) for k, s in enumerate(schedules))
    )


def mixed_documents(docs: DataFrame, schedules: Sequence[Schedule], most_passes: int = 3) -> DataFrame:
    """The rows of ``docs``, with all their columns, once per use in training and in the order of use.

    Rows are matched with their uses by doc_id, source and size; rows that share
    all three are used alike. A row without use is left out.
    """
    mixed = mix(docs, schedules, most_passes)
    by = ("doc_id", "source", "size")
    mixed = mixed.groupBy(*by).agg(*(F.max(c).alias(c) for c in ("passes", "source_size", "target", "nth", "start")))
    mixed = mixed.where("passes > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("passes").cast("int") - 1)))
    begin = F.col("turn") * F.col("source_size") + F.col("start")
    uses = mixed.select(*(F.col(c).alias(f"of_{c}") for c in by), _position(begin, schedules).alias("position"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("of_doc_id")) & F.col("row.source").eqNullSafe(F.col("of_source"))
    rows = rows.withColumn("size", word_count(F.col("row.text"))).join(uses, same & (F.col("size") == F.col("of_size")))
    return rows.orderBy("position", "row.doc_id").select("row.*")


def training_order(mixed: DataFrame) -> DataFrame:
    """The rows of :func:`mix` sorted by position over ranges, unused documents last."""
    return mixed.orderBy(F.asc_nulls_last("position"), "doc_id")
