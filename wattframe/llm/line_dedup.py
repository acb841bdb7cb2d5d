"""Lines that many documents share, dropped everywhere but in one of them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, lower_ascii, shuffle_partitions, written

#: Documents of one line that meet in a task at least; below that a line is not worth splitting.
_LEAST_SPLIT = 1000


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, carry: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its text without the lines that other documents repeat.

    Texts are split at line breaks; a NULL or empty text is one empty line. A
    line's key is the line without blanks (space and U+0009 to U+000D) at both
    ends, A-Z in lower case. A key of at least ``min_chars`` code points found
    in at least ``min_docs`` documents loses all its lines except those in the
    document with the largest doc_id that has it. The lines that stay are joined
    by line breaks in their order.

    Rows that share a doc_id are one document when documents are counted, and
    rows without doc_id are one more, which never is the largest; every row is
    returned all the same. Other columns are ignored. An empty table gives an
    empty result.

    Keys are exploded and compared by 128-bit hashes. Pairs of key and document
    are made distinct before they are counted, so a line of a third of all
    documents is counted by many tasks; in the join with the counted keys it is
    split by a salt. There are at most four such parts to a shuffle partition.
    A line's place goes back to its document, and the pieces between the places
    that are dropped make up the new text; texts are shuffled once.

    Returns doc_id, text, n_lines and n_dropped, and with ``carry`` all columns
    of the row as ``row``.
    """
    carried = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *carried)
    carried = ["row"] if carry else []
    text_key = [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]
    texts = rows.select("doc_id", *text_key, F.split("text", "\n").alias("lines"), *carried)

    lines = texts.select("doc_id", "t1", "t2", F.posexplode("lines").alias("place", "line"))
    keys = lines.withColumn("key", lower_ascii(F.trim(F.col("line"), F.lit(BLANKS))))
    keys = keys.where(F.char_length("key") >= min_chars).select(
        "doc_id", "t1", "t2", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )
    counted = keys.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2")
    counted = counted.agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= min_docs)
    counted = written(counted, "repeated-lines")

    total = counted.agg(F.sum("n")).first()[0] or 0
    most = max(_LEAST_SPLIT, total // (4 * shuffle_partitions(docs.sparkSession)))
    parts = F.ceil(F.col("n") / most).cast("int")
    split = counted.where(F.col("n") > most).select("h1", "h2", parts.alias("parts"))
    keys = keys.join(F.broadcast(split), ["h1", "h2"], "left")
    keys = keys.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id", "t1"), F.col("parts")).cast("int"), F.lit(0)))
    salted = counted.select("h1", "h2", "last", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"))
    gone = keys.join(salted, ["h1", "h2", "salt"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    # equal texts with one doc_id lose the same places
    gone = gone.groupBy(F.col("doc_id").alias("id"), F.col("t1").alias("u1"), F.col("t2").alias("u2"))
    gone = gone.agg(F.sort_array(F.collect_set("place")).alias("gone"))

    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("t1") == F.col("u1")) & (F.col("t2") == F.col("u2"))
    joined = texts.join(gone, same, "left").select("doc_id", "lines", "gone", *carried)
    n_lines = F.size("lines")
    between = F.transform(
        F.sequence(F.lit(0), F.size("gone")),
        lambda i: F.slice(
            "lines",
            F.coalesce(F.get("gone", i - 1), F.lit(-1)) + 2,
            F.coalesce(F.get("gone", i), n_lines) - F.coalesce(F.get("gone", i - 1), F.lit(-1)) - 1,
        ),
    )
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.flatten(between))
    return joined.select(
        "doc_id",
        F.array_join(kept, "\n").alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        *carried,
    )


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All rows and columns of ``docs``, each text without its repeated lines; a NULL text stays NULL."""
    got = dedup_lines(docs, min_chars, min_docs, carry=True)
    text = F.when(F.col("row.text").isNotNull(), F.col("text")).alias("text")
    return got.select(*(text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))
