"""Exact duplicates by sorting the texts themselves."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, shuffle_partitions, written

#: Characters of a text that splitters can tell apart; texts that begin alike are told apart by a hash.
PREFIX = 64


def exact_groups(docs: DataFrame, keep: str = "largest", carry: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), with the group of equal texts it is in.

    Texts are equal when they are identical after lower-casing A-Z; NULL counts
    as empty. Of each group the row with the largest (or ``smallest``) doc_id
    stays, a row without doc_id last. Of repeated rows with that same doc_id one
    stays. Other columns are ignored. An empty table gives an empty result.

    Sampled splitters deal the normalised texts over ranges, each range is
    sorted, and equal neighbours, compared in full, form the groups. Splitters
    and the sort take the first ``PREFIX`` characters, then a hash, then the
    whole text: the sample that goes to the driver stays small, and a beginning
    that many texts share is split. A text that has more copies than a quarter
    of a mean range is dealt over several: a salt from the doc_id is part of its
    sort key, and the partial groups, one row each, are joined by the digest of
    the text. A count of the hashes finds such texts; there are at most four to
    a partition, whatever the data.

    Returns doc_id, keep_id, group_size, kept and text_sha256, and with
    ``carry`` all columns of the row as ``row``.
    """
    spark = docs.sparkSession
    carried = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []
    rows = docs.select("doc_id", lower_ascii(F.col("text")).alias("norm"), *carried)
    carried = ["row"] if carry else []
    most = max(64, docs.count() // (4 * shuffle_partitions(spark)))
    hashed = rows.select(F.xxhash64("norm").alias("h"))
    hot = hashed.groupBy("h").count().where(F.col("count") > most)
    hot = hot.select("h", F.ceil(F.col("count") / most).cast("int").alias("spread"))
    salt = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("spread")), F.lit(-1)).cast("int")
    rows = rows.withColumn("h", F.xxhash64("norm")).join(F.broadcast(hot), "h", "left")
    salt = F.when(F.col("spread").isNull(), -1).otherwise(salt).alias("salt")
    rows = rows.select("doc_id", F.substring("norm", 1, PREFIX).alias("prefix"), "h", "norm", salt, *carried)

    order = F.desc_nulls_last("doc_id") if keep == "largest" else F.asc_nulls_last("doc_id")
    group = Window.partitionBy("prefix", "h", "norm", "salt")
    ordered = group.orderBy(order)
    grouped = rows.repartitionByRange("prefix", "h", "salt").select(
        "doc_id",
        "salt",
        F.sha2("norm", 256).alias("text_sha256"),
        F.first("doc_id").over(ordered).alias("keep_id"),
        F.row_number().over(ordered).alias("place"),
        F.count("*").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("size"),
        *carried,
    )
    grouped = written(grouped, "exact-groups")

    # one row for each part of a split group; at most one part to a salt of a hot text
    part = grouped.where("salt >= 0 AND place = 1").select("text_sha256", "salt", "keep_id", "size")
    best = F.max_by if keep == "largest" else F.min_by
    rank = F.coalesce("keep_id", F.lit(-(2**63) if keep == "largest" else 2**63 - 1))
    whole = part.groupBy("text_sha256").agg(
        F.sum("size").alias("all"), best("keep_id", rank).alias("best"), best("salt", rank).alias("at")
    )
    joined = grouped.join(F.broadcast(whole), "text_sha256", "left")
    split = F.col("all").isNotNull()
    return joined.select(
        "doc_id",
        F.when(split, F.col("best")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(split, F.col("all")).otherwise(F.col("size")).alias("group_size"),
        ((F.col("place") == 1) & (~split | (F.col("salt") == F.col("at")))).alias("kept"),
        "text_sha256",
        *carried,
    )


def drop_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay of each group of equal texts."""
    return exact_groups(docs, keep, carry=True).where("kept").select("row.*")
