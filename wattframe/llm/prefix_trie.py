"""The trie of conversations that begin alike."""

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, shuffle_partitions, word_count, written
from .tree_contraction import subtree_sums

#: Conversations in a row of which the first one's beginning is given to the others, and of how many turns at most.
SHARED, MOST_TURNS = 20, 4
#: Children of one node that meet in a task at least; below that a node is not worth splitting.
_LEAST_SPLIT = 1000
#: Characters of ids that are joined before they are shuffled.
_PIECE = 1 << 20
_ROOT = b"\0" * 16


def in_order(turns: DataFrame) -> DataFrame:
    """The turns of each conversation with their place, from 0, and without their texts.

    Turns go in the order of turn, NULL first; ties in that of role and of hashes
    of role and text. A NULL role or text is empty. Returns conv_id, place, a and
    b (128 bits of role and text) and words (of the text).
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"),
        word_count(text).alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "a", "b")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "a", "b", "words")


def with_shared_beginnings(placed: DataFrame) -> DataFrame:
    """Turns as ``in_order`` gives them, where each conversation begins as the first one of its twenty, for trials.

    The first h turns (all if fewer, none if absent) of the conversation with the
    number c - c % 20 take the place of the first h turns of conversation c; h is
    crc32 of the decimal c, modulo 4. Remainders have the sign of c. A
    conversation without number stays as it is. Adds part, which goes before
    place in the order of turns; each conversation has a row of part -1 without turn.
    """
    taken = F.when(F.col("conv_id").isNull(), 0).otherwise(F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_TURNS)
    first = F.col("conv_id") - F.col("conv_id") % SHARED
    own = placed.where(F.col("place") >= taken).withColumn("part", F.lit(1))
    begun = placed.where("place = 0")
    given = begun.where(taken > 0).select("conv_id", taken.alias("h"), first.alias("first"))
    heads = placed.where((F.col("conv_id") == first) & (F.col("place") < MOST_TURNS - 1))
    given = given.join(heads.withColumnRenamed("conv_id", "first"), "first").where("place < h").drop("h", "first")
    return own.unionByName(given.withColumn("part", F.lit(0))).unionByName(_marks(begun))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per distinct beginning of conversations, from turns as ``in_order`` or ``with_shared_beginnings`` give them.

    A node of depth d is a sequence of d turns (role and text); conversations
    that begin with it are its members, the root has none of the turns and all
    members. Returns conv_id (the smallest member), depth, parent_conv_id (that
    of the node one turn shorter), n_convs (members), n_children, n_leaves
    (childless nodes at or below it), saved_tokens (words of its last turn, once
    per member but one, over all nodes at or below it) and ends_sha256 (of the
    decimal numbers, in order and joined by commas, of the members that have no
    further turn). Rows without conv_id are one conversation; it comes after all
    others and its number is written as nothing. Other columns are ignored; no
    rows give an empty table.

    Rows are dealt by conversation and sorted; a chain of 128-bit hashes names
    the beginnings, a turn at a time. Beginnings are counted after partial
    counts, so the root is no hot key. Sums over subtrees come from tree
    contraction. Numbers that one digest needs are joined range by range and
    read in order as a stream.
    """
    prepare(turns.sparkSession)
    if "part" not in turns.columns:
        turns = turns.withColumn("part", F.lit(1)).unionByName(_marks(turns.where("place = 0")))
    rows = turns.select("conv_id", "part", "place", "a", "b", "words").repartition("conv_id")
    rows = rows.sortWithinPartitions(F.asc_nulls_first("conv_id"), "part", "place")
    begun = "conv_id long, depth long, key binary, parent binary, words long, ends boolean"
    begun = written(rows.mapInArrow(_beginnings, begun), "beginnings")

    nodes = begun.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent"),
        F.max("words").alias("words"),
        F.count("*").alias("n_convs"),
    )
    nodes = written(nodes, "nodes")
    below = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(below, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes, "nodes")

    own = nodes.select(
        "key",
        "parent",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    named = _with_parents(nodes)
    found = named.join(subtree_sums(own, ["n_leaves", "saved_tokens"]), "key").join(_ends(begun), "key", "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _marks(begun: DataFrame) -> DataFrame:
    nothing = {"part": F.lit(-1), "place": F.lit(0), "a": F.lit(0).cast("long"), "b": F.lit(0).cast("long"), "words": F.lit(0).cast("long")}
    return begun.select("conv_id", *(c.alias(name) for name, c in nothing.items()))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Adds parent_conv_id. Nodes with many children, few by their number of rows, are broadcast; others are joined."""
    most = max(_LEAST_SPLIT, nodes.count() // (4 * shuffle_partitions(nodes.sparkSession)))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    wide = parents.where(F.col("n_children") > most).select("parent", F.col("parent_conv_id").alias("wide"), F.lit(True).alias("is_wide"))
    nodes = nodes.join(F.broadcast(wide), "parent", "left")
    narrow = parents.where((F.col("n_children") > 0) & (F.col("n_children") <= most)).drop("n_children")
    # children of a wide node look for nothing, each for another one
    sought = F.when(F.col("is_wide").isNull(), F.col("parent")).otherwise(F.col("key"))
    narrow = narrow.withColumnRenamed("parent", "sought")
    found = nodes.withColumn("sought", F.when(F.col("parent").isNull(), F.col("parent")).otherwise(sought))
    look = (found["sought"] == narrow["sought"]) & found["is_wide"].isNull()
    found = found.join(narrow, look, "left")
    return found.select("key", "conv_id", "depth", "n_convs", "n_children", F.coalesce("wide", "parent_conv_id").alias("parent_conv_id"))


def _beginnings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the beginnings of conversations, a row per turn; the last turn of each is marked."""
    last: tuple | None = None
    for batch in batches:
        done: dict[str, list] = {c: [] for c in ("conv_id", "depth", "key", "parent", "words", "ends")}
        columns = (batch[c].to_pylist() for c in ("conv_id", "part", "a", "b", "words"))
        for conv_id, part, a, b, words in zip(*columns, strict=True):
            if part < 0:
                row = (conv_id, 0, _ROOT, None, 0)
            else:
                turn = a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True)
                row = (conv_id, last[1] + 1, hashlib.blake2b(last[2] + turn, digest_size=16).digest(), last[2], words)
            if last is not None:
                _add(done, last, part < 0)
            last = row
        yield _named(done)
    if last is not None:
        done = {c: [] for c in ("conv_id", "depth", "key", "parent", "words", "ends")}
        _add(done, last, True)
        yield _named(done)


def _add(done: dict[str, list], row: tuple, ends: bool) -> None:
    for name, value in zip(done, (*row, ends), strict=True):
        done[name].append(value)


def _named(done: dict[str, list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(done.values(), kinds, strict=True)], names=list(done))


def _ends(begun: DataFrame) -> DataFrame:
    """key and ends_sha256 of the nodes at which conversations end."""
    unnamed = F.col("conv_id").isNull()
    order: list[Column | str] = ["key", "unnamed", "conv_id"]
    ended = begun.where("ends").select("key", unnamed.alias("unnamed"), F.coalesce("conv_id", F.lit(0)).alias("conv_id"))
    ended = ended.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ended.mapInArrow(_joined, "key binary, unnamed boolean, conv_id long, ids string")
    pieces = pieces.repartition("key").sortWithinPartitions(*order)
    return pieces.mapInArrow(_digests, "key binary, ends_sha256 string")


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of one node and a range of conversations, joined by commas, in pieces of bounded size."""
    names = ["key", "unnamed", "conv_id", "ids"]
    kinds = (pa.binary(), pa.bool_(), pa.int64(), pa.string())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    done: list[tuple] = []
    first: tuple | None = None
    ids: list[str] = []
    size = 0
    for rows in batches:
        for key, unnamed, conv_id in zip(*(rows[c].to_pylist() for c in names[:3]), strict=True):
            if first is not None and (key != first[0] or size >= _PIECE):
                done.append((*first, ",".join(ids)))
                first, ids, size = None, [], 0
            first = first or (key, unnamed, conv_id)
            ids.append("" if unnamed else str(conv_id))
            size += len(ids[-1]) + 1
        if done:
            yield batch(done)
            done = []
    if first is not None:
        yield batch([(*first, ",".join(ids))])


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, joined by commas."""

    def batch(keys: list[bytes], found: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["key", "ends_sha256"])

    last, digest = None, hashlib.sha256()
    for rows in batches:
        keys, found = [], []
        for key, ids in zip(rows["key"].to_pylist(), rows["ids"].to_pylist(), strict=True):
            if last is not None and key != last:
                keys.append(last)
                found.append(digest.hexdigest())
                digest = hashlib.sha256()
            elif last is not None:
                digest.update(b",")
            digest.update(ids.encode())
            last = key
        if keys:
            yield batch(keys, found)
    if last is not None:
        yield batch([last], [digest.hexdigest()])
