"""Packing documents into training sequences, with a bound that certifies how few there are."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .tokens import worker_encoder

#: Pieces that one task packs at once, on average.
PIECES_PER_GROUP = 16_384
#: Least filled sequences that a certified group gives back, to be filled by others.
GIVEN_BACK = 16
_MOST_ROUNDS = 12

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """The documents' ids, each with ``end_id`` behind, cut where a document is longer than ``capacity``.

    All pieces of a cut document are full but the first, which may be shorter.
    NULL counts as empty, so every document has a piece.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for frame in frames:
            done = 0
            for ids, lengths in encoder.encode(frame.column(1)):
                data = memoryview(ids.astype("<u4").tobytes())
                names = frame.column(0).slice(done, len(lengths))
                done += len(lengths)
                document, piece, start, size, crc = [], [], [], [], []
                at = 0
                for nth, n in enumerate(lengths.tolist()):
                    a, whole = 0, n + 1
                    b = whole % capacity or capacity
                    number = 0
                    while a < whole:
                        last = b == whole
                        checked = zlib.crc32(data[4 * (at + a) : 4 * (at + b - last)])
                        document.append(nth)
                        piece.append(number)
                        start.append(a)
                        size.append(b - a)
                        crc.append(zlib.crc32(end, checked) if last else checked)
                        number, a, b = number + 1, b, b + capacity
                    at += n
                columns = [
                    names.take(pa.array(document, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, size, crc)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(cut, _PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that pieces of these lengths need at least, by dual feasible functions.

    A dual feasible function maps lengths so that what fits into a sequence
    still does; the mapped total, in whole sequences, is then a bound. Tried are
    the identity, one that rounds long pieces up and drops short ones, for every
    threshold, and the stepwise ones of Fekete and Schepers.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    weight = counts * size
    n_from = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])
    w_from = np.concatenate([np.cumsum(weight[::-1])[::-1], [0]])
    t = np.arange(capacity // 2 + 1)
    long = n_from[capacity - t + 1]
    best = int(np.max(-(-(long * capacity + w_from[t] - w_from[capacity - t + 1]) // capacity)))
    for k in range(1, 33):
        exact = (k + 1) * size % capacity == 0
        # in units of 1 / k of a sequence where exact ones count (k * size) / capacity
        mapped = np.where(exact, k * size, (k + 1) * size // capacity * capacity)
        best = max(best, int(-(-int(counts @ mapped) // (k * capacity))))
    return best


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """For lengths in descending order, the bin of each and its place there: the fullest bin that has room."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins, places, used = 0, [], [], 0
    for n in lengths:
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            some = by_room[room]
            number = some.pop()
            if not some:
                rooms ^= 1 << room
        else:
            room, number, used = capacity, used, used + 1
        bins.append(number)
        places.append(capacity - room)
        room -= n
        if room:
            if not by_room[room]:
                rooms |= 1 << room
            by_room[room].append(number)
    return bins, places


def _pack_group(capacity: int):
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = group.column("length").to_numpy()
        bins, places = best_fit(lengths.tolist(), capacity)
        bins, places = np.array(bins, np.int64), np.array(places, np.int64)
        filled = np.bincount(bins, weights=lengths).astype(np.int64)
        least = lower_bound(lengths, capacity)
        back = np.flatnonzero(filled < capacity)
        if len(filled) <= least:
            back = back[np.argsort(filled[back], kind="stable")[:GIVEN_BACK]]
        given = np.zeros(len(filled), bool)
        given[back] = True
        for name, column in (("bin", bins), ("offset", places), ("open", given[bins])):
            group = group.append_column(name, pa.array(column))
        return group

    return pack


def pack(pieces: DataFrame, capacity: int, pieces_per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """Packs pieces (of :func:`token_pieces`) into sequences of at most ``capacity``.

    Pieces are dealt to groups by a hash, and each group is packed best fit
    decreasing. A group with as few sequences as its lower bound is certified;
    it gives back its least filled sequences only, at most ``GIVEN_BACK``. A
    group with a gap gives back all that aren't full. What was given back is
    dealt anew, to as many groups as its size asks for, and packed again; so
    documents of different groups meet. A round that needs no fewer sequences
    than before is dropped and ends the search. The driver sees counts only.

    Adds sequence_id and offset; sequences have no gaps. NULL doc_ids, repeated
    rows and an empty table need no special care.
    """
    fields = f"{_PIECES}, group long, bin long, offset long, open boolean"
    open_, done = pieces, None
    n_open, before = pieces.count(), None
    for turn in range(_MOST_ROUNDS):
        groups = max(1, -(-n_open // pieces_per_group))
        key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(turn)), F.lit(groups))
        dealt = open_.select("doc_id", "piece", "start", "length", "ids_crc32").withColumn("group", key)
        packed = written(dealt.groupBy("group").applyInArrow(_pack_group(capacity), fields), "packed")
        number = F.lit(turn << 58) + F.col("group") * (1 << 24) + F.col("bin")
        packed = packed.select("*", number.alias("sequence_id"))
        first = F.col("offset") == 0
        counts = packed.agg(
            F.count(F.when(first, 1)).alias("bins"),
            F.count(F.when(first & F.col("open"), 1)).alias("open_bins"),
            F.count(F.when(F.col("open"), 1)).alias("open"),
        ).first()
        if before is not None and counts.bins >= before:
            break
        kept = packed.where(~F.col("open"))
        done = kept if done is None else done.unionByName(kept)
        open_, n_open, before = packed.where("open"), counts.open, counts.open_bins
        if groups == 1 or not n_open:
            break
    return done.unionByName(open_).drop("group", "bin", "open")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Packs all rows of ``docs`` (doc_id, text) into as few sequences as it can.

    See :func:`token_pieces` and :func:`pack`; other columns are ignored. An
    empty table gives an empty result. Returns doc_id, piece, start, length,
    ids_crc32, sequence_id and offset.
    """
    return pack(written(token_pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)
