"""Token counts of whole texts by a two-tier lookup of part lengths."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import (
    PART_BYTES,
    Encoder,
    PartTable,
    cuts_at_blanks,
    key_hash,
    part_keys,
    part_starts,
    text_slices,
    worker_encoder,
)

#: Parts in the broadcast table; at most 24 + 8 bytes each, and slots.
FREQUENT_PARTS = 20_000
#: Parts that one task reports as its most frequent.
_REPORTED = 4096


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """The bytes and tokens of each row of ``docs`` (doc_id, text).

    ``tokenizer`` is a .json file for the tokenizers library or a .model file
    for sentencepiece, at the same path on every machine. No tokens are added;
    special strings in a text count as the library takes them by default. NULL
    counts as empty, an empty text has no tokens. Repeated rows are counted
    each, rows without doc_id too. Other columns are ignored, and an empty table
    gives an empty result.

    For byte-level files, texts are cut into parts that never share a token.
    The lengths of the most frequent parts of the corpus are broadcast, in a
    table of fixed size; each worker keeps the lengths of others that it meets
    in a bounded table of its own, after asking the library. No part is
    shuffled but the most frequent ones of each task. Other files are given
    whole texts. The counts are the library's either way.

    Returns doc_id, n_bytes, n_tokens and over_limit (more than ``limit``).
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    whole = _counted_whole(tokenizer, limit)
    schema = rows.select("doc_id").schema
    for name, kind in (("n_bytes", "long"), ("n_tokens", "long"), ("over_limit", "boolean")):
        schema = schema.add(name, kind)
    if tokenizer.endswith(".model") or not cuts_at_blanks(tokenizer):
        return rows.mapInArrow(whole, schema)
    parts = frequent_parts(rows)
    tier = docs.sparkSession.sparkContext.broadcast(length_table(parts, tokenizer))
    return rows.mapInArrow(_counted_by_parts(tier, tokenizer, limit), schema)


def frequent_parts(docs: DataFrame, number: int = FREQUENT_PARTS) -> list[bytes]:
    """The parts that come most often, by the reports of all tasks; at most ``number``."""
    reports = docs.select("text").mapInArrow(_most_frequent, "part binary, n long")
    best = reports.groupBy("part").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "part").limit(number)
    return [bytes(row.part) for row in best.select("part").collect()]


def length_table(parts: list[bytes], tokenizer: str) -> PartTable:
    """The parts with their numbers of tokens."""
    table = PartTable()
    if parts:
        keys = _keys_of(parts)
        padded, starts, length = keys
        table.insert(part_keys(*keys), Encoder(tokenizer).lengths(padded, starts, length))
    return table


def _keys_of(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length = np.array([len(p) for p in parts], np.int64)
    padded = np.frombuffer(b"".join(parts) + bytes(PART_BYTES + 9), np.uint8)
    return padded, np.cumsum(length) - length, length


def _most_frequent(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, int] = {}
    for frame in frames:
        for padded, bounds in text_slices(frame.column(0)):
            starts = part_starts(padded, bounds)
            length = np.diff(starts, append=bounds[-1])
            starts, length = starts[length <= PART_BYTES], length[length <= PART_BYTES]
            _, first, n = np.unique(
                key_hash(part_keys(padded, starts, length)), return_index=True, return_counts=True
            )
            for i in np.argsort(-n, kind="stable")[:_REPORTED]:
                a = starts[first[i]]
                part = padded[a : a + length[first[i]]].tobytes()
                counts[part] = counts.get(part, 0) + int(n[i])
        if len(counts) > 8 * _REPORTED:
            counts = dict(sorted(counts.items(), key=lambda item: (-item[1], item[0]))[: 4 * _REPORTED])
    best = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:_REPORTED]
    columns = [pa.array([p for p, _ in best], pa.binary()), pa.array([n for _, n in best], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, ["part", "n"])


def _result(frame: pa.RecordBatch, tokens: np.ndarray, limit: int) -> pa.RecordBatch:
    import pyarrow.compute as pc

    size = pc.cast(pc.binary_length(frame.column(1)), pa.int64())
    columns = [frame.column(0), size, pa.array(tokens, pa.int64()), pa.array(tokens > limit)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])


def _counted_by_parts(tier, tokenizer: str, limit: int):
    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, others = tier.value, worker_encoder(tokenizer)
        for frame in frames:
            found = [np.zeros(0, np.int64)]
            for padded, bounds in text_slices(frame.column(1)):
                starts = part_starts(padded, bounds)
                length = np.diff(starts, append=bounds[-1])
                tokens = np.full(len(starts), -1, np.int64)
                short = np.flatnonzero(length <= PART_BYTES)
                tokens[short] = frequent.find(part_keys(padded, starts[short], length[short]))
                rest = np.flatnonzero(tokens < 0)
                tokens[rest] = others.lengths(padded, starts[rest], length[rest])
                ends = np.concatenate([[0], np.cumsum(tokens)])
                found.append(np.diff(ends[np.searchsorted(starts, bounds)]))
            yield _result(frame, np.concatenate(found), limit)

    return count


def _counted_whole(tokenizer: str, limit: int):
    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer.endswith(".model"):
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_file=tokenizer)
        else:
            library = worker_encoder(tokenizer)
        for frame in frames:
            texts, tokens = frame.column(1).to_pylist(), []
            for at in range(0, len(texts), 64):
                some = texts[at : at + 64]
                ids = library.encode(some, num_threads=1) if tokenizer.endswith(".model") else library.whole(some)
                tokens += map(len, ids)
            yield _result(frame, np.array(tokens, np.int64), limit)

    return count
