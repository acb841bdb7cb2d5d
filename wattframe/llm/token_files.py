"""Token ids of documents in binary files, packed by Simple-8b.

A file holds the documents of one range of doc_ids, in ascending order: a
magic number, the words of all blocks, and at the end the tables that find them
again. All numbers are little-endian. Tables: words and escapes of each block
(32 bits), escaped numbers (64), doc_ids (64) and whether there is one (8), and
ids of each document (64). Then their sizes (five of 64 bits) and the magic number.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import simple8b
from .common import own_folder, shuffle_partitions, written
from .tokens import worker_encoder

MAGIC = b"WFIDS8B1"
#: Ids packed or unpacked at once, in whole blocks.
_AT_ONCE = 4096 * simple8b.BLOCK
#: The tables at the end of a file, in order, with the kind of their numbers.
_TABLES = (
    ("per_block", "<u4"),
    ("escapes_per_block", "<u4"),
    ("escapes", "<u8"),
    ("doc_ids", "<i8"),
    ("has_id", "u1"),
    ("lengths", "<i8"),
)
_MANIFEST = "part int, path string, n_docs long, n_ids long, n_bytes long"


def open_file(path: str):
    """The file system and path of a URI, or of a plain local path."""
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(path)


class IdWriter:
    """Writes the ids of documents to one stream, some blocks at a time."""

    def __init__(self, stream) -> None:
        self._stream = stream
        self._waiting: list[np.ndarray] = []
        self._tables: dict[str, list[np.ndarray]] = {name: [] for name, _ in _TABLES}
        self.n_ids = self.n_docs = self.n_words = self._n_waiting = 0
        stream.write(MAGIC)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Documents in a row: their doc_ids, all their ids, and how many each has."""
        self._tables["doc_ids"].append(doc_ids.fill_null(0).to_numpy(zero_copy_only=False))
        self._tables["has_id"].append(doc_ids.is_valid().to_numpy(zero_copy_only=False))
        self._tables["lengths"].append(lengths)
        self.n_docs += len(lengths)
        self.n_ids += len(ids)
        self._waiting.append(ids)
        self._n_waiting += len(ids)
        if self._n_waiting >= _AT_ONCE:
            self._pack(whole_blocks=True)

    def _pack(self, whole_blocks: bool) -> None:
        ids = np.concatenate([np.zeros(0, np.uint32), *self._waiting])
        cut = len(ids) - len(ids) % simple8b.BLOCK if whole_blocks else len(ids)
        for at in range(0, cut, _AT_ONCE):
            words, per_block, escapes, escapes_per_block = simple8b.pack(ids[at : min(at + _AT_ONCE, cut)])
            self._stream.write(words.astype("<u8").tobytes())
            self.n_words += len(words)
            self._tables["per_block"].append(per_block)
            self._tables["escapes_per_block"].append(escapes_per_block)
            self._tables["escapes"].append(escapes)
        self._waiting, self._n_waiting = [ids[cut:]], len(ids) - cut

    def close(self) -> None:
        self._pack(whole_blocks=False)
        sizes = {}
        for name, kind in _TABLES:
            table = np.concatenate([np.zeros(0, kind), *(x.astype(kind) for x in self._tables[name])])
            self._stream.write(table.tobytes())
            sizes[name] = len(table)
        counts = (self.n_words, sizes["per_block"], sizes["escapes"], self.n_docs, self.n_ids)
        self._stream.write(struct.pack("<5Q", *counts) + MAGIC)
        self._stream.close()


def read_ids(path: str) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray, np.ndarray]]:
    """The documents of a file in order, in runs: doc_ids, the ids of the run, and where each document begins and ends.

    A document that goes on in the next run ends here with what there is; its
    doc_id comes again, and ``begins`` of that run starts with -1.
    """
    system, name = open_file(path)
    with system.open_input_file(name) as file:
        size = file.size()
        tail = file.read_at(48, size - 48)
        if tail[40:] != MAGIC or file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path} is not a file of token ids")
        n_words, n_blocks, n_escapes, n_docs, n_ids = struct.unpack("<5Q", tail[:40])
        at, tables = 8 + 8 * n_words, []
        rows = {"per_block": n_blocks, "escapes_per_block": n_blocks, "escapes": n_escapes}
        for table, kind in _TABLES:
            width = np.dtype(kind).itemsize * rows.get(table, n_docs)
            tables.append(np.frombuffer(file.read_at(width, at), kind))
            at += width
        per_block, escapes_per_block, escapes, doc_ids, has_id, lengths = tables
        word = np.concatenate([[0], np.cumsum(per_block, dtype=np.int64)])
        escape = np.concatenate([[0], np.cumsum(escapes_per_block, dtype=np.int64)])
        ends = np.cumsum(lengths)
        step = _AT_ONCE // simple8b.BLOCK
        for a in range(0, max(n_blocks, 1), step):
            b = min(a + step, n_blocks)
            lo, hi = a * simple8b.BLOCK, min(b * simple8b.BLOCK, n_ids)
            words = np.frombuffer(file.read_at(8 * int(word[b] - word[a]), 8 + 8 * int(word[a])), "<u8")
            ids = simple8b.unpack(
                words, per_block[a:b], escapes[escape[a] : escape[b]], escapes_per_block[a:b], hi - lo
            ).astype("<u4")
            first = int(np.searchsorted(ends, lo, "right")) if lo else 0
            last = n_docs if hi == n_ids else int(np.searchsorted(ends - lengths, hi, "left"))
            begins = (ends - lengths)[first:last] - lo
            names = [int(d) if ok else None for d, ok in zip(doc_ids[first:last], has_id[first:last], strict=True)]
            yield names, ids, np.where(begins < 0, -1, begins), np.minimum(ends[first:last] - lo, hi - lo)


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Writes the ids of all rows of ``docs`` (doc_id, text) in ascending doc_id order; returns the files.

    Rows without doc_id come first; rows with the same doc_id go by their texts.
    NULL counts as empty. Every document ends with ``end_id``. Other columns are
    ignored; an empty table gives no rows. Documents are dealt over ranges of
    doc_ids and sorted; each task writes its range to a file of its own in the
    shared folder, under a name that no other attempt uses. The returned table
    names the files of the attempts that counted: part, path, n_docs, n_ids,
    n_bytes, and start, the ids in all earlier files.
    """
    spark = docs.sparkSession
    folder = folder or own_folder(spark, "token-files")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = written(rows.mapInArrow(_writer(folder, tokenizer, end_id), _MANIFEST), "token-manifest")
    # one row per file
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def _writer(folder: str, tokenizer: str, end_id: int):
    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        encoder, task = worker_encoder(tokenizer), TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        for frame in frames:
            done = 0
            for ids, lengths in encoder.encode(frame.column(1)):
                if writer is None:
                    system, place = open_file(name)
                    system.create_dir(place.rpartition("/")[0], recursive=True)
                    writer = IdWriter(system.open_output_stream(place))
                ids = np.insert(ids, np.cumsum(lengths), np.uint32(end_id))
                writer.add(frame.column(0).slice(done, len(lengths)), ids, lengths + 1)
                done += len(lengths)
        if writer is not None:
            writer.close()
            n_bytes = system.get_file_info(place).size
            row = (task.partitionId(), name, writer.n_docs, writer.n_ids, n_bytes)
            fields = ("part", "path", "n_docs", "n_ids", "n_bytes")
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array([x], k) for x, k in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, fields)

    return write


def read_back(files: DataFrame) -> DataFrame:
    """One row per document of files as :func:`write_ids` returns them: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; the checksum is that of
    the ids as little-endian 32-bit numbers. Files are dealt over the tasks.
    """
    spread = files.select("path", "start").repartition(shuffle_partitions(files.sparkSession))
    return spread.mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _reader(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for path, start in zip(*(c.to_pylist() for c in frame.columns), strict=True):
            last = None
            for names, ids, begins, ends in read_ids(path):
                data, rows = memoryview(ids.tobytes()), [last] if last else []
                for name, a, b in zip(names, begins.tolist(), ends.tolist(), strict=True):
                    if a < 0:
                        name, n, crc = rows.pop()
                        rows.append((name, n + b, zlib.crc32(data[: 4 * b], crc)))
                    else:
                        rows.append((name, b - a, zlib.crc32(data[4 * a : 4 * b])))
                # the last document may go on in the next run
                last = rows.pop() if rows else None
                yield from _documents(rows, start)
                start += sum(n for _, n, _ in rows)
            yield from _documents([last] if last else [], start)


def _documents(rows: list[tuple], start: int) -> Iterator[pa.RecordBatch]:
    if rows:
        n = np.array([r[1] for r in rows], np.int64)
        columns = [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array(start + np.cumsum(n) - n),
            pa.array(n),
            pa.array([r[2] for r in rows], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
