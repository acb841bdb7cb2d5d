"""Document fingerprints from prefix polynomial hashes."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

#: Two primes below 2^31, so that products fit into 64 bits, and the base of each polynomial.
PRIMES = (2147483647, 2147483629)
BASES = (1000003919, 1299709951)
#: Code points of the spans that fingerprints compare, and spans that a fingerprint keeps.
SPAN = 24
KEPT = 64
#: Code points of the spans of short texts; texts below which these are compared, and below which they are kept.
SHORT_SPAN, SHORT, SHORT_KEPT = 4, 100, 400
_BUCKETS_PER_PARTITION = 4


class _Powers:
    """Powers of the bases and of their inverses, as far as the longest text so far."""

    def __init__(self) -> None:
        self.of = [np.ones(1, np.uint64) for _ in PRIMES]
        self.inverse = [np.ones(1, np.uint64) for _ in PRIMES]

    def reach(self, size: int) -> None:
        while len(self.of[0]) <= size:
            for k, p in enumerate(PRIMES):
                n = len(self.of[k])
                for table, base in ((self.of, BASES[k]), (self.inverse, pow(BASES[k], -1, p))):
                    more = table[k] * np.uint64(pow(base, n, p)) % np.uint64(p)
                    table[k] = np.concatenate([table[k], more])


_POWERS = _Powers()


class PrefixHashes:
    """Hashes of all prefixes of a text, modulo two primes: place i has the hash of the first i code points."""

    def __init__(self, codes: np.ndarray) -> None:
        """``codes``: the code points, as unsigned 32-bit numbers."""
        _POWERS.reach(len(codes) + 1)
        self.size = len(codes)
        self.sums = []
        for k, p in enumerate(PRIMES):
            sums = np.zeros(len(codes) + 1, np.uint64)
            # code points count from 1, so that leading zeros tell
            np.cumsum((codes + np.uint64(1)) * _POWERS.of[k][: len(codes)] % np.uint64(p), out=sums[1:])
            self.sums.append(sums % np.uint64(p))

    def spans(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The hashes of spans, as 62-bit numbers: equal for equal spans, wherever they are."""
        parts = []
        for k, p in enumerate(PRIMES):
            sums = self.sums[k]
            difference = sums[stops] + np.uint64(p) - sums[starts]
            parts.append(difference % np.uint64(p) * _POWERS.inverse[k][starts] % np.uint64(p))
        return parts[0] << np.uint64(31) | parts[1]

    def windows(self, first: int, size: int) -> np.ndarray:
        """The hashes of all spans of ``size`` code points from place ``first`` on."""
        n = max(0, self.size - size + 1 - first)
        parts = []
        for k, p in enumerate(PRIMES):
            sums = self.sums[k]
            difference = sums[first + size : first + size + n] + np.uint64(p) - sums[first : first + n]
            parts.append(difference % np.uint64(p) * _POWERS.inverse[k][first : first + n] % np.uint64(p))
        return parts[0] << np.uint64(31) | parts[1]

    def span(self, start: int, stop: int) -> int:
        return int(self.spans(np.array([start]), np.array([stop]))[0])

    def common_extension(self, start: int, other: "PrefixHashes", other_start: int) -> int:
        """How many code points from these places on are the same, by binary search over span hashes."""
        low, high = 0, min(self.size - start, other.size - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(start, start + middle) == other.span(other_start, other_start + middle):
                low = middle
            else:
                high = middle - 1
        return low

    def edited(self, kept: int, tail: "PrefixHashes", taken: int) -> "PrefixHashes":
        """The hashes of the first ``kept`` code points and then the first ``taken`` of ``tail``, from theirs."""
        new = PrefixHashes.__new__(PrefixHashes)
        new.size = kept + taken
        _POWERS.reach(new.size + 1)
        new.sums = []
        for k, p in enumerate(PRIMES):
            after = tail.sums[k][1 : taken + 1] * _POWERS.of[k][kept] + self.sums[k][kept]
            new.sums.append(np.concatenate([self.sums[k][: kept + 1], after % np.uint64(p)]))
        return new


def _mixed(hashes: np.ndarray) -> np.ndarray:
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return (mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)


def _smallest(values: np.ndarray) -> np.ndarray:
    """The smallest distinct values, in order."""
    room = 2 * KEPT
    while len(values) > room:
        some = np.unique(np.partition(values, room)[:room])
        if len(some) >= KEPT:
            return some[:KEPT]
        room *= 8
    return np.unique(values)[:KEPT]


class _Text:
    """A text with its prefix hashes and, mixed, the hashes of its spans."""

    def __init__(self, text: str) -> None:
        self.text = text
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        self.hashes = PrefixHashes(codes)
        self.values = _mixed(self.hashes.windows(0, SPAN)) if len(codes) >= SPAN else None
        self.sketch = self._sketch()
        self.short = self._short()

    def _sketch(self) -> np.ndarray:
        if self.values is not None:
            return _smallest(self.values)
        size = self.hashes.size
        return _mixed(self.hashes.spans(np.array([0]), np.array([size]))) if size else np.zeros(0, np.uint64)

    def _short(self) -> np.ndarray | None:
        """The smallest hashes of short spans, those that begin before the text or end behind it included."""
        size = self.hashes.size
        if size >= SHORT_KEPT:
            return None
        ends = np.arange(1, min(SHORT_SPAN, size + 1))
        begin = self.hashes.spans(np.zeros_like(ends), ends) ^ np.uint64(1 << 62)
        end = self.hashes.spans(size - ends, np.full_like(ends, size)) ^ np.uint64(1 << 63)
        return _smallest(_mixed(np.concatenate([self.hashes.windows(0, SHORT_SPAN), begin, end])))

    def edited(self, following: "_Text") -> "_Text":
        """The last quarter replaced by as much of the beginning of the following text."""
        size = self.hashes.size
        quarter = size // 4
        taken = min(quarter, following.hashes.size)
        new = _Text.__new__(_Text)
        new.text = self.text[: size - quarter] + following.text[:taken]
        new.hashes = self.hashes.edited(size - quarter, following.hashes, taken)
        new.values = None
        if new.hashes.size >= SPAN:
            same = max(0, size - quarter - SPAN + 1)
            new.values = np.concatenate(
                [self.values[:same] if same else np.zeros(0, np.uint64), _mixed(new.hashes.windows(same, SPAN))]
            )
        new.sketch = new._sketch()
        new.short = new._short()
        return new

    def fingerprint(self) -> str:
        size = self.hashes.size
        kept = "".join(f"{v:08x}" for v in self.sketch.tolist())
        short = "" if self.short is None else "." + "".join(f"{v:08x}" for v in self.short.tolist())
        return f"{size:x}.{self.hashes.span(0, size):016x}.{kept}{short}"

    def likeness(self, other: "_Text") -> float:
        return _likeness(self.hashes.size, self.sketch, self.short, other.hashes.size, other.sketch, other.short)


def fingerprint(text: str | None) -> str:
    """The fingerprint of a text: its size, the hash of the whole, and the smallest hashes of its spans."""
    return _Text(text or "").fingerprint()


def likeness(one: str, other: str) -> float:
    """How alike two texts are by their fingerprints: an estimate of the share of spans that they have in common."""
    if one == other:
        return 1.0
    return _likeness(*_read(one), *_read(other))


def _read(kept: str) -> tuple[int, np.ndarray, np.ndarray | None]:
    size, _, *sketches = kept.split(".")
    values = [np.array([int(f[i : i + 8], 16) for i in range(0, len(f), 8)], np.uint64) for f in sketches]
    return int(size, 16), values[0], values[1] if len(values) > 1 else None


def _likeness(
    size: int, sketch: np.ndarray, short: np.ndarray | None, other_size: int, other: np.ndarray, other_short: np.ndarray | None
) -> float:
    """By short spans if either text is short; one that is too long to have these is no near copy of a short one."""
    if min(size, other_size) < SHORT and short is not None and other_short is not None:
        return _alike(short, other_short)
    return _alike(sketch, other)


def _alike(one: np.ndarray, other: np.ndarray) -> float:
    """2J / (1 + J) for the Jaccard similarity J that the smallest values of both texts together estimate."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    both = np.intersect1d(one, other, assume_unique=True)
    together = np.union1d(one, other)
    if len(one) == KEPT or len(other) == KEPT:
        together = together[:KEPT]
        both = both[both <= together[-1]]
    jaccard = len(both) / len(together)
    return 2 * jaccard / (1 + jaccard)


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, same_as_edited long, same_as_next long"
)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all rows of ``docs`` (doc_id, text), compared with an edited text and the next document.

    Documents are ordered by doc_id, rows without one first, those with the same
    by their texts; the first follows the last. The edited text has the last
    quarter of its code points replaced by as many, or all, of the beginning of
    the next document. NULL counts as empty; two empty texts are alike, an empty
    and another text are not. Repeated rows are documents of their own. Other
    columns are ignored; an empty table gives an empty result.

    Fingerprints are made from the modular hashes of all prefixes, which give
    the hash of any span: kept are the size, the hash of the whole, and the
    smallest hashes of all spans of ``SPAN`` code points; of texts under
    ``SHORT_KEPT`` also those of spans of ``SHORT_SPAN``, by which texts are
    compared if either is under ``SHORT``. same_as_edited and
    same_as_next are the code points that the texts have in common from their
    beginning, by binary search over span hashes.

    Quantiles of doc_id cut the documents into buckets, so texts are shuffled
    once; each partition gets as many neighbouring buckets. Each bucket also gets the first document of the next one, found by the
    buckets' smallest ids.
    """
    spark = docs.sparkSession
    number = _BUCKETS_PER_PARTITION * shuffle_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [k / number for k in range(1, number)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 20 * number).alias("cuts")).first().cuts or []
    splits = [-float("inf"), *sorted({float(c) for c in cuts} or {0.0}), float("inf")]
    at = F.coalesce(F.col("doc_id").cast("double"), F.lit(-float("inf")))
    buckets = Bucketizer(splits=splits, inputCol="at", outputCol="bucket")
    rows = buckets.transform(rows.withColumn("at", at)).drop("at")

    # one row per bucket: its first document goes to the bucket before it, that of the first bucket to the last
    least = rows.groupBy("bucket").agg(F.min("doc_id").alias("first"), F.max(F.isnull("doc_id")).alias("without"))
    around = Window.orderBy("bucket")
    last = F.max("bucket").over(Window.partitionBy())
    to = F.coalesce(F.lag("bucket").over(around), last).alias("to")
    least = least.select(F.col("bucket").alias("of"), F.when(~F.col("without"), F.col("first")).alias("first"), to)
    same = (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first"))
    ahead = rows.join(F.broadcast(least), same).groupBy("to", "doc_id").agg(F.min("text").alias("text"))

    rows = rows.select("bucket", F.lit(False).alias("ahead"), "doc_id", "text")
    rows = rows.unionByName(ahead.select(F.col("to").alias("bucket"), F.lit(True).alias("ahead"), "doc_id", "text"))
    rows = rows.repartitionById(shuffle_partitions(spark), (F.col("bucket") / _BUCKETS_PER_PARTITION).cast("int"))
    return rows.sortWithinPartitions("bucket", "ahead", "doc_id", "text").mapInArrow(_compared, _RESULT)


def _compared(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _RESULT.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    schema = pa.schema([(n, kinds[f.split()[1]]) for n, f in zip(names, _RESULT.split(", "), strict=True)])
    before: tuple[int | None, _Text] | None = None
    for frame in frames:
        rows = []
        for ahead, doc_id, text in zip(*(c.to_pylist() for c in frame.columns[1:3]), frame.column("text"), strict=True):
            current = _Text(text.as_py())
            if before:
                rows.append(_row(*before, current))
            before = None if ahead else (doc_id, current)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else
            [pa.array([], f.type) for f in schema],
            schema=schema,
        )


def _row(doc_id: int | None, one: _Text, following: _Text) -> tuple:
    edited = one.edited(following)
    return (
        doc_id,
        one.hashes.size,
        hashlib.sha256(edited.text.encode()).hexdigest(),
        one.fingerprint(),
        edited.fingerprint(),
        one.likeness(edited),
        one.likeness(following),
        one.hashes.common_extension(0, edited.hashes, 0),
        one.hashes.common_extension(0, following.hashes, 0),
    )
