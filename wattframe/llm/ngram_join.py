"""Similar documents by a parity-sketch join of their word shingles."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, written
from .components import components
from .shingles import mixed, shingle_sets

#: Numbers of 64 bits in a document's parity sketch.
SKETCH = 8
#: Upper by lower edge of a size band.
_BAND_RATIO = 1.6
#: Parts of a band by the number of elements that can differ.
_PARTS = 1.2
#: Classes of which a task remembers that their signatures are out.
_REMEMBERED = 1_000_000
#: Ids (8 bytes) that are sent to all tasks instead of shuffling texts to them.
MOST_SENT = 1_000_000
#: Classes of a key that a task compares with as many others.
BLOCK = 1024
#: Classes of a component, and elements of their sets, that a task compares with as many others to count their links.
COUNTED, COUNTED_ELEMENTS = 512, 1_000_000
#: First keys of a class that come along with each of its keys, to tell at which of them a pair was met.
FIRST_KEYS = 16
#: Pairs of a cell from which their sets are compared all at once, and elements that are compared at a time.
_MANY_PAIRS, _COLUMNS = 64, 4096
#: Classes of a cell up to which those of a batch are compared all at once; else as many rows of pairs at a time.
_FEW, _PAIR_ROWS = 32, 256

_FEATURES = "doc_id long, n_shingles long, c1 long, c2 long, spare long, " + ", ".join(f"s{k} long" for k in range(SKETCH))


class SizeBands:
    """Size bands, and the number of parts that sets of a band are compared by.

    Elements are dealt to parts by a hash. If two sets have ``of`` * common >=
    ``least`` * all elements, no more than n * (of - least) / least elements
    are in one of them only, n being the size of either. Each of these changes
    one part. So if more parts of a set have elements, one of these is the same
    in the other set. There are enough parts for that to hold for nearly all
    sets; :meth:`thin` tells for which it doesn't.
    """

    def __init__(self, least: int, of: int, largest: int) -> None:
        if not 10 * least >= 7.7 * of:
            raise ValueError("sets that are less similar could be two size bands apart")
        self.least, self.of = least, of
        edges = [1]
        while edges[-1] <= largest:
            edges.append(max(edges[-1] + 1, int(edges[-1] * _BAND_RATIO)))
        self.edges = np.array(edges, np.int64)
        last = self.edges[1:] - 1
        alike = 2 * last * (of - least) // (of + least) == 0
        parts = np.ceil(_PARTS * last * (of - least) / least).astype(np.int64) + 4
        # sets of a band that can only be similar if they are equal need no parts
        self.parts = np.append(np.where(alike, 0, parts), 0)

    def thin(self, full: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether so few parts of a set have elements that all of them may differ in a similar set."""
        return full * self.least <= sizes * (self.of - self.least)

    def band(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, sizes, "right") - 1

    def reaches_next(self, sizes: np.ndarray) -> np.ndarray:
        """Whether a set can be similar to one of the next band."""
        return sizes * self.of >= self.least * self.edges[self.band(sizes) + 1]


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of runs that aren't empty, modulo 2^64."""
    return np.add.reduceat(values, at[:-1]) if len(values) else np.zeros(0, np.uint64)


def _class_hashes(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set, 0 for empty sets."""
    full = at[1:] > at[:-1]
    out = np.zeros((2, len(full)), np.uint64)
    bounds = np.append(at[:-1][full], len(sets))
    for k, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        out[k][full] = mixed(_sums(mixed(sets ^ np.uint64(salt)), bounds))
    return out[0], out[1]


def _features(words: int, least: int, of: int):
    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _FEATURES.split(", ")]
        for frame in frames:
            done = 0
            for sets, at in shingle_sets(frame.column(1), words):
                size = np.diff(at)
                c1, c2 = _class_hashes(sets, at)
                bit = mixed(sets ^ np.uint64(0xD6E8FEB86659FD93)) & np.uint64(64 * SKETCH - 1)
                sketch = np.zeros(SKETCH * len(size), np.uint64)
                word = np.repeat(np.arange(len(size)) * SKETCH, size) + (bit >> np.uint64(6)).astype(np.int64)
                np.bitwise_xor.at(sketch, word, np.uint64(1) << (bit & np.uint64(63)))
                columns = [frame.column(0).slice(done, len(size)), pa.array(size, pa.int64())]
                columns += [pa.array(x.view(np.int64)) for x in (c1, c2)]
                columns.append(pa.array(_spare(sets, size, SizeBands(least, of, 2 * int(size.max(initial=1))))))
                columns += [pa.array(np.ascontiguousarray(s)) for s in sketch.view(np.int64).reshape(-1, SKETCH).T]
                yield pa.RecordBatch.from_arrays(columns, names)
                done += len(size)

    return find


def _signatures(words: int, bands: SizeBands):
    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for frame in frames:
            for sets, at in shingle_sets(frame.column(0), words):
                size = np.diff(at)
                c1, _ = _class_hashes(sets, at)
                new = np.zeros(len(size), bool)
                for k, c in enumerate(c1.tolist()):
                    new[k] = size[k] > 0 and c not in seen
                    seen.add(c)
                if len(seen) > _REMEMBERED:
                    seen.clear()
                band = bands.band(np.maximum(size, 1))
                for some, of in ((new, band), (new & bands.reaches_next(np.maximum(size, 1)), band + 1)):
                    some = some & (bands.parts[of] > 0)
                    if some.any():
                        yield _part_keys(sets[np.repeat(some, size)], size[some], of[some], c1[some], bands)

    return find


def _dealt(scrambled: np.ndarray, size: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The place of each element's part, the parts of all sets in a row."""
    part = ((scrambled >> np.uint64(32)) * np.repeat(parts, size).astype(np.uint64)) >> np.uint64(32)
    return np.repeat(np.cumsum(parts) - parts, size) + part.astype(np.int64)


def _spare(sets: np.ndarray, size: np.ndarray, bands: SizeBands) -> np.ndarray:
    """How many of its parts that have elements a set can do without and still meet each similar set in another."""
    out = np.zeros(len(size), np.int64)
    band = bands.band(np.maximum(size, 1))
    scrambled = _scrambled(sets)
    full = np.full((2, len(size)), np.iinfo(np.int64).max)
    for row, some, of in ((0, size > 0, band), (1, bands.reaches_next(np.maximum(size, 1)) & (size > 0), band + 1)):
        some = some & (bands.parts[of] > 0)
        if some.any():
            parts = bands.parts[of[some]]
            has = np.zeros(int(parts.sum()), np.int64)
            has[_dealt(scrambled[np.repeat(some, size)], size[some], parts)] = 1
            full[row, some] = np.add.reduceat(has, np.cumsum(parts) - parts)
    least = full.min(axis=0)
    given = least < np.iinfo(np.int64).max
    out[given] = least[given] - size[given] * (bands.of - bands.least) // bands.least - 1
    return np.maximum(out, 0)


def _scrambled(sets: np.ndarray) -> np.ndarray:
    return mixed(sets ^ np.uint64(0x165667B19E3779F9))


def _part_keys(
    sets: np.ndarray, size: np.ndarray, band: np.ndarray, c1: np.ndarray, bands: SizeBands
) -> pa.RecordBatch:
    """A key for each part of each set: equal when the band, the part's number and its elements are.

    A part is the exclusive or of its elements' hashes. Only thin sets give their
    empty parts too, by which they meet each other.
    """
    parts = bands.parts[band]
    first = np.cumsum(parts) - parts
    scrambled = _scrambled(sets)
    parity = np.zeros(int(parts.sum()), np.uint64)
    np.bitwise_xor.at(parity, _dealt(scrambled, size, parts), mixed(scrambled))
    full = parity != 0
    thin = bands.thin(np.add.reduceat(full.astype(np.int64), first), size)
    given = full | np.repeat(thin, parts)
    number = np.arange(len(parity)) - np.repeat(first, parts)
    place = (np.repeat(band, parts) << 40 | number).astype(np.uint64)
    keys = mixed(parity + mixed(place))[given]
    columns = [pa.array(keys.view(np.int64)), pa.array(np.repeat(c1, parts)[given].view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["key", "c1"])


def _sets(words: int):
    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for sets, at in shingle_sets(frame.column(0), words):
                data = sets.astype("<u8").tobytes()
                bounds = (at * 8).tolist()
                binary = [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
                c1, _ = _class_hashes(sets, at)
                yield pa.RecordBatch.from_arrays([pa.array(c1.view(np.int64)), pa.array(binary, pa.binary())], ["c1", "elements"])

    return find


def _common(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many elements pairs of sets, given by their places, have in common."""
    if len(a) < _MANY_PAIRS:
        pairs = ((sets[i], sets[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True))
        return np.array([len(x) + len(y) - len(np.union1d(x, y)) for x, y in pairs], np.int64)
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, element, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # elements of one set only are in no other
    number = np.cumsum(times > 1) - 1
    shared = times[element] > 1
    if not shared.any():
        return np.zeros(len(a), np.int64)
    of, element = of[shared], number[element[shared]]
    order = np.argsort(element, kind="stable")
    of, element = of[order], element[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(number[-1]) + 1, _COLUMNS):
        low, high = np.searchsorted(element, [first, first + _COLUMNS])
        has = np.zeros((len(sets), _COLUMNS), np.float32)
        has[of[low:high], element[low:high] - first] = 1
        both += has @ has.T
    return both[a, b].astype(np.int64)


_MET = "key long, p long, q long, a long, b long"


def _met(least: int, of: int):
    """The pairs of each cell that sizes and sketches allow, unless they share one of the first keys before this one."""

    def allowed(n: np.ndarray, sketch: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        both, x, y = n[i] + n[j], n[i], n[j]
        fits = (x * of >= y * least) & (y * of >= x * least)
        apart = sum(np.bitwise_count(sketch[i, k] ^ sketch[j, k]).astype(np.int64) for k in range(SKETCH))
        return fits & (apart * (of + least) <= both * (of - least))

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        key, p, q, block, c1, n = (rows.column(k).to_numpy() for k in range(6))
        sketch = np.stack([rows.column(6 + k).to_numpy().view(np.uint64) for k in range(SKETCH)], axis=1)
        before = rows.column(6 + SKETCH).combine_chunks()
        keys, at = before.values.to_numpy(), before.offsets.to_numpy()
        earlier = lambda k: keys[at[k] : at[k + 1]]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(key)))
        cell = np.cumsum(new) - 1
        few = (size <= _FEW)[cell]
        found = []
        for d in range(1, min(_FEW, int(size.max(initial=1)))):
            i = np.flatnonzero((cell[d:] == cell[:-d]) & few[d:])
            i = i[(p[i] == q[i]) | (block[i] != block[i + d])]
            i = i[allowed(n, sketch, i, i + d)]
            own = [k for k in i.tolist() if not len(np.intersect1d(earlier(k), earlier(k + d), assume_unique=True))]
            found.append((np.array(own, np.int64), np.array(own, np.int64) + d))
        for start, m in zip(first[size > _FEW].tolist(), size[size > _FEW].tolist(), strict=True):
            sets = [earlier(k) for k in range(start, start + m)]
            for low in range(0, m, _PAIR_ROWS):
                i, j = np.meshgrid(np.arange(low, min(m, low + _PAIR_ROWS)), np.arange(low, m), indexing="ij")
                i, j = i[i < j], j[i < j]
                if p[start] != q[start]:
                    across = block[start + i] != block[start + j]
                    i, j = i[across], j[across]
                ok = allowed(n, sketch, start + i, start + j)
                i, j = i[ok], j[ok]
                ok = _common(sets, i, j) == 0
                found.append((start + i[ok], start + j[ok]))
        i, j = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))
        columns = [key[i], p[i], q[i], np.minimum(c1[i], c1[j]), np.maximum(c1[i], c1[j])]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "p", "q", "a", "b"])

    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for frame in frames:
            if not len(frame):
                continue
            # the last cell may go on in the next batch
            key, p, q = (frame.column(k).to_numpy() for k in range(3))
            other = np.flatnonzero((key != key[-1]) | (p != p[-1]) | (q != q[-1]))
            if held and (len(other) or [held[-1].column(k)[-1] for k in range(3)] != [frame.column(k)[-1] for k in range(3)]):
                cut = int(other[-1]) + 1 if len(other) else 0
                yield pairs(pa.Table.from_batches([*held, frame.slice(0, cut)]))
                held = [frame.slice(cut)]
            else:
                held.append(frame)
        if held:
            yield pairs(pa.Table.from_batches(held))

    return find


class _Cell:
    """Sets and pairs of classes that were sent to one place."""

    def __init__(self, name: tuple) -> None:
        self.name = name
        self.place: dict[int, int] = {}
        self.sets: list[np.ndarray] = []
        self.pairs: list[tuple[int, int]] = []

    def links(self, least: int, of: int) -> Iterator[tuple[int, int, bool]]:
        """The similar pairs, and whether each leads to classes that those before it don't."""
        if not self.pairs:
            return
        a, b = np.array([[self.place[x], self.place[y]] for x, y in self.pairs], np.int64).T
        size = np.array([len(x) for x in self.sets], np.int64)
        common = _common(self.sets, a, b)
        up = list(range(len(self.sets)))
        for k in np.flatnonzero(of * common >= least * (size[a] + size[b] - common)).tolist():
            i, j = int(a[k]), int(b[k])
            while up[i] != i:
                up[i] = i = up[up[i]]
            while up[j] != j:
                up[j] = j = up[up[j]]
            up[j] = i
            yield (*self.pairs[k], i != j)


def _verified(least: int, of: int):
    def check(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, links = _Cell(()), []

        def batch() -> pa.RecordBatch:
            columns = zip(*links, strict=True) if links else ((), (), ())
            kinds = (pa.int64(), pa.int64(), pa.bool_())
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "tree"])
            links.clear()
            return out

        for frame in frames:
            for *name, a, b, elements in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                if (name := tuple(name)) != cell.name:
                    links += cell.links(least, of)
                    cell = _Cell(name)
                if elements is None:
                    cell.pairs.append((a, b))
                else:
                    cell.place[a] = len(cell.sets)
                    cell.sets.append(np.frombuffer(elements, "<u8"))
            yield batch()
        links += cell.links(least, of)
        yield batch()

    return check


def _counted(least: int, of: int):
    """How many documents each class of a cell is linked to by others there; a row per class that has links."""

    def counts(blocks: list[int], classes: list[int], members: list[int], sets: list[np.ndarray], across: bool):
        i, j = np.triu_indices(len(sets), 1)
        size, block = np.array([len(x) for x in sets], np.int64), np.array(blocks)
        fits = np.minimum(size[i], size[j]) * of >= np.maximum(size[i], size[j]) * least
        if across:
            fits &= block[i] != block[j]
        i, j = i[fits], j[fits]
        common = _common(sets, i, j)
        linked = of * common >= least * (size[i] + size[j] - common)
        i, j, many = i[linked], j[linked], np.array(members, np.int64)
        beyond = np.zeros(len(sets), np.int64)
        np.add.at(beyond, i, many[j])
        np.add.at(beyond, j, many[i])
        some = np.flatnonzero(beyond)
        return pa.RecordBatch.from_arrays([pa.array(np.array(classes, np.int64)[some]), pa.array(beyond[some])], ["c1", "beyond"])

    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, ([], [], [], [])
        for frame in frames:
            for key, p, q, *row, elements in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                if name != (key, p, q):
                    if len(held[0]) > 1:
                        yield counts(*held, name[1] != name[2])
                    name, held = (key, p, q), ([], [], [], [])
                for values, value in zip(held, (*row, np.frombuffer(elements, "<u8")), strict=True):
                    values.append(value)
        if len(held[0]) > 1:
            yield counts(*held, name[1] != name[2])

    return find


def _can_link(least: int, of: int) -> Column:
    """What sizes and parity sketches of two sets allow; every similar pair passes."""
    both = F.col("x.n") + F.col("y.n")
    fits = F.col("x.n") * of >= F.col("y.n") * least
    fits = fits & (F.col("y.n") * of >= F.col("x.n") * least)
    apart = sum((F.bit_count(F.col(f"x.s{k}").bitwiseXOR(F.col(f"y.s{k}"))) for k in range(SKETCH)), F.lit(0))
    return fits & (apart * (of + least) <= both * (of - least))


class _Classes(NamedTuple):
    """Rows with equal sets as one, and the keys by which classes meet.

    ``features`` has a row for each document, ``classes`` one for each set that
    isn't empty, with its smallest doc_id (id). A class is named by its c1.
    ``keys`` has the keys that a class is left with, and how many have them.
    """

    rows: DataFrame
    features: DataFrame
    classes: DataFrame
    keys: DataFrame


def _classes(docs: DataFrame, words: int, least: int, of: int) -> _Classes:
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    features = written(rows.mapInArrow(_features(words, least, of), _FEATURES), "set-features")
    sketch = [F.first(f"s{k}").alias(f"s{k}") for k in range(SKETCH)]
    by_set = features.where("n_shingles > 0").groupBy("c1", "c2", "n_shingles")
    classes = by_set.agg(F.min("doc_id").alias("id"), F.count("*").alias("members"), F.min("spare").alias("spare"), *sketch)
    classes = written(classes.withColumnRenamed("n_shingles", "n"), "set-classes")

    largest = classes.agg(F.max("n")).first()[0] or 1
    bands = SizeBands(least, of, largest)
    keys = rows.select("text").mapInArrow(_signatures(words, bands), "key long, c1 long")
    group = Window.partitionBy("key")
    # copies that other tasks gave count once; a key of one class joins nothing
    before = F.lag("c1").over(group.orderBy("c1"))
    keys = keys.withColumn("new", (before.isNull() | (before != F.col("c1"))).cast("int"))
    keys = keys.withColumn("classes", F.sum("new").over(group)).where("new = 1 AND classes > 1")
    # each class leaves out the keys that most classes have, as many as it can spare: of the keys that two similar
    # sets share, the rarest is left to both
    spare = classes.groupBy("c1").agg(F.min("spare").alias("spare"))
    common = Window.partitionBy("c1").orderBy(F.desc("classes"), "key")
    keys = keys.join(spare, "c1").withColumn("rank", F.row_number().over(common)).where("rank > spare")
    return _Classes(rows, features, classes, keys.select("key", "c1"))


def _sketched(name: str) -> Column:
    return F.struct("n", *(f"s{k}" for k in range(SKETCH))).alias(name)


def _components(found: _Classes, words: int, least: int, of: int) -> tuple[DataFrame, DataFrame]:
    """The component (node, component; names of classes) of each class that has links, without looking for all links.

    Also returns the sets (c1, elements) of these classes, and of others. In each group that meets, all are compared with one and with a neighbour in
    a mixed order; then those that are still in different components with each
    other.
    """
    rows, _, classes, keys = found
    group = Window.partitionBy("key")
    mixed_up = group.orderBy(F.xxhash64("c1", "key"), "c1")
    meets = keys.select("key", "c1", F.min("c1").over(group).alias("lead"), F.lag("c1").over(mixed_up).alias("beside"))
    meets = written(meets.where("lead <> c1"), "set-groups")

    # each member with the first, and with the one before it in an order that differs from group to group
    pairs = meets.select("lead", F.col("c1").alias("other"))
    beside = F.least("beside", "c1").alias("lead"), F.greatest("beside", "c1").alias("other")
    pairs = pairs.union(meets.where("beside IS NOT NULL").select(*beside)).distinct()
    leads = classes.select(F.col("c1").alias("lead"), _sketched("x"))
    others = classes.select(F.col("c1").alias("other"), _sketched("y"))
    pairs = pairs.join(leads, "lead").join(others, "other").where(_can_link(least, of))
    pairs = pairs.select(F.col("lead").alias("a"), F.col("other").alias("b"), *_cell_of("lead"))
    links, sets = _verify(found, pairs, words, least, of)
    links = links.select("a", "b")
    component = components(links)

    # groups whose members are not all in one component yet
    sketches = [f"s{k}" for k in range(SKETCH)]
    member = classes.join(component, F.col("c1") == F.col("node"), "left")
    member = member.select("c1", F.coalesce("component", "c1").alias("component"), "n", *sketches)
    every = meets.select("key", "c1").union(meets.select("key", "lead").distinct())
    every = every.join(member.select("c1", "component"), "c1")
    open_ = every.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = open_.where("low <> high").select("key")
    open_ = written(every.select("key", "c1").join(open_, "key").join(member, "c1"), "open-groups")
    x, y = (open_.select("key", F.struct("component", "c1", "n", *sketches).alias(n)) for n in "xy")
    apart = F.col("x.component") < F.col("y.component")
    pairs = x.withColumnRenamed("key", "k").join(y, (F.col("k") == F.col("key")) & apart & _can_link(least, of))
    pairs = pairs.select(F.col("x.c1").alias("a"), F.col("y.c1").alias("b")).distinct()
    pairs = written(pairs.select("a", "b", *_cell_of("a")), "open-pairs")
    if not pairs.isEmpty():
        more, more_sets = _verify(found, pairs, words, least, of)
        links = written(links.unionByName(more.select("a", "b")), "links")
        component = components(links)
        sets = sets.unionByName(more_sets.join(sets.select("c1"), "c1", "left_anti"))
    return component, sets


def _link_counts(found: _Classes, component: DataFrame, sets: DataFrame, least: int, of: int) -> DataFrame:
    """How many documents of other classes each class (c1) is linked to (beyond); classes without links are left out.

    All links lie inside a component. The classes of a large one are dealt over
    blocks, and a cell for each two blocks counts what is linked there: a set
    goes to as many cells as its component has blocks, and a cell gives a number
    for each of its classes, not its pairs.
    """
    member = found.classes.join(component, F.col("c1") == F.col("node")).select("component", "c1", "members", "n")
    member = written(member, "linked-classes")
    blocks = F.greatest(F.ceil(F.count("*") / COUNTED), F.ceil(F.sum("n") / COUNTED_ELEMENTS)).alias("blocks")
    large = member.groupBy("component").agg(blocks).where("blocks > 1")
    member = member.join(large, "component", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("c1"), "blocks").alias("block")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    cells = member.select("component", block, other, "c1", "members")
    p, q = F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")
    cells = cells.select(F.col("component").alias("key"), p, q, "block", "c1", "members").join(sets, "c1")
    cells = cells.select("key", "p", "q", "block", "c1", "members", "elements")
    cells = cells.repartition(shuffle_partitions(cells.sparkSession), "key", "p", "q").sortWithinPartitions("key", "p", "q")
    return cells.mapInArrow(_counted(least, of), "c1 long, beyond long").groupBy("c1").agg(F.sum("beyond").alias("beyond"))


def _all_links(found: _Classes, words: int, least: int, of: int) -> DataFrame:
    """All links between classes (a < b), and which of them suffice to lead to all that are linked (tree).

    All classes of a key are compared, in blocks if there are many; a pair that
    shares one of its first keys is not taken again at later ones.
    """
    group, own = Window.partitionBy("key"), Window.partitionBy("c1").orderBy("key")
    keys = found.keys.withColumn("left", F.count("*").over(group)).where(F.col("left") > 1)
    early = F.when(F.row_number().over(own) <= FIRST_KEYS, F.col("key"))
    keys = keys.withColumn("early", early)
    keys = keys.withColumn("before", F.collect_list("early").over(own.rowsBetween(Window.unboundedPreceding, -1))).drop("early")
    blocks = F.ceil(F.col("left") / BLOCK)
    keys = keys.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("c1"), "blocks"))
    sketches = [f"s{k}" for k in range(SKETCH)]
    keys = keys.join(found.classes.select("c1", "n", *sketches), "c1")
    # the cell of each two blocks
    keys = keys.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    p, q = F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")
    keys = keys.select("key", p, q, "block", "c1", "n", *sketches, "before")
    keys = keys.repartition(shuffle_partitions(keys.sparkSession), "key", "p", "q").sortWithinPartitions("key", "p", "q")
    pairs = keys.mapInArrow(_met(least, of), _MET).groupBy("a", "b").agg(F.min(F.struct("key", "p", "q")).alias("cell"))
    return _verify(found, pairs.select("a", "b", "cell.*"), words, least, of)[0]


class Similarity(NamedTuple):
    """Links of documents, by classes of documents with equal sets.

    ``members`` (doc_id, n_shingles, set): a row for each document, with the
    class it is in (NULL for empty sets). ``links`` (a, b, a_id, b_id, a_members,
    b_members): a row for each two linked classes, with their smallest doc_ids
    and how many documents they have. Documents of one class are all linked.
    """

    members: DataFrame
    links: DataFrame


def similarity(docs: DataFrame, words: int = 4, least: int = 85, of: int = 100) -> Similarity:
    """All links between the documents of ``docs`` (doc_id, text); see :func:`similar_documents`."""
    found = _classes(docs, words, least, of)
    links = _all_links(found, words, least, of)
    for side in "ab":
        names = F.col("c1").alias(side), F.col("id").alias(f"{side}_id"), F.col("members").alias(f"{side}_members")
        links = links.join(found.classes.select(*names), side)
    members = found.features.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("c1")).alias("set"))
    return Similarity(members, links.select("a", "b", "a_id", "b_id", "a_members", "b_members"))


def similar_documents(docs: DataFrame, words: int = 4, least: int = 85, of: int = 100) -> DataFrame:
    """The group of similar documents that each row of ``docs`` (doc_id, text) is in, and its number of links.

    A document's set are its distinct shingles of ``words`` words (anything but
    blanks, A-Z in lower case), the whole text if it has fewer; NULL counts as
    empty. Documents are linked if their sets have ``of`` * common >= ``least`` *
    all elements; empty sets have no links. component_id is the smallest doc_id
    that links lead to, NULL if none of these rows has one. n_links counts the
    other rows that a row is linked to; rows that share a doc_id, or have none,
    are documents of their own. Other columns are ignored; an empty table gives
    an empty result. Elements are compared by 64-bit hashes.

    Equal sets form a class first, so copies take no further part. Classes meet
    in a pigeonhole join on the parity of parts of their sets, per size band
    (:class:`SizeBands`). A set shares several parts with a similar one, and can
    leave out as many of the commonest but one, so passages that many documents
    have bring few together. Sizes and parity sketches, whose distance is at
    most that of the sets, rule out pairs that meet; enough of the others to find
    all components are verified on their sets. Links are then counted inside the
    components, block by block, without a list of them. Only classes that are
    left to verify are read again.

    Returns doc_id, n_shingles, component_id and n_links.
    """
    found = _classes(docs, words, least, of)
    component, sets = _components(found, words, least, of)
    beyond = _link_counts(found, component, sets, least, of)
    classes = found.classes.select("c1", "c2", "members", "id").join(beyond, "c1", "left")
    classes = classes.withColumn("n_links", F.col("members") - 1 + F.coalesce("beyond", F.lit(0)))
    return _by_row(found, _with_component(classes, component), ("component_id", "n_links"))


def _with_component(classes: DataFrame, component: DataFrame) -> DataFrame:
    """The classes (c1, id, ...) with the smallest id of their component, component_id."""
    classes = classes.join(component, F.col("c1") == F.col("node"), "left")
    classes = written(classes.withColumn("component", F.coalesce("component", "c1")).drop("node"), "set-components")
    least = classes.groupBy("component").agg(F.min("id").alias("component_id"))
    return classes.join(least, "component")


def _by_row(found: _Classes, classes: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """doc_id, n_shingles and what is known of its class for each document; of empty sets the doc_id and 0."""
    features = found.features
    ids = written(classes.select("c1", "c2", "members", *values), "set-ids")
    # classes with many members go to all tasks; there are at most four to a partition
    most = max(1000, features.count() // (4 * shuffle_partitions(features.sparkSession)))
    many = F.broadcast(ids.where(F.col("members") > most).drop("members"))
    few = ids.where(F.col("members") <= most).drop("members")
    full, out = features.where("n_shingles > 0"), ("doc_id", "n_shingles", *values)
    result = full.join(many, ["c1", "c2"]).select(*out)
    rest = full.join(many, ["c1", "c2"], "left_anti").join(few, ["c1", "c2"]).select(*out)
    alone = [F.col("doc_id").alias(v) if v == "component_id" else F.lit(0).cast("long").alias(v) for v in values]
    none = features.where("n_shingles = 0").select("doc_id", "n_shingles", *alone)
    return result.unionByName(rest).unionByName(none)


def drop_similar(docs: DataFrame, words: int = 5, least: int = 80, of: int = 100) -> DataFrame:
    """The rows of ``docs``, with all their columns, without those of a group of similar documents but one, of the smallest doc_id.

    Groups are those of :func:`similar_documents`; NULL texts are empty, and
    empty sets are in no group: such rows all stay. Of each group one row stays,
    rows without doc_id come last, and of rows with the same doc_id any one is
    taken. Rows are told apart by a 64-bit hash of doc_id and text, so rows that
    share a doc_id but not the text stay or go each for itself. An empty table
    stays empty; all columns are kept under their names, whatever these are.
    """
    key = "_row"
    while key in (c.lower() for c in docs.columns):
        key += "_"
    keyed = docs.withColumn(key, F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    found = _classes(keyed.select(F.col(key).alias("doc_id"), "text"), words, least, of)
    component, _ = _components(found, words, least, of)
    groups = _by_row(found, _with_component(found.classes.select("c1", "c2", "members", "id"), component), ("component_id",))
    groups = groups.where("n_shingles > 0").select(F.col("doc_id").alias(key), "component_id").distinct()
    rows = keyed.groupBy(key).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    groups = written(groups.join(rows, key), "similar")
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(key))
    stays = groups.groupBy("component_id").agg(F.min_by(key, first).alias(key)).select(key)
    # taken away by row, not by group: a group may hold a third of all rows
    gone = written(groups.select(key).join(stays, key, "left_anti"), "similar-gone")
    repeated = written(groups.where("n > 1").select(key).join(gone, key, "left_anti").distinct(), "similar-repeated")
    left = keyed.join(_few(gone), key, "left_anti").select(key, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    if not repeated.isEmpty():
        once = left.join(_few(repeated), key, "left_semi").groupBy(key).agg(F.first("row").alias("row"))
        left = left.join(_few(repeated), key, "left_anti").unionByName(once)
    return left.select("row.*")


def _few(ids: DataFrame) -> DataFrame:
    """The ids, marked to be sent to all tasks if there are few enough."""
    return F.broadcast(ids) if ids.count() <= MOST_SENT else ids


def _cell_of(name: str) -> tuple[Column, Column, Column]:
    """Cells by a class: the pairs of a few classes, of which this is one, are verified in one place."""
    return F.col(name).alias("key"), F.lit(0).cast("long").alias("p"), F.lit(0).cast("long").alias("q")


def _verify(found: _Classes, pairs: DataFrame, words: int, least: int, of: int) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b; classes) whose sets are similar, of those given with a cell (key, p, q) to verify them in.

    A set goes once to each cell that has a pair with it. Returns a, b and tree,
    the pairs that suffice to link what the pairs of a cell link; and the sets
    (c1, elements) of all classes that were compared.
    """
    cell = ["key", "p", "q"]
    pairs = written(pairs, "candidates")
    ends = pairs.select(*cell, F.col("a").alias("c1")).union(pairs.select(*cell, "b")).distinct()
    wanted = found.classes.join(ends.select("c1").distinct(), "c1", "left_semi").select("c1", "id")
    wanted = written(wanted, "wanted")
    ids = wanted.where("id IS NOT NULL").select(F.col("id").alias("doc_id")).distinct()
    texts = found.rows.join(_few(ids), "doc_id", "left_semi").select("text")
    if not wanted.where("id IS NULL").isEmpty():
        texts = texts.union(found.rows.where("doc_id IS NULL").select("text"))
    # rows that share a doc_id have a set each, and rows without one are all read
    sets = texts.mapInArrow(_sets(words), "c1 long, elements binary").join(_few(wanted.select("c1")), "c1", "left_semi")
    sets = written(sets.dropDuplicates(["c1"]), "sets")
    sent = ends.join(sets, "c1").select(*cell, F.col("c1").alias("a"), F.lit(None).cast("long").alias("b"), "elements")
    sent = sent.unionByName(pairs.select(*cell, "a", "b", F.lit(None).cast("binary").alias("elements")))
    sent = sent.repartition(shuffle_partitions(pairs.sparkSession), *cell)
    sent = sent.sortWithinPartitions(*cell, F.col("elements").isNull())
    return written(sent.mapInArrow(_verified(least, of), "a long, b long, tree boolean"), "verified"), sets
