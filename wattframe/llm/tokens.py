"""Token ids of whole texts, encoded by the library once per distinct part.

A byte-level tokenizer always splits a text before a lone blank or line break:
one without other white space on either side. It also splits between a letter
and a punctuation mark behind it. The ids of a text are therefore those of its
parts in a row, and most parts come again and again. An encoder keeps the parts
it has seen in two tables of bounded size and looks up all parts of a batch at
once; the library encodes the others, many at a time. When the younger table is
full it takes the place of the older one, and parts that are met there move to
the new one: rare parts are forgotten, common ones stay.
"""

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes of a part that the table can hold; longer parts are kept by a dictionary.
PART_BYTES = 23
#: Text bytes looked up at once.
_AT_ONCE = 1_000_000
#: Parts that one call of the library takes as one text.
_JOINED = 64
#: Marks that may follow a word as a piece of their own. No apostrophe, which can start a suffix, and no angle
#: bracket, which can end a special token.
_MARKS = ".,;:!?%$#&*|\"()"
#: ASCII white space, by any library's view, and first bytes of longer characters some of which are white space.
_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
_MAY_BE_WHITE = np.zeros(256, bool)
_MAY_BE_WHITE[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
_BLANK = re.compile(r"\s")
_PAD = 32


def cuts_at_blanks(path: str) -> bool:
    """Whether the tokenizer file is of the kind that a lone blank always cuts."""
    with open(path, encoding="utf-8") as file:
        kind = json.load(file)
    before = kind.get("pre_tokenizer") or {}
    added = kind.get("added_tokens") or []
    return (
        before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and kind.get("normalizer") is None
        and not any(_BLANK.search(t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
    )


def text_slices(texts: pa.Array, at_once: int = _AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The UTF-8 bytes of consecutive texts, padded on both sides, and the places where texts begin and end."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    ends = ends.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + at_once, "right")) - 1)
        padded = np.zeros(ends[last] - ends[first] + 2 * _PAD, np.uint8)
        padded[_PAD:-_PAD] = raw[ends[first] : ends[last]]
        yield padded, ends[first : last + 1] - ends[first] + _PAD
        first = last


def part_starts(padded: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places where a part begins: at each text that isn't empty, and at lone blanks and line breaks."""
    body = padded[_PAD:-_PAD]
    at = np.flatnonzero((body == 32) | (body == 10)) + _PAD
    before, after = padded[at - 1], padded[at + 1]
    lone = ~(_WHITE[before] | _WHITE[after] | _MAY_BE_WHITE[after])
    lone &= (before < 128) | ~(_MAY_BE_WHITE[padded[at - 2]] | _MAY_BE_WHITE[padded[at - 3]])
    begins = np.zeros(len(padded), bool)
    begins[at[lone]] = True
    begins[bounds[:-1][bounds[1:] > bounds[:-1]]] = True
    return np.flatnonzero(begins)


class PartTable:
    """An open-addressed table from parts of up to 23 bytes to numbers."""

    def __init__(self) -> None:
        self._keys, self._numbers, self.used = np.zeros((3, 1024), np.uint64), np.zeros(1024, np.int64), 0
        self._resize()

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of keys; -1 for unknown ones."""
        found = np.full(keys.shape[1], -1, np.int64)
        open_, slot = np.arange(keys.shape[1]), self._slot(keys)
        while len(open_):
            row = self._slots[slot]
            some = row >= 0
            open_, slot, row = open_[some], slot[some], row[some]
            same = (self._keys[0][row] == keys[0][open_]) & (self._keys[1][row] == keys[1][open_])
            same &= self._keys[2][row] == keys[2][open_]
            found[open_[same]] = self._numbers[row[same]]
            open_, slot = open_[~same], (slot[~same] + 1) & (len(self._slots) - 1)
        return found

    def insert(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Adds distinct unknown keys."""
        size, used = keys.shape[1], self.used
        if used + size > self._keys.shape[1]:
            more = max(used + size, 2 * self._keys.shape[1]) - used
            self._keys = np.concatenate([self._keys[:, :used], np.zeros((3, more), np.uint64)], axis=1)
            self._numbers = np.concatenate([self._numbers[:used], np.zeros(more, np.int64)])
            self._resize()
        self._keys[:, used : used + size] = keys
        self._numbers[used : used + size] = numbers
        self.used += size
        self._enter(np.arange(used, used + size))

    def _resize(self) -> None:
        bits = (2 * self._keys.shape[1] - 1).bit_length()
        self._shift = np.uint64(64 - bits)
        self._slots = np.full(1 << bits, -1, np.int32)
        self._enter(np.arange(self.used))

    def _enter(self, rows: np.ndarray) -> None:
        slot = self._slot(self._keys[:, rows])
        while len(rows):
            free = self._slots[slot] < 0
            self._slots[slot[free]] = rows[free]
            left = self._slots[slot] != rows
            rows, slot = rows[left], (slot[left] + 1) & (len(self._slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (key_hash(keys) >> self._shift).astype(np.int64)


class _Parts:
    """Parts and their ids: short ones by a table, long ones by a dictionary."""

    def __init__(self) -> None:
        self.table, self.long = PartTable(), {}
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def used(self) -> int:
        return self.table.used + len(self.long)

    def add(self, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Keeps the ids of parts, all in a row; returns their places."""
        places = len(self.first) + np.arange(len(count))
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.pool = np.concatenate([self.pool, ids])
        return places

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the parts at places, all in a row, and how many each has."""
        count = self.count[places]
        ends = np.concatenate([[0], np.cumsum(count)])
        return self.pool[np.repeat(self.first[places] - ends[:-1], count) + np.arange(ends[-1])], count


class Encoder:
    """Ids of texts from a tokenizer file of the tokenizers library; without added special tokens."""

    def __init__(self, path: str, most_parts: int = 600_000) -> None:
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self.by_parts = cuts_at_blanks(path)
        self._most = most_parts // 2
        if self.by_parts:
            blank = self._library.encode(" ", add_special_tokens=False).tokens[0]
            vocabulary = self._library.get_vocab()
            self._begins = np.zeros(max(vocabulary.values()) + 1, bool)
            self._begins[[i for token, i in vocabulary.items() if token.startswith(blank)]] = True
        self._young, self._old = _Parts(), _Parts()

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Each text given to the library as it is."""
        found = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of texts, their ids in a row and the number of ids of each; NULL counts as empty."""
        if not self.by_parts:
            for at in range(0, len(texts), 64):
                ids = self.whole([t or "" for t in texts[at : at + 64].to_pylist()])
                yield np.concatenate(ids), np.array([len(x) for x in ids], np.int64)
            return
        for padded, bounds in text_slices(texts):
            starts = part_starts(padded, bounds)
            place = self.places(padded, starts, np.diff(starts, append=bounds[-1]))
            ids, count = self._young.ids(place)
            ends = np.concatenate([[0], np.cumsum(count)])
            yield ids, np.diff(ends[np.searchsorted(starts, bounds)])

    def lengths(self, padded: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The number of ids of each part."""
        place = self.places(padded, starts, length)
        return self._young.count[place]

    def places(self, padded: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Where the ids of each part are among the younger parts; the others are fetched from the older ones or learned."""
        if self._young.used() > self._most:
            self._young, self._old = _Parts(), self._young
        young = self._young
        place = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(length <= PART_BYTES)
        keys = part_keys(padded, starts[short], length[short])
        place[short] = young.table.find(keys)
        data = padded.tobytes()
        missing = short[place[short] < 0]
        if len(missing):
            own = keys[:, place[short] < 0]
            order = np.lexsort(own)
            new = np.concatenate([[True], (own[:, order[1:]] != own[:, order[:-1]]).any(axis=0)])
            first = order[new]
            found = self._old.table.find(own[:, first])
            known = found >= 0
            put = np.empty(len(first), np.int64)
            put[known] = young.add(*self._old.ids(found[known]))
            at, size = starts[missing[first[~known]]].tolist(), length[missing[first[~known]]].tolist()
            put[~known] = self._learn([data[a : a + n] for a, n in zip(at, size, strict=True)])
            young.table.insert(own[:, first], put)
            place[missing[order]] = put[np.cumsum(new) - 1]
        long = np.flatnonzero(length > PART_BYTES)
        if len(long):
            at, size = starts[long].tolist(), length[long].tolist()
            texts = [data[a : a + n] for a, n in zip(at, size, strict=True)]
            absent = {t for t in texts if t not in young.long}
            kept = [t for t in absent if t in self._old.long]
            moved = young.add(*self._old.ids(np.array([self._old.long[t] for t in kept], np.int64)))
            young.long.update(zip(kept, moved.tolist(), strict=True))
            unknown = list(absent.difference(kept))
            young.long.update(zip(unknown, self._learn(unknown).tolist(), strict=True))
            place[long] = [young.long[t] for t in texts]
        return place

    def _learn(self, parts: list[bytes]) -> np.ndarray:
        """Encodes parts by the library and keeps their ids; returns their places."""
        if not parts:
            return np.zeros(0, np.int64)
        split, plain, odd = [], {}, []
        for part in parts:
            text = part.decode()
            stem = text.rstrip(_MARKS)
            if not stem[-1:].isalpha():
                stem = text
            split.append((stem, text[len(stem) :]))
            if stem[0] == " " and len(stem) > 1 and not _BLANK.search(stem, 1):
                plain[stem] = None
            else:
                odd.append(stem)
        words = list(plain)
        known = {}
        groups = [words[at : at + _JOINED] for at in range(0, len(words), _JOINED)]
        for group, ids in zip(groups, self._joined(groups), strict=True):
            known.update(zip(group, ids, strict=True))
        alone = list({*odd, *(marks for _, marks in split if marks)})
        known.update(zip(alone, self.whole(alone), strict=True))
        ids = [np.concatenate([known[stem], known[marks]]) if marks else known[stem] for stem, marks in split]
        return self._young.add(np.concatenate(ids), np.array([len(x) for x in ids], np.int64))

    def _joined(self, groups: list[list[str]]) -> Iterator[list[np.ndarray]]:
        """Encodes each group as one text; a part begins where the characters of an id begin with a blank."""
        for group, ids in zip(groups, self.whole(["".join(group) for group in groups]), strict=True):
            begins = np.flatnonzero(self._begins[ids])
            if len(begins) == len(group):
                cuts = [*begins.tolist(), len(ids)]
                yield [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            else:
                yield self.whole(group)


def part_keys(padded: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Short parts as three numbers each: their bytes, and their length in the last byte."""
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    keys = np.empty((3, len(starts)), np.uint64)
    for k in range(3):
        bits = 8 * np.clip(length - 8 * k, 0, 8).astype(np.uint64)
        mask = np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << (bits % 64)) - np.uint64(1))
        keys[k] = eight[starts + 8 * k] & mask
    keys[2] |= length.astype(np.uint64) << np.uint64(56)
    return keys


def key_hash(keys: np.ndarray) -> np.ndarray:
    mixed = keys[0] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= (keys[1] ^ (mixed >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= (keys[2] ^ (mixed >> np.uint64(31))) * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(32)
    return mixed * np.uint64(0xD6E8FEB86659FD93)


_ENCODERS: dict[str, Encoder] = {}


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which keeps its parts from task to task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
