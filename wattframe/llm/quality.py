"""Text quality learned from heuristics that vote, without labelled documents."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import word_hashes
from .tokens import text_slices

#: Documents that the scorer is trained on, about; chosen by a hash of the doc_id.
TRAINING_DOCS = 4000
#: Quality from which a text is kept: it goes only if bad is three times as likely as good.
THRESHOLD = 0.25
#: Places that features of words are hashed to.
DIMENSIONS = 2048
#: Heuristics that vote.
HEURISTICS = 11
#: Words below which most heuristics abstain.
FEW_WORDS = 8

# Frequent function words of four languages.
STOP_WORDS = (
    "the of and a to in is on by that with for was as are this it be at from or an he not"
    " le la les de des du un une et en que qui dans pour par sur pas est avec au elle"
    " der die das und den von zu mit für auf ist im dem nicht ein eine als auch sich einer"
    " el y los del las por con una su para se no al lo"
).split()

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
#: Signs that prose rarely has.
_ODD = np.zeros(256, bool)
_ODD[np.frombuffer(b"#$%&*+<=>@[]^_`{|}~!\\", np.uint8)] = True
#: Bytes by kind: small and capital letters, digits, other signs as they are.
_KIND = np.arange(256, dtype=np.uint8)
_KIND[97:123] = 97
_KIND[65:91] = 65
_KIND[48:58] = 48
_KIND[128:] = 97


class Page(NamedTuple):
    """Consecutive texts: their bytes, where each begins and ends, and the same for words."""

    padded: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    at: np.ndarray

    def share(self, flags: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The share of words with a flag, by text."""
        sums = np.concatenate([[0], np.cumsum(flags)])
        return np.diff(sums[self.at]) / np.maximum(of, 1)


def _pages(texts: pa.Array) -> Iterator[Page]:
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    for padded, bounds in text_slices(texts):
        words, at = word_hashes(padded, bounds)
        inside = ~blank[padded]
        inside[: bounds[0]] = inside[bounds[-1] :] = False
        cut = np.zeros(len(padded), bool)
        cut[bounds] = True
        starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut[1:])) + 1
        ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut[1:])) + 1
        yield Page(padded, bounds, starts, ends, words, at)


def _hash_of(words: list[str]) -> np.ndarray:
    found = [word_hashes(*next(text_slices(pa.array([w]))))[0] for w in words]
    return np.unique(np.concatenate(found))


def _vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """1 for good, -1 for bad, 0 for no opinion."""
    return np.where(bad, -1, np.where(good, 1, 0)).astype(np.int8)


def _votes(page: Page, stop_words: np.ndarray) -> np.ndarray:
    """The votes of all heuristics, a row each, on the texts of a page."""
    padded, bounds = page.padded, page.bounds
    n = np.diff(page.at)
    enough = n >= FEW_WORDS

    def signs(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[padded])])
        return np.diff(sums[bounds])

    letters = signs(_LETTER)
    size = np.maximum(np.diff(bounds), 1)
    odd = signs(_ODD) / size
    upper = signs(_UPPER) / np.maximum(signs(_LOWER) + signs(_UPPER), 1)
    last, first = padded[page.ends - 1], padded[page.starts]
    odd_ends = page.share(_ODD[last], n)
    bare = page.share(~_LETTER[first] & ~_DIGIT[first] & (page.ends - page.starts <= 2), n)
    stops = page.share(np.isin(page.words, stop_words), n)
    again = np.zeros(len(page.words), bool)
    again[1:] = page.words[1:] == page.words[:-1]
    again[page.at[:-1][n > 0]] = False
    twice, near = again.copy(), again.copy()
    twice[1:] &= again[:-1]
    for back in (2, 3, 4):
        near[back:] |= page.words[back:] == page.words[:-back]
    repeats, runs, echoes = (page.share(flags, n) for flags in (again, twice, near))
    sentence = page.share((last == 46) | (last == 44) | (last == 63) | (last == 33), n)
    long = page.share(page.ends - page.starts > 30, n)
    mean = (np.diff(np.concatenate([[0], np.cumsum(page.ends - page.starts)])[page.at])) / np.maximum(n, 1)
    return np.stack(
        [
            _vote(odd < 0.01, odd > 0.04),
            _vote(enough & (upper < 0.15), enough & (upper > 0.5)),
            _vote(odd_ends < 0.03, odd_ends > 0.2),
            _vote(enough & (bare < 0.03), enough & (bare > 0.15)),
            _vote(enough & (stops > 0.12), (n >= 3 * FEW_WORDS) & (stops < 0.03)),
            _vote(enough & (repeats < 0.05), enough & (repeats > 0.2)),
            _vote(enough & (runs < 0.02), enough & (runs > 0.1)),
            _vote(enough & (echoes < 0.3), enough & (echoes > 0.5)),
            _vote(enough & (sentence > 0.03) & (sentence < 0.3), (n >= 3 * FEW_WORDS) & (sentence == 0)),
            _vote(enough & (mean > 2.5) & (mean < 11) & (long < 0.02), enough & ((mean > 16) | (long > 0.1))),
            _vote(letters / size > 0.7, letters / size < 0.5),
        ]
    )


def vote_patterns(docs: DataFrame) -> DataFrame:
    """How often each combination of votes comes, over all documents: pattern (base 3, vote + 1) and n."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_patterns, "pattern long").groupBy("pattern").agg(F.count("*").alias("n"))


def _patterns(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stop_words = _hash_of(STOP_WORDS)
    for frame in frames:
        for page in _pages(frame.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(_number(_votes(page, stop_words)))], ["pattern"])


def _number(votes: np.ndarray) -> np.ndarray:
    return (3 ** np.arange(len(votes), dtype=np.int64)) @ (votes.astype(np.int64) + 1)


def label_model(patterns: dict[int, int], heuristics: int = HEURISTICS, rounds: int = 100) -> dict[int, float]:
    """The probability that a text with a pattern of votes is good, by expectation-maximisation.

    Each heuristic has, for good and for bad texts, its own chances of either
    vote; having no opinion says nothing. These and the share of good texts are estimated in turn with the
    probabilities, from the counts of patterns. At first, texts that nothing
    votes against are taken for good, and the others for bad.
    """
    if not patterns:
        return {}
    numbers = np.array(sorted(patterns), np.int64)
    count = np.array([patterns[p] for p in numbers.tolist()], float)
    votes = numbers[:, None] // 3 ** np.arange(heuristics) % 3
    one_hot = votes[:, :, None] == np.array([0, 2])
    good = np.where((votes == 0).any(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        chances = []
        for weight in (good * count, (1 - good) * count):
            seen = np.einsum("p,phv->hv", weight, one_hot) + 1.0
            chances.append(np.log(seen / seen.sum(axis=1, keepdims=True)))
        prior = np.clip((good @ count) / count.sum(), 0.01, 0.99)
        odds = np.log(prior / (1 - prior)) + np.einsum("phv,hv->p", one_hot, chances[0] - chances[1])
        good = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(numbers.tolist(), good.tolist(), strict=True))


def _features(page: Page) -> np.ndarray:
    """Three hashed features of each word: its last signs by kind, its first, and whether it is the word before."""
    kinds = _KIND[page.padded].astype(np.int64)
    size = page.ends - page.starts

    def sign(at: np.ndarray, have: np.ndarray) -> np.ndarray:
        return np.where(have, kinds[np.clip(at, 0, len(kinds) - 1)], 0)

    tail = sign(page.ends - 1, size > 0) | sign(page.ends - 2, size > 1) << 8 | sign(page.ends - 3, size > 2) << 16
    head = sign(page.starts, size > 0) | sign(page.starts + 1, size > 1) << 8 | np.minimum(size, 24) << 16 | 1 << 24
    same = np.zeros(len(size), np.int64)
    same[1:] = page.words[1:] == page.words[:-1]
    pair = np.concatenate([[0], tail[:-1]])[: len(tail)] & 255
    pair = pair | (tail & 255) << 8 | same << 16 | 2 << 24
    mixed = np.stack([tail, head, pair]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % DIMENSIONS


class Scorer(NamedTuple):
    """A linear scorer of hashed features: the mean weight of a text's features, and the bias.

    Means are over ``FEW_WORDS`` words more than there are, so that a few words
    say less than many.
    """

    weights: np.ndarray
    bias: float

    def scores(self, page: Page) -> np.ndarray:
        """Probabilities of being good; 0 for texts without words."""
        n = np.diff(page.at)
        worth = self.weights[_features(page)].sum(axis=0) if len(page.words) else np.zeros(0)
        sums = np.concatenate([[0.0], np.cumsum(worth)])
        mean = np.diff(sums[page.at]) / (n + FEW_WORDS)
        return np.where(n > 0, 1 / (1 + np.exp(-np.clip(mean + self.bias, -30, 30))), 0.0)


def _training_rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stop_words = _hash_of(STOP_WORDS)
    for frame in frames:
        for page in _pages(frame.column(0)):
            patterns, features = _number(_votes(page, stop_words)), _features(page)
            places, shares = [], []
            for a, b in zip(page.at[:-1].tolist(), page.at[1:].tolist(), strict=True):
                place, n = np.unique(features[:, a:b], return_counts=True)
                places.append(place.astype(np.int32))
                shares.append((n / (b - a + FEW_WORDS)).astype(np.float32))
            columns = [pa.array(patterns), pa.array(places, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, ["pattern", "places", "shares"])


def train(docs: DataFrame, training_docs: int = TRAINING_DOCS) -> Scorer:
    """Fits the label model on the votes on all documents, and the scorer on a sample with its probabilities.

    The sample is bounded by twice ``training_docs``; its features go to the
    driver. Documents without words are not trained on.
    """
    patterns = {row.pattern: row.n for row in vote_patterns(docs).collect()}
    good = label_model(patterns)
    total = max(1, sum(patterns.values()))
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, training_docs / total))
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(chosen).select("text")
    sample = sample.mapInArrow(_training_rows, "pattern long, places array<int>, shares array<float>")
    rows = sorted(tuple(r) for r in sample.where(F.size("places") > 0).limit(2 * training_docs).collect())
    matrix = np.zeros((len(rows), DIMENSIONS), np.float32)
    for k, (_, places, shares) in enumerate(rows):
        matrix[k, places] = shares
    return fit(matrix, np.array([good[p] for p, _, _ in rows], np.float32))


def fit(matrix: np.ndarray, good: np.ndarray, rounds: int = 300, rate: float = 0.3, decay: float = 1e-4) -> Scorer:
    """Logistic regression on probabilities, by gradient steps of Adam; both sides weigh alike."""
    weights, moment, square = np.zeros((3, matrix.shape[1] + 1), np.float32)
    if not len(good):
        return Scorer(weights[:-1], 0.0)
    side = np.clip([(1 - good).mean(), good.mean()], 0.02, None)
    balance = (good / side[1] + (1 - good) / side[0]) / (2 * len(good))
    for turn in range(1, rounds + 1):
        guess = 1 / (1 + np.exp(-np.clip(matrix @ weights[:-1] + weights[-1], -30, 30)))
        error = (guess - good) * balance
        gradient = np.append(matrix.T @ error, error.sum()) + decay * np.append(weights[:-1], 0)
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        step = moment / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        weights = (weights - rate * step).astype(np.float32)
    return Scorer(weights[:-1].astype(np.float64), float(weights[-1]))


def score(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, quality (0 to 1) and kept of each row of ``docs`` (doc_id, text).

    NULL counts as empty; a text without words has quality 0. Repeated rows are
    scored each; other columns are ignored; an empty table gives an empty result.
    """
    scorer_of = docs.sparkSession.sparkContext.broadcast(scorer)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))

    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            done = 0
            for page in _pages(frame.column(1)):
                n, quality = np.diff(page.at), scorer_of.value.scores(page)
                columns = [frame.column(0).slice(done, len(n)), *map(pa.array, (n, quality, quality >= threshold))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "quality", "kept"])
                done += len(n)

    return rows.mapInArrow(find, "doc_id long, n_words long, quality double, kept boolean")


def classify(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Trains on the documents and scores them all; see :func:`train` and :func:`score`."""
    return score(docs, train(docs), threshold)


def keep_good(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier trained on them keeps."""
    scorer_of = docs.sparkSession.sparkContext.broadcast(train(docs))
    place = docs.columns.index("text")

    def keep(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            quality = [np.zeros(0), *(scorer_of.value.scores(page) for page in _pages(frame.column(place)))]
            yield frame.filter(pa.array(np.concatenate(quality) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
