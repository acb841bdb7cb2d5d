import numpy as np
import pytest

from wattframe.llm import quality
from wattframe.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_labels(spark):
    """No label is used in training; nearly all are met."""
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    got = quality.classify(docs).collect()
    assert len(got) == docs.count()
    good = [r.kept for r in got if labels.get(r.doc_id) == 1]
    bad = [r.kept for r in got if labels.get(r.doc_id) == 0]
    assert sum(good) >= 0.995 * len(good) and sum(bad) <= 0.05 * len(bad)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_expectation_maximisation_finds_the_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.8
    accuracy = np.array([0.95, 0.9, 0.85, 0.8, 0.9, 0.95])
    right = rng.random((len(truth), 6)) < accuracy
    votes = np.where(rng.random((len(truth), 6)) < 0.2, 1, np.where(right == truth[:, None], 2, 0))
    numbers, count = np.unique(votes @ 3 ** np.arange(6), return_counts=True)
    good = quality.label_model(dict(zip(numbers.tolist(), count.tolist(), strict=True)), heuristics=6)
    found = np.array([good[n] for n in (votes @ 3 ** np.arange(6)).tolist()])
    assert ((found > 0.5) == truth).mean() > 0.97
    assert abs(found.mean() - 0.8) < 0.02
    assert quality.label_model({}) == {}


def test_odd_texts(odd_docs, odd_rows):
    got = quality.classify(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert all(r.quality == 0 and not r.kept for r in got if r.n_words == 0)
    assert sum(r.n_words == 0 for r in got) == 4
    kept = quality.keep_good(odd_docs).collect()
    assert len(kept) == sum(r.kept for r in got) and all(r["row"] == "row" for r in kept)


def test_nothing(no_docs):
    assert quality.classify(no_docs).collect() == [] and quality.keep_good(no_docs).collect() == []


def test_fit_separates():
    rng = np.random.default_rng(1)
    matrix = rng.random((200, 8)).astype(np.float32)
    good = (matrix[:, 0] > matrix[:, 1]).astype(np.float32)
    scorer = quality.fit(matrix, good)
    guess = matrix @ scorer.weights + scorer.bias > 0
    assert (guess == (good > 0.5)).mean() > 0.95
    assert quality.fit(np.zeros((0, 8), np.float32), np.zeros(0, np.float32)).bias == 0


@pytest.mark.parametrize("text", ["Menu " * 300, "!!! ### $$$ " * 50])
def test_votes_against_junk(text):
    import pyarrow as pa

    page = next(quality._pages(pa.array([text])))
    assert (quality._votes(page, quality._hash_of(quality.STOP_WORDS)) == -1).sum() >= 3
