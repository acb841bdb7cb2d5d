import math
import re

import pytest

from wattframe.llm.mixing import integral, mix, mixed_documents, targets, training_order
from wattframe.llm.queries import CURRICULUM


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes, weights, most=3):
    """Targets by sharing again and again what limits leave over."""
    left, open_, out = sum(sizes), list(range(len(sizes))), {}
    while True:
        share = {k: left * weights[k] / sum(weights[j] for j in open_) for k in open_}
        full = [k for k in open_ if share[k] > most * sizes[k]]
        if not full:
            return [out.get(k, share.get(k)) for k in range(len(sizes))]
        for k in full:
            out[k] = most * sizes[k]
            left -= out[k]
            open_.remove(k)


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 500, 2], [0, 10, 10, 3], [5], [1, 1, 1000, 1, 1], [7, 0, 0, 1, 900, 2]])
def test_targets(spark, sizes):
    rows = [(chr(97 + k), n) for k, n in enumerate(sizes)]
    got = {r.name[1:]: r.target for r in targets(spark.createDataFrame(rows, "source string, size long"), CURRICULUM).collect()}
    want = filled(sizes, [(5, 2, 1)[k % 3] for k in range(len(sizes))])
    assert got == pytest.approx({s: w for (s, _), w in zip(rows, want, strict=True)})


def test_integrals():
    assert [integral(s) for s in CURRICULUM] == [5, 2, 1]
    assert integral(((0, 1), (0.25, 3), (1, 3))) == 0.5 + 2.25


def test_mix_meets_targets_and_repeats_no_more_than_thrice(spark):
    rows = [(k, "w " * (1 + k % 37), ("s0", "s1", "s2", None)[0 if k % 3 else k % 4]) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mix(docs, CURRICULUM).collect()
    assert sorted(got) == sorted(mix(docs.repartition(3), CURRICULUM).collect())
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert r.taken in (r.size * k for k in range(4)) and r["size"] == 1 + r.doc_id % 37
        by.setdefault(r.source, []).append(r)
    for some in by.values():
        assert abs(sum(r.taken for r in some) - some[0].target) <= 37
    assert math.isclose(sum(some[0].target for some in by.values()), sum(1 + k % 37 for k in range(3000)))
    # NULL comes last, as fourth with the first schedule
    assert by[None][0].nth == 3


def test_sources_come_as_scheduled(spark):
    rows = [(k, "a b c", f"s{k % 3}") for k in range(3000)]
    got = training_order(mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), CURRICULUM)).collect()
    used = [r for r in got if r.passes]
    assert [r.position for r in used] == sorted(r.position for r in used) and all(0 <= r.position <= 1 for r in used)
    mean = {s: sum(r.position for r in used if r.source == s) / sum(r.source == s for r in used) for s in ("s1", "s2")}
    # the even schedule is used evenly, the late one late: 7 / 12 on average
    assert abs(mean["s1"] - 0.5) < 0.02 and abs(mean["s2"] - 7 / 12) < 0.02


def test_odd_rows(odd_docs, odd_rows):
    got = mix(odd_docs, CURRICULUM).collect()
    assert sorted(r["size"] for r in got) == sorted(size_of(t) for _, t, _ in odd_rows)
    assert {r.source for r in got} == {s for *_, s in odd_rows}
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own) / 2 + 1


def test_nothing(no_docs):
    assert mix(no_docs, CURRICULUM).collect() == [] and mixed_documents(no_docs, CURRICULUM).collect() == []


def test_mixed_documents_come_once_per_use(spark):
    rows = [(k, "a b " * (1 + k % 5), f"s{k % 7}", "x") for k in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    passes = {r.doc_id: r.passes for r in mix(docs, CURRICULUM).collect()}
    got = mixed_documents(docs, CURRICULUM)
    assert got.columns == docs.columns
    seen = [r.doc_id for r in got.collect()]
    assert {k: seen.count(k) for k in passes} == passes and 1 < max(passes.values()) <= 3
