import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from wattframe.llm.components import components
from wattframe.llm import ngram_join
from wattframe.llm.ngram_join import SizeBands, drop_similar, similar_documents, similarity
from wattframe.llm.shingles import shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, least, of):
    """Smallest doc_id that links lead to, by doc_id."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    by_shingle = defaultdict(set)
    for n, (_, s) in enumerate(sets):
        for g in s:
            by_shingle[g].add(n)
    for n, (i, s) in enumerate(sets):
        for m in set().union(*(by_shingle[g] for g in s)) if s else ():
            j, t = sets[m]
            if m < n and of * len(s & t) >= least * len(s | t):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: top(i) for i, _ in sets}, {i: len(s) for i, s in sets}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(11)
    word = lambda: "w%d" % rng.randrange(3000)
    passage = [word() for _ in range(60)]
    rows = []
    for size in (1, 3, 4, 7, 9, 12, 20, 45, 110, 300, 900):
        for _ in range(6):
            base = [word() for _ in range(size)]
            rows.append(base)
            for _ in range(4):
                rows.append(edited(rng, base, rng.randrange(1 + size // 18)) + [word()] * rng.randrange(1 + size // 12))
    # a chain of copies, each a little further, and many texts with one passage
    chain = [word() for _ in range(200)]
    for _ in range(25):
        chain = edited(rng, chain, 2)
        rows.append(chain)
    rows += [passage + [word() for _ in range(rng.randrange(8, 80))] for _ in range(60)]
    rows = [" ".join(r) if rng.random() < 0.8 else "\n".join(r).upper() for r in rows]
    rows += rows[:5] + ["", None]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(n, rows[k]) for n, k in enumerate(order)]


@pytest.mark.parametrize(("k", "least"), [(4, 85), (5, 80)])
def test_groups_are_those_of_brute_force(spark, near_rows, k, least):
    docs = spark.createDataFrame(near_rows, "doc_id long, text string").repartition(6)
    got = similar_documents(docs, k, least, 100).collect()
    component, size = brute(near_rows, k, least, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (size[i], component[i]) for i, _ in near_rows}
    assert len(set(component.values())) < len(near_rows) - 100


def brute_links(rows, k, least, of):
    """The linked rows, as pairs of places."""
    sets = [shingles(t, k) for _, t in rows]
    pairs = ((n, m) for m in range(len(sets)) for n in range(m) if sets[n] and sets[m])
    return {(n, m) for n, m in pairs if of * len(sets[n] & sets[m]) >= least * len(sets[n] | sets[m])}


@pytest.mark.parametrize("block", [1024, 5])
def test_all_links_are_found(spark, near_rows, monkeypatch, block):
    """Also inside a component, however many classes of a key a task compares at once."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "COUNTED", block)
    rng = random.Random(4)
    base = [f"b{rng.randrange(500)}" for _ in range(150)]
    rows = near_rows + [(10_000 + k, " ".join(edited(rng, base, 1 + k // 50))) for k in range(60)]
    rows += [(10_000 + k, rows[len(near_rows) + k][1].upper()) for k in range(3)]
    want = brute_links(rows, 4, 85, 100)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    count = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        count[i].append(sum(n in pair for pair in want))
    got = defaultdict(list)
    for r in similar_documents(docs).collect():
        got[r.doc_id].append(r.n_links)
    assert {i: sorted(c) for i, c in got.items()} == {i: sorted(c) for i, c in count.items()}
    assert len(want) > 1000

    members, links = similarity(docs)
    of = defaultdict(list)
    for r in members.collect():
        if r.set is not None:
            of[r.set].append(r.doc_id)
    links = links.collect()
    assert all((r.a_id, r.b_id, r.a_members, r.b_members) == (min(of[r.a]), min(of[r.b]), len(of[r.a]), len(of[r.b])) for r in links)
    told = [tuple(sorted((i, j))) for r in links for i in of[r.a] for j in of[r.b]]
    told += [tuple(sorted((c[n], c[m]))) for c in of.values() for m in range(len(c)) for n in range(m)]
    assert sorted(told) == sorted(tuple(sorted((rows[n][0], rows[m][0]))) for n, m in want)


def test_odd_texts(spark, odd_docs, odd_rows):
    got = similar_documents(odd_docs).collect()
    assert len(got) == len(odd_rows)
    # rows 1 to 3 are one set; -5 has most of it
    known = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    want, _ = brute([(i, t) for i, t, _ in odd_rows if i is not None], 4, 85, 100)
    assert known == want
    assert sorted(r.n_shingles for r in got if r.doc_id is None) == [0, 1]
    assert {r.component_id for r in got if r.doc_id is None} == {None}


def test_many_copies_of_one_set(spark):
    rows = [(k, "a b c d e f" if k % 3 else f"text number {k} is of its own") for k in range(6000)]
    got = similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.component_id == (1 if r.doc_id % 3 else r.doc_id) for r in got) and len(got) == 6000


def test_nothing(no_docs):
    assert similar_documents(no_docs).collect() == []
    assert drop_similar(no_docs).columns == no_docs.columns and drop_similar(no_docs).collect() == []


def test_one_of_each_group_stays(odd_docs, odd_rows):
    kept = drop_similar(odd_docs).collect()
    want, _ = brute([(i, t) for i, t, _ in odd_rows if i is not None], 5, 80, 100)
    assert {r.doc_id for r in kept if r.doc_id is not None} == set(want.values())
    assert sum(r.doc_id is None for r in kept) == 2


def test_rows_without_an_id_of_their_own(spark):
    """Null, repeated and shared ids: one row of each group stays, and clean rows all do."""
    rng = random.Random(8)
    text = lambda n: " ".join(edited(rng, base, n))
    base = [f"a{rng.randrange(400)}" for _ in range(200)]
    nameless = [(None, text(1), f"n{k}") for k in range(3)]
    clean = [(7, " ".join(f"clean{k}" for k in range(40)), "c"), (None, " ".join(f"other{k}" for k in range(40)), "c")]
    base = [f"b{rng.randrange(400)}" for _ in range(200)]
    near = [(9, text(1), "s"), (7, text(1), "s"), (None, text(1), "s"), (12, text(0), "s")]
    twice = [(5, "five words that come twice", "x"), (5, "five words that come twice", "y"), (None, "", "e"), (None, "", "e")]
    rows = nameless + clean + near + twice
    docs = spark.createDataFrame(rows, "doc_id long, text string, _ROW string").repartition(4)
    kept = drop_similar(docs)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert len(got) == 1 + 2 + 1 + 1 + 2 and set(got) <= set(rows)
    assert sum(r in nameless for r in got) == 1 and set(clean) <= set(got) and near[1] in got
    assert sum(r[2] in "xy" for r in got) == 1 and got.count((None, "", "e")) == 2


def test_shingles_of_texts_are_apart():
    texts = ["a b c d e", "b c d e", "A  B\tC\nD E", "a", "", "x" * 50 + " b c d", "a b", "ab", None]
    sets = []
    for values, at in shingle_sets(pa.array(texts), 4):
        sets += [frozenset(v.tolist()) for v in np.split(values, at[1:-1])]
    assert [len(s) for s in sets] == [2, 1, 2, 1, 0, 1, 1, 1, 0]
    assert sets[0] == sets[2] and sets[1] < sets[0] and len({*sets[3:4], *sets[5:8]}) == 4


def test_bands_leave_equal_parts():
    for least in (80, 85, 95):
        bands = SizeBands(least, 100, 5000)
        a, b = np.meshgrid(np.arange(1, 5001, 7), np.arange(1, 5001, 7))
        a, b = a[(a >= b) & (100 * b >= least * a)], b[(a >= b) & (100 * b >= least * a)]
        over = bands.band(a)
        below = bands.band(b)
        assert ((over == below) | ((over == below + 1) & bands.reaches_next(b))).all()
        compared = bands.parts[over] > 0
        assert (2 * a * (100 - least) // (100 + least) == 0)[~compared].all()
        # full parts of a set that isn't thin are more than can differ
        n = np.arange(1, 5000)
        differing = (n + n * 100 // least) * (100 - least) // (100 + least)
        assert (~bands.thin(differing + 1, n) | (differing + 1 <= n * (100 - least) / least)).all()
        assert bands.thin(differing, n).all()
    with pytest.raises(ValueError):
        SizeBands(50, 100, 10)


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(2)
    chain = list(range(0, 400))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:], strict=False)) + [(1000, k) for k in range(1001, 1300)] + [(5000, 5000), (-3, 2000)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {k: 0 for k in range(400)} | {k: 1000 for k in range(1000, 1300)} | {-3: -3, 2000: -3}
    assert {r.node: r.component for r in got} == want
