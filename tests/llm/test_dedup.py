import hashlib
import random
from collections import defaultdict

from wattframe.llm import exact_dedup
from wattframe.llm.exact_dedup import drop_copies, exact_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def check(rows, got, keep=max):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        digest = r.text_sha256
        kept[digest] += r.kept
    for norm, ids in groups.items():
        digest = hashlib.sha256(norm.encode()).hexdigest()
        mine = [r for r in got if r.text_sha256 == digest]
        want = keep([i for i in ids if i is not None], default=None)
        assert sorted(map(repr, (r.doc_id for r in mine))) == sorted(map(repr, ids))
        assert {(r.keep_id, r.group_size) for r in mine} == {(want, len(ids))}
        assert kept[digest] == 1 and [r.doc_id for r in mine if r.kept] == [want]


def test_odd_texts(odd_docs, odd_rows):
    rows = [(i, t) for i, t, _ in odd_rows]
    check(rows, exact_groups(odd_docs).collect())
    check(rows, exact_groups(odd_docs, keep="smallest").collect(), keep=min)


def test_nothing(no_docs):
    assert exact_groups(no_docs).collect() == []
    assert drop_copies(no_docs).collect() == [] and drop_copies(no_docs).columns == no_docs.columns


def test_a_third_of_all_rows_is_one_text(spark):
    rng = random.Random(7)
    shared = "the same beginning of many texts, " * 4
    rows = [(k, "Copy of ONE text" if k % 3 == 0 else shared + str(rng.randrange(500))) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for keep, choose in (("largest", max), ("smallest", min)):
        check(rows, exact_groups(docs, keep).collect(), keep=choose)


def test_kept_rows_have_all_columns(odd_docs, odd_rows):
    got = drop_copies(odd_docs)
    assert got.columns == odd_docs.columns
    texts = [(t or "").translate(LOWER) for _, t, _ in odd_rows]
    kept = got.collect()
    assert sorted((r.text or "").translate(LOWER) for r in kept) == sorted(set(texts))
    assert all(r["row"] == "row" for r in kept)


def test_no_python_on_the_main_path(odd_docs):
    plan = exact_groups(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and exact_dedup.PREFIX == 64
