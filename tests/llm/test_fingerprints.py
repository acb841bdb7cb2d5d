import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattframe.llm.fingerprints import PrefixHashes, fingerprint, fingerprints, likeness

TEXT = st.text(st.sampled_from("abé🙂\x00 "), max_size=40)


def hashes(text):
    return PrefixHashes(np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64))


@settings(max_examples=200, deadline=None)
@given(TEXT, TEXT, st.integers(0, 40), st.integers(0, 40))
def test_spans_and_extensions(one, other, i, j):
    i, j = min(i, len(one)), min(j, len(other))
    a, b = hashes(one), hashes(other)
    n = 0
    while i + n < len(one) and j + n < len(other) and one[i + n] == other[j + n]:
        n += 1
    assert a.common_extension(i, b, j) == n
    if i + n < len(one) and j + n < len(other):
        assert a.span(i, i + n + 1) != b.span(j, j + n + 1)
    kept, taken = len(one) - len(one) // 4, min(len(one) // 4, len(other))
    whole = hashes(one[:kept] + other[:taken])
    glued = a.edited(kept, b, taken)
    assert all(np.array_equal(x, y) for x, y in zip(whole.sums, glued.sums, strict=True))


def test_likeness_follows_the_share_in_common():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(2000)]
    text, other = " ".join(words[:1000]), " ".join(words[1000:])
    assert likeness(fingerprint(text), fingerprint(text)) == 1 and likeness(fingerprint(text), fingerprint(other)) == 0
    near = [likeness(fingerprint(text), fingerprint(" ".join(words[:n] + words[1000 : 2000 - n]))) for n in (900, 500, 100)]
    assert near[0] > 0.75 and 0.3 < near[1] < 0.7 and near[2] < 0.3
    # a change in front leaves what is behind it alike
    assert likeness(fingerprint(text), fingerprint("new " + text)) > 0.95
    assert likeness(fingerprint(""), fingerprint(None)) == 1 and likeness(fingerprint(""), fingerprint("a")) == 0


def test_likeness_of_short_texts():
    rng = random.Random(6)
    for size in [*range(4, 31), 45, 70, 99, 130]:
        text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size))
        other = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(size))
        edited = text[: size - size // 4] + other[: size // 4]
        assert likeness(fingerprint(text), fingerprint(edited)) > 0.35, size
        assert likeness(fingerprint(text), fingerprint(other)) < 0.1
    # either text is short
    assert likeness(fingerprint(text[:90]), fingerprint(text[:110])) > 0.7
    assert likeness(fingerprint("Breaking news today"), fingerprint("Breaking news today!")) > 0.8


def want(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        n = len(t) // 4
        e = t[: len(t) - n] + u[:n]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprint(t), fingerprint(e)))
    return out, rows


def test_rows_and_their_next(odd_docs, odd_rows):
    expected, rows = want([(i, t) for i, t, _ in odd_rows])
    got = fingerprints(odd_docs).collect()
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, expected))
    for r in got:
        assert r.near_edited == likeness(r.fingerprint, r.edited_fingerprint)
        assert 0 <= r.near_next <= 1
        # the last quarter goes; what is left may go on alike
        assert r.same_as_edited >= min(r.n_chars - r.n_chars // 4, r.same_as_edited + 1)
    by_text = {}
    for (_, t), e in zip(rows, expected, strict=True):
        assert by_text.setdefault(e[3], t) == t


def test_many_buckets(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(10**12), "t" * rng.randrange(60) + str(k)) for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(tuple(r)[:5] for r in fingerprints(docs).collect()) == sorted(want(rows)[0])


def test_documents_are_dealt_evenly(spark):
    """No partition gets more than its share, as the sort holds its texts."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    got = fingerprints(docs).groupBy(F.spark_partition_id().alias("at")).count().collect()
    share = 6000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(r["count"] for r in got) == 6000 and max(r["count"] for r in got) <= 1.2 * share


def test_null_ids_are_a_bucket_before_others(spark):
    rows = [(k if k >= 40 else None, f"the text of document {k % 170} as it is") for k in range(400)] + [(200, "again")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(repr, (tuple(r)[:5] for r in fingerprints(docs).collect()))) == sorted(map(repr, want(rows)[0]))


def test_one_and_none(spark, no_docs):
    assert fingerprints(no_docs).collect() == []
    (only,) = fingerprints(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).collect()
    assert only.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and only.near_next == 1
