from collections import defaultdict

import pytest

from wattframe.llm import line_dedup
from wattframe.llm.line_dedup import dedup_lines, drop_repeated_lines

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SHARED = "All rights reserved by the owner of this page"


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows, min_chars=20, min_docs=3):
    """(doc_id, text) -> doc_id, kept text, lines, dropped lines, in the order of the rows."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key_of(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = holders[key_of(line)]
            shared = len(key_of(line)) >= min_chars and len(ids) >= min_docs
            if not shared or i == max(x for x in ids if x is not None):
                kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def test_small_cases(spark):
    rows = [
        (1, f"{SHARED}\none"),
        (2, f"two\n \t{SHARED.upper()}\r\n{SHARED}\n"),
        (3, f"{SHARED}\nthree\n{SHARED}"),
        (4, "short line\n\n" + "x" * 20),
        (5, "short line\n" + "X" * 20 + " "),
        (6, "short line\n" + "\x0b" + "x" * 20),
        (7, "\n"),
        (8, f"no final {SHARED}"),
        (9, f" {SHARED}"),
        (10, "é" * 20),
        (11, "é" * 20),
        (12, "é" * 20 + "\n" + "y" * 19),
        (13, "y" * 19),
        (14, "y" * 19),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = got(dedup_lines(docs))
    assert found == brute(rows)
    by_id = {r[0]: r for r in found}
    assert by_id[1][1:] == ("one", 2, 1) and by_id[2][1:] == ("two\n", 4, 2) and by_id[3][3] == 0
    assert by_id[7][1:] == ("\n", 2, 0) and by_id[10][1:] == ("", 1, 1) and by_id[12][3] == 0
    assert got(dedup_lines(docs, min_chars=1, min_docs=2)) == brute(rows, 1, 2)


def test_odd_rows(spark, odd_docs, odd_rows):
    rows = [(i, t) for i, t, _ in odd_rows]
    assert got(dedup_lines(odd_docs)) == brute(rows)
    more = rows + [(None, SHARED), (None, SHARED), (None, f"a\n{SHARED}"), (3, SHARED), (3, f"{SHARED}\nb"), (9, SHARED)]
    docs = spark.createDataFrame(more, "doc_id long, text string").repartition(5)
    assert got(dedup_lines(docs)) == brute(more)


def test_nothing(no_docs):
    assert dedup_lines(no_docs).collect() == []
    assert drop_repeated_lines(no_docs).collect() == [] and drop_repeated_lines(no_docs).columns == no_docs.columns


@pytest.mark.parametrize("least", [10, 1000])
def test_a_line_of_a_third_of_all_documents(spark, monkeypatch, least):
    monkeypatch.setattr(line_dedup, "_LEAST_SPLIT", least)
    rows = [(k, (f"{SHARED}\n" if k % 3 == 0 else "") + f"line number {k // 5} that five documents have\nend {k}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(dedup_lines(docs)) == brute(rows)


def test_a_long_text_of_repeated_lines(spark):
    lines = [f"this is the repeated line number {k % 5000}" for k in range(20_000)]
    rows = [(k, "\n".join(lines[k:])) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(dedup_lines(docs)) == brute(rows)


def test_all_columns_stay(odd_docs):
    kept = drop_repeated_lines(odd_docs, min_docs=2)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert len(rows) == odd_docs.count() and all(r["row"] == "row" and r.salt == "salt" for r in rows)
    assert sum(r.text is None for r in rows) == sum(r.text is None for r in odd_docs.collect())


def test_no_python_on_the_main_path(odd_docs):
    plan = dedup_lines(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
