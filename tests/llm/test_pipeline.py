import numpy as np
import pytest

import corpus_pipeline
from checks.compare import connect, rows_of, rows_of_sql
from wattframe.llm import queries, quality
from wattframe.llm.common import table

from .test_dedup import LOWER
from .test_ngram_join import brute

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_agree_with_sql(spark, name):
    assert rows_of(queries.queries()[name](spark, SF)) == rows_of_sql(connect(SF), queries.oracle_sql()[name])


def test_one_query_per_operator():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]


def test_stages_against_plain_ones(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    by_name = dict(corpus_pipeline.STAGES)
    assert len(by_name) == 5

    good = by_name["quality classifier"](spark, docs, SF).cache()
    kept = {r.doc_id for r in quality.classify(docs).collect() if r.kept}
    assert {r.doc_id for r in good.collect()} == kept and good.columns == columns

    unlike = by_name["exact dedup"](spark, good, SF).cache()
    last = {}
    for r in good.collect():
        key = (r.text or "").translate(LOWER)
        last[key] = max(r.doc_id, last.get(key, -1))
    assert sorted(r.doc_id for r in unlike.collect()) == sorted(last.values()) and unlike.columns == columns

    alone = by_name["n-gram Jaccard join"](spark, unlike, SF).cache()
    component, _ = brute([(r.doc_id, r.text) for r in unlike.collect()], 5, 80, 100)
    assert {r.doc_id for r in alone.collect()} == set(component.values()) and alone.columns == columns

    mixed = by_name["mixing sources"](spark, alone, SF).cache()
    assert mixed.columns == columns
    uses = [r.doc_id for r in mixed.collect()]
    assert {uses.count(i) for i in set(uses)} <= {1, 2, 3}
    words = lambda rows: sum(len((r.text or "").split()) for r in rows)
    assert abs(words(mixed.collect()) / words(alone.collect()) - 1) < 0.1

    packed = by_name["best-fit packing"](spark, mixed, SF).collect()
    filled = {}
    for r in packed:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 1024 and len(filled) <= np.ceil(sum(filled.values()) / 1024) * 1.02 + 1


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "piece", "sequence_id", "offset", "length", "ids_crc32"} <= set(got.columns) and got.count() > 100
