from __future__ import annotations

import re

import pytest
from conftest import SF
from edge_rows import edge_documents, no_documents

import __spark_entry__ as registered
import corpus_pipeline
from tidecube.llm.decontamination import contaminated
from tidecube.llm.jaccard import jaccard_join
from tidecube.llm.mixing import fair_mix, in_order
from tidecube.llm.quality import scored
from tidecube.llm.tables import table, written


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the output of every stage."""
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, SF), name)
        out[name] = docs, result
        docs = result
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_return_the_columns_of_documents(spark, stages):
    columns = table(spark, SF, "documents").columns
    for name, (_, result) in list(stages.items())[:-1]:
        assert result.columns == columns, name
    assert stages["token_ids"][1].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_each_decision_takes_effect(spark, stages):
    docs, kept = stages["quality_classifier"]
    good = scored(docs, table(spark, SF, "labels")).filter("predicted = 1")
    assert ids(kept) == ids(good) and 0 < kept.count() < docs.count()
    docs, kept = stages["jaccard_join"]
    assert ids(kept) == sorted({r.class_id for r in jaccard_join(docs).collect()})
    assert {r.n_links for r in jaccard_join(kept).collect()} == {0} and kept.count() < docs.count()
    docs, kept = stages["decontamination"]
    bench = table(spark, SF, "benchmark")
    held = set(ids(contaminated(docs, bench)))
    assert held and ids(kept) == [i for i in ids(docs) if i not in held]
    docs, mixed = stages["fair_mix"]
    words = lambda df: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in df.collect())
    assert abs(words(mixed) - 1.5 * words(docs)) <= 20  # a word a source
    mixed, packed = stages["token_ids"]
    assert ids(packed) == ids(mixed)


def test_ids_lie_in_the_order_of_the_mix(spark, stages):
    """Packed order is finish order, and the two passes of a document lie apart."""
    before, _ = stages["fair_mix"]
    _, packed = stages["token_ids"]
    want = [r.doc_id for r in in_order(fair_mix(before)).collect()]
    got = [r.doc_id for r in packed.orderBy("start").collect()]
    assert got == want and got != sorted(got)
    places = {}
    for place, i in enumerate(got):
        places.setdefault(i, []).append(place)
    apart = [b - a for a, b in (p for p in places.values() if len(p) == 2)]
    assert apart and sum(n > 1 for n in apart) >= 0.95 * len(apart)


def test_documents_without_files_are_packed_by_id(spark):
    docs = spark.createDataFrame([(2, "two"), (1, "one")], "doc_id long, text string")
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [1, 2]


def test_run_is_the_stages_one_after_another(spark, stages):
    run = sorted(map(tuple, registered.queries()["pipeline"](spark, SF).collect()))
    assert run == sorted(map(tuple, stages["token_ids"][1].collect()))


def test_edges(spark):
    for start in (edge_documents(spark), no_documents(spark)):
        docs = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, SF), name)
            assert docs.columns == start.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_operators_are_registered():
    names = [n for n in registered.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in registered.queries() and "op2_chat_format" in registered.oracle_sql()
