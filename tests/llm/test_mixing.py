from __future__ import annotations

import re

from conftest import SF
from edge_rows import edge_documents, no_documents

from tidecube.llm import mixing
from tidecube.llm.mixing import (
    document_shares,
    fair_mix,
    in_order,
    mixed_documents,
    op10_fair_mix,
    positions,
    served,
    targets,
)


def size(text):
    return len(re.findall(mixing.WORD, text or ""))


def filled(sizes, weights=(3, 1, 2), budget=1.5, passes=2):
    """Targets by handing the excess on until no source exceeds its bound."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full, left = {}, set(names)
    while left:
        rest = budget * sum(sizes.values()) - sum(full.values())
        share = rest / sum(weight[s] for s in left)
        over = {s for s in left if share * weight[s] > passes * sizes[s]}
        if not over:
            return full | {s: share * weight[s] for s in left}
        full |= {s: passes * sizes[s] for s in over}
        left -= over
    return full


def test_targets_by_brute_force(spark):
    for sizes in ({"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 30, None: 7},
                  {"x": 5}, {"a": 0, "b": 10}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in targets(df).collect()}
        want = filled(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_every_source_comes_to_its_target(spark):
    rows = op10_fair_mix(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in docs)
    sizes = {d.doc_id: size(d.text) for d in docs}
    source = {d.doc_id: d.source for d in docs}
    taken, aims = {}, {}
    for r in rows:
        assert r["size"] == sizes[r.doc_id] and 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        aims[source[r.doc_id]] = r.target
    assert all(0 <= aims[s] - taken[s] < 1 for s in aims)


def test_the_mix_is_sorted_and_its_texts_have_the_words(spark):
    docs = edge_documents(spark)
    rows = in_order(fair_mix(docs)).collect()
    assert [r.finish for r in rows] == sorted(r.finish for r in rows)
    texts = mixed_documents(docs)
    assert texts.columns == docs.columns
    assert sorted(size(t.text) for t in texts.collect()) == sorted(r.words for r in rows)
    originals = {d.doc_id: d.text for d in docs.collect()}
    assert all(originals[t.doc_id].startswith(t.text) for t in texts.collect())


def test_edges(spark):
    rows = served(edge_documents(spark)).collect()
    assert len(rows) == 10
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    for own in by_source.values():  # documents of a source follow each other without gaps
        own.sort(key=lambda r: (r["first"], r["size"]))
        at = 0
        for r in own:
            assert int(r["first"]) == at
            at += r["size"]
        assert {r.source_size for r in own} == {at}
    assert fair_mix(no_documents(spark)).collect() == []
    wordless = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert fair_mix(wordless).collect() == [] and served(wordless).count() == 2


def test_query_equals_sql(spark, duck):
    rows = sorted((tuple(r) for r in op10_fair_mix(spark, SF).collect()), key=str)
    assert rows == sorted(duck.execute(mixing.SQL).fetchall(), key=str)


def test_positions_follow_the_finish_times(spark):
    """Words before a row add up in the order of the sort, and end with the budget."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(positions(fair_mix(docs).drop("text")).collect(), key=lambda r: r.position)
    at = 0
    for r, after in zip(rows, [*rows[1:], None], strict=True):
        assert r.position == at and (after is None or r.finish <= after.finish)
        at += r.words
    budget = 1.5 * sum(size(d.text) for d in docs.collect())
    assert 0 <= budget - at < len({r.source for r in rows})
    cut = [r for r in rows if r.words < r["size"]]
    assert len(cut) <= len({r.source for r in rows})  # at most one in service per source
    assert all(r.finish <= 1 + 1e-9 for r in rows if r.words == r["size"])


def test_repeated_rows_share_the_mix(spark):
    """Rows that repeat, wordless ones and null sources: each has its own share."""
    rows = [(1, "a b c", None), (1, "a b c", None), (2, "", None), (2, None, None), (3, "x", "s"), (None, "y z", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r.doc_id or 0, r["size"], r.taken, r.position is None) for r in document_shares(docs).collect()))
    mix = fair_mix(docs).collect()
    assert sum(g[2] for g in got) == sum(r.words for r in mix)
    assert [g[:2] for g in got] == [(0, 2), (1, 3), (1, 3), (2, 0), (2, 0), (3, 1)]
    assert all((g[2] == 0) == g[3] for g in got)
    assert document_shares(docs.limit(0)).collect() == []
