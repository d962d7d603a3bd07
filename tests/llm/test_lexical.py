from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from conftest import SF
from edge_rows import CLASHING, SAME, edge_documents, no_documents

from tidecube.llm import lexical
from tidecube.llm.lexical import SQL, op13_lexical_search, search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=20):
    """Every document against every item, as the contract words it."""
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    number, length = len(counted), sum(sum(c.values()) for _, c in counted)
    holders = Counter(t for _, c in counted for t in c)
    texts = {}
    for item, text in dict.fromkeys(items):
        texts.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, wanted in texts.items():
        scored = []
        for doc, c in counted:
            m = 100 - 25 + (25 * sum(c.values()) * number) // length
            score = sum(
                k * math.floor(1000 * math.log((2 * number + 2) / (2 * holders[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
                for t, k in wanted.items() if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score)
                for rank, (score, none, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(items, "item_id long, text string"))


def test_query_equals_sql(spark, duck):
    got = rows(op13_lexical_search(spark, SF).select("item_id", "rank", "doc_id", "score"))
    assert got == sorted(duck.execute(f"SELECT item_id, rank, doc_id, score FROM ({SQL})").fetchall(), key=str)
    assert got


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_against_brute_force(spark, seed, monkeypatch):
    r = random.Random(seed)
    vocabulary = ["a", "B", "ß", "É", "é", "x1", "9", "naïve", "word", "日本", "İ"]

    def text(most):
        return r.choice([" ", "-", "\x00", "_", "\n"]).join(r.choices(vocabulary, k=r.randrange(most)))

    docs = [(r.randrange(60), text(12)) for _ in range(80)] + [(None, text(12)), (7, None), (None, text(3))]
    items = [(i % 7, text(6)) for i in range(9)] + [(None, "word a"), (8, ""), (9, None)]
    want = plain(docs, items, 5)
    assert rows(search(*frames(spark, docs, items), top=5)) == want
    # The same from an index in several blocks, with small steps.
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(lexical, "CELLS", 8)
    monkeypatch.setattr(lexical, "PAIRS", 2)
    assert rows(search(*frames(spark, docs, items), top=5)) == want


def test_ties_go_to_the_smaller_id_and_copies_all_rank(spark):
    docs = [(i, "the same words") for i in range(50, 0, -1)] + [(99, "other text here")] * 3
    got = rows(search(*frames(spark, docs, [(1, "same same"), (2, "other")])))
    assert [d for i, _, d, _ in sorted(got) if i == 1] == list(range(1, 21))
    assert [(i, k, d) for i, k, d, _ in sorted(got) if i == 2] == [(2, 1, 99), (2, 2, 99), (2, 3, 99)]
    assert got == plain(docs, [(1, "same same"), (2, "other")])


def test_edge_rows(spark):
    docs = edge_documents(spark)
    clashing = ", ".join(f"{c} string" for c in CLASHING)
    items = spark.createDataFrame(
        [(1, SAME, *["x"] * len(CLASHING)), (1, SAME, *["y"] * len(CLASHING)), (2, "word3 and5", *["x"] * len(CLASHING)),
         (3, None, *["x"] * len(CLASHING))], f"item_id long, text string, {clashing}")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain(pairs, [(1, SAME), (2, "word3 and5"), (3, None)])
    assert rows(search(docs, items)) == want and {w[0] for w in want} == {1, 2}


def test_empty_tables(spark):
    docs, items = edge_documents(spark), spark.createDataFrame([(1, "one")], "item_id long, text string")
    for a, b in ((no_documents(spark), items), (docs, items.limit(0)),
                 (docs.filter("text IS NULL"), items), (docs, items.selectExpr("item_id", "'...' AS text"))):
        out = search(a, b)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
