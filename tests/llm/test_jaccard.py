from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from conftest import SF
from edge_rows import edge_documents, no_documents

from tidecube.llm import jaccard
from tidecube.llm.components import components
from tidecube.llm.jaccard import deduplicated, jaccard_join, needed_matches, op4_jaccard_join


def shingles(text, n=5):
    words = [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower()) if w]
    if not words:
        return None
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_force(docs, threshold=0.8):
    """(doc_id, class_id, copy_id, n_copies, n_links) of every row, comparing all pairs."""
    sets: dict = {}
    for i, text in docs:
        if (s := shingles(text)) is not None:
            sets.setdefault(s, []).append(i)
    keys = list(sets)
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for i, a in enumerate(keys):
        for j in range(i):
            if len(a & keys[j]) >= threshold * len(a | keys[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, key in enumerate(keys):
        known = [x for x in sets[key] if x is not None]
        least.setdefault(find(i), []).extend(known)
    out = []
    for i, text in docs:
        s = shingles(text)
        if s is None:
            out.append((i, i, i, 1, 0))
            continue
        k = keys.index(s)
        own = [x for x in sets[s] if x is not None]
        whole = least[find(k)]
        out.append((i, min(whole, default=None), min(own, default=None), len(sets[s]), links[k]))
    return sorted(out, key=str)


def family(seed, size, length, edits):
    """Copies of one text with a few words replaced, each its own."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(size):
        words = list(base)
        for _ in range(r.randrange(edits + 1)):
            words[r.randrange(length)] = f"x{r.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_equals_brute_force(spark):
    texts = family(1, 40, 100, 4) + family(2, 5, 12, 1) + family(3, 30, 200, 12)
    texts += [f"text {i} on its own with other words {i * 7}" for i in range(50)] + texts[:7] + ["a b"] * 3
    docs = list(enumerate(texts))
    random.Random(5).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(jaccard_join(df)) == brute_force(docs)


def test_blocks_of_a_bucket_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "PAIRS_AT_ONCE", 11)
    docs = list(enumerate(family(4, 60, 80, 3)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(jaccard_join(df)) == brute_force(docs)


def test_equals_brute_force_on_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows(op4_jaccard_join(spark, SF)) == brute_force(docs)


def test_pruning_keeps_what_may_reach_the_threshold():
    needed = needed_matches(0.8, 1e-6)
    assert list(needed) == sorted(needed) and 0 < needed[16] < 0.8 * 16 and needed[96] < 0.8 * 96
    assert needed_matches(0.8, 0.5)[96] > needed[96]


def test_edges(spark):
    docs = edge_documents(spark)
    want = brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(jaccard_join(docs)) == want
    assert rows(jaccard_join(no_documents(spark))) == []
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, None, 6, 8, 7])
    assert deduplicated(no_documents(spark)).collect() == []


def test_one_document_of_each_component_stays(spark):
    docs = list(enumerate(family(6, 20, 60, 2) + family(7, 20, 60, 2)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {r[1] for r in brute_force(docs)}
    assert {r.doc_id for r in deduplicated(df).collect()} == want


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    r = random.Random(3)
    links = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(0, i) for i in range(1, 80)] + [(500, 501)],
        "random": [(r.randrange(120), r.randrange(120)) for _ in range(80)] + [(5, 5), (None, 3)],
        "none": [],
    }[shape]
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    df = spark.createDataFrame(links, "a long, b long")
    assert {x.node: x.root for x in components(df).collect()} == {x: find(x) for x in root}


def test_query_equals_sql(spark, duck):
    assert rows(op4_jaccard_join(spark, SF)) == sorted(duck.execute(jaccard.SQL).fetchall(), key=str)
