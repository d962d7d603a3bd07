from __future__ import annotations

import random

import numpy as np
from conftest import SF
from edge_rows import edge_documents, no_documents

from tidecube.llm import decontamination as d
from tidecube.llm.decontamination import align, contaminated, decontaminated, op6_decontamination


def smith_waterman(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = max(
                0, table[i][j] + (2 if x == y else -1), table[i][j + 1] - 1, table[i + 1][j] - 1
            )
    return max(map(max, table))


def test_alignment_equals_the_full_table():
    r = random.Random(1)
    pairs = [([r.randrange(6) for _ in range(r.randrange(1, 25))],
              [r.randrange(6) for _ in range(r.randrange(1, 40))]) for _ in range(60)]
    # Numbers four apart, as the two lowest bits are taken by filling values.
    made = [[np.array([4 * x for x in s], dtype=np.uint64) for s in p] for p in pairs]
    scores, ends = align([a for a, _ in made], [b for _, b in made])
    assert scores.tolist() == [smith_waterman(a, b) for a, b in pairs]
    for (a, b), score, end in zip(pairs, scores, ends, strict=True):
        assert smith_waterman(a, b[:end]) == score  # an end of a best alignment


def prose(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(10**6)}" for _ in range(n)]


def test_exact_and_edited_copies_are_found_and_clean_documents_left(spark):
    items = [(i, " ".join(prose(i, 40))) for i in range(20)]
    r = random.Random(9)
    docs, want = [], set()
    for k in range(200):
        around = prose(1000 + k, 150)
        if k % 3 == 0:
            item = k % 20
            words = items[item][1].split()
            for _ in range((k // 3) % 8):  # replaced, lost and added words
                at = r.randrange(1, len(words))
                words[at : at + r.randrange(2)] = prose(5000 + k, r.randrange(2))
            around[70:70] = [w.upper() + "," for w in words]
            want.add((k, item))
        docs.append((k, " ".join(around)))
    half = " ".join(items[3][1].split()[:10])
    docs.append((900, " ".join(prose(3, 5)[:0] + prose(77, 50)) + " " + half))  # a quarter only
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (52, "two words"), items[0]],
                                  "item_id long, text string")
    found = contaminated(df, bench).collect()
    assert {(x.doc_id, x.item_id) for x in found} == want and len(found) == len(want)
    assert all(0.5 <= x.score <= 1 and 60 <= x.first_word < x.last_word < 125 for x in found)
    kept = {x.doc_id for x in decontaminated(df, bench).collect()}
    assert kept == {k for k, _ in docs} - {k for k, _ in want}


def test_an_item_that_most_documents_hold_is_still_found(spark):
    item = " ".join(prose(1, 30))
    docs = [(k, " ".join(prose(k + 10, 20)) + " " + (item if k % 3 else "")) for k in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {x.doc_id for x in contaminated(df, bench).collect()} == {k for k in range(300) if k % 3}


def test_a_large_group_of_one_edited_copy_is_found_beside_a_verbatim_one(spark):
    item = prose(1, 24)
    edited = list(item)
    for at in (4, 9, 14, 19):
        edited[at] = "other"
    assert smith_waterman(item, edited) == 0.75 * 48
    docs = [(0, " ".join(prose(9, 20) + item))]
    docs += [(k, " ".join(prose(k + 10, 20) + edited)) for k in range(1, 1001)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {x.doc_id: x.score for x in contaminated(df, bench).collect()}
    assert found == {0: 1.0, **dict.fromkeys(range(1, 1001), 0.75)}
    assert decontaminated(df, bench).count() == 0


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    whole = sorted(map(tuple, op6_decontamination(spark, SF).collect()))
    monkeypatch.setattr(d, "BLOCK_SEEDS", 700)
    assert sorted(map(tuple, op6_decontamination(spark, SF).collect())) == whole


def test_documents_with_whole_items_are_found(spark):
    """On the test table: every document that holds the words of an item in a row."""
    def words(text):
        return " " + " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()) + " "

    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {(x.doc_id, b.item_id) for x in docs for b in bench if words(b.text) in words(x.text)}
    found = {(x.doc_id, x.item_id): x.score for x in op6_decontamination(spark, SF).collect()}
    assert want and want <= found.keys()
    assert all(found[p] == 1 for p in want)


def test_edges(spark):
    docs = edge_documents(spark)
    bench = spark.createDataFrame(
        [(1, "The very same text stands here twice"), (None, "without an id, and with words"), (3, None)],
        "item_id long, text string",
    )
    found = {(x.doc_id, x.item_id) for x in contaminated(docs, bench).collect()}
    assert found == {(4, 1), (5, 1), (None, None)}
    assert contaminated(docs, bench).count() == 4  # the repeated row twice
    clean = decontaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == 6
    assert contaminated(no_documents(spark), bench).collect() == []
    assert contaminated(docs, bench.limit(0)).collect() == []
    assert decontaminated(docs, bench.limit(0)).count() == 10
