from __future__ import annotations

import numpy as np
from conftest import SF

from tidecube.llm import ann
from tidecube.llm.ann import build, build_index, op1_nearest, search, vectors_of

SCHEMA = "vec_id long, embedding array<float>, label int, shard int, block int, score double, rank int"


def rows_of(vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return [(i, None if v is None else [float(x) if x is not None else None for x in v], 0, 0, 0, 0.0, 0)
            for i, v in zip(ids, vectors, strict=True)]


def found(df, nearest=10, width=None, shard_rows=None):
    vectors = vectors_of(df)
    index = build_index(vectors, shard_rows or ann.SHARD)
    queries = vectors.filter(vectors.vec_id % 10 == 0)
    out = {}
    for r in search(index, queries, nearest, width or ann.SEARCH_WIDTH).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [x[1:] for x in sorted(v)] for q, v in out.items()}


def exact(vectors, ids, nearest=10):
    out = {}
    for k, q in enumerate(ids):
        if q % 10 == 0:
            d = np.sqrt(((vectors - vectors[k]) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:nearest]
            out[q] = [(int(ids[j]), d[j]) for j in order]
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hits / sum(map(len, want.values()))


def test_recall_over_several_shards(spark):
    vectors = np.random.default_rng(1).normal(size=(1500, 24)).astype(np.float32).astype(np.float64)
    ids = np.arange(1500)
    got = found(spark.createDataFrame(rows_of(vectors), SCHEMA), shard_rows=400)
    want = exact(vectors, ids)
    assert got.keys() == want.keys() and recall(got, want) > 0.98
    for q, rows in got.items():
        assert [s for _, s in rows] == sorted(s for _, s in rows)
        for i, s in rows:
            assert abs(s - np.sqrt(((vectors[i] - vectors[q]) ** 2).sum())) < 1e-12


def test_recall_of_one_graph():
    vectors = np.random.default_rng(2).normal(size=(2000, 32)).astype(np.float32)
    graph = build(vectors)
    assert all((links < 2000).all() and (links >= -1).all() for links in graph.layers)
    hits = 0
    for q in range(100):
        d = ((vectors - vectors[q]) ** 2).sum(axis=1)
        best = {n for _, n in graph.search(vectors[q], 100)[:10]}
        hits += len(best & set(np.argsort(d)[:10].tolist()))
    assert hits > 950


def test_copies_and_ties(spark):
    """A third of the vectors are one vector: its queries get the smallest ids."""
    vectors = np.random.default_rng(3).integers(-3, 4, size=(600, 4)).astype(np.float64)
    vectors[::3] = [1, 2, 3, 4]
    vectors[(vectors == 0).all(axis=1)] = 1
    got = found(spark.createDataFrame(rows_of(vectors), SCHEMA), shard_rows=250)
    assert got == exact(vectors, np.arange(600))


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], [0, 0], None, [nan, 1], [inf, 1], [None, 1], [], [1, 1], [2, 0], [1, 0, 0], [3, 0]]
    df = spark.createDataFrame(rows_of(vectors) + rows_of([[5, 5], [9, 9], [1, 1]], [7, 10, None]), SCHEMA)
    got = found(df)
    # Of the two vectors 7 and the two vectors 10 the lesser one counts; 9 has another length.
    assert got == {0: [(7, 1.0), (8, 1.0), (10, 2.0)], 10: [(8, 1.0), (0, 2.0), (7, 5**0.5)]}
    assert found(df.limit(0)) == {}


def test_query(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    vectors = np.array([r.embedding for r in table])
    ids = np.array([r.vec_id for r in table])
    rows = op1_nearest(spark, SF).collect()
    assert {r.query_id for r in rows} == {i for i in ids if i % 100 == 0}
    got = {}
    for r in rows:
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = {q: v for q, v in exact(vectors, ids).items() if q % 100 == 0}
    assert recall(got, want) >= 0.9


def test_query_equals_sql(spark, duck):
    rows = sorted(map(tuple, op1_nearest(spark, SF).collect()))
    assert rows == sorted(duck.execute(ann.SQL).fetchall())
