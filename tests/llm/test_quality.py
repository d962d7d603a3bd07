from __future__ import annotations

import random
import zlib

import numpy as np
from edge_rows import edge_documents, no_documents

from tidecube.llm import quality
from tidecube.llm.quality import accepted, class_prior, features, fit, score, scored

BIG = "/root/testdata/sf0.1"  # a smaller table has under a hundred held-out labels


def drawn(seed, n, shift):
    r = np.random.default_rng(seed)
    return r.normal(shift, 1, size=(n, quality.N_FEATURES)).astype(np.float32)


def test_prior_and_scores_on_known_mixtures():
    for share in (0.3, 0.7):
        good = int(4000 * share)
        positive = drawn(1, 2000, 0.6)
        unlabelled = np.concatenate([drawn(2, good, 0.6), drawn(3, 4000 - good, -0.6)])
        unlabelled = unlabelled[np.random.default_rng(4).permutation(4000)]
        model = fit(positive, unlabelled)
        assert abs(model.prior - share) < 0.08
        assert (score(model, drawn(5, 1000, 0.6)) >= 0.5).mean() > 0.9
        assert (score(model, drawn(6, 1000, -0.6)) >= 0.5).mean() < 0.1


def test_no_model_without_samples():
    assert fit(drawn(1, 0, 0), drawn(1, 9, 0)) is None and fit(drawn(1, 9, 0), drawn(1, 0, 0)) is None
    assert score(None, drawn(1, 3, 0)).tolist() == [1, 1, 1]
    assert fit(drawn(1, 1, 0), drawn(1, 1, 0)) is not None
    edges = np.zeros((quality.N_FEATURES, 3))
    assert class_prior(drawn(1, 1, 0), drawn(1, 5, 0), edges) == 0.5


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    rows = {r.doc_id: r for r in scored(docs, labels).collect()}
    assert len(rows) == docs.count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(rows[x.doc_id], x.quality) for x in labels.collect() if rows[x.doc_id].held_out]
    assert sum(r.predicted == q for r, q in held) / len(held) > 0.97
    kept = {r.doc_id for r in accepted(docs, labels).collect()}
    assert kept == {i for i, r in rows.items() if r.predicted}


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    flipped = labels.withColumn("quality", quality.F.when(
        quality.held_out(quality.F.col("doc_id")), 1 - quality.F.col("quality")
    ).otherwise(quality.F.col("quality")))
    assert sorted(scored(docs, labels).collect()) == sorted(scored(docs, flipped).collect())


def test_edges(spark):
    labels = spark.createDataFrame(
        [(3, 1, 0), (8, 1, 0), (8, 0, 0), (4, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"
    )
    docs = edge_documents(spark)
    rows = scored(docs, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 4}) == 1
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    assert {r.score for r in scored(docs, labels.limit(0)).collect()} == {1.0}
    assert accepted(docs, labels.limit(0)).columns == docs.columns
    assert scored(no_documents(spark), labels).collect() == []
    assert features(None).tolist() == features("").tolist()


def test_features_look_at_the_whole_text():
    r = random.Random(1)
    text = " ".join(f"w{r.randrange(1000)}" for _ in range(50_000))
    assert features(text + " ###" * 30_000).tolist() != features(text).tolist()
