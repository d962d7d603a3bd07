from __future__ import annotations

import zlib

import numpy as np
from conftest import SF
from edge_rows import edge_documents, no_documents

from tidecube.llm import language
from tidecube.llm.language import fit, languages, letters, op5_language, present

BIG = "/root/testdata/sf0.01"


def test_presence_is_that_of_all_n_grams():
    table = letters()
    found = present("Ab 1c", table)
    singles = [present(x, table) for x in ("a", "b", "c")]
    assert all((found & s).sum() == s.sum() for s in singles)
    assert found.sum() <= 4 + 4 + 3  # a b blank c; ab b_ __ _c; ab_ b__ __c
    assert (present("abcabc", table) & present("abc", table)).sum() == present("abc", table).sum()
    assert present("", table) is None and present("1 2!", table) is None and present(None, table) is None
    assert present("中文", table) is not None and present("𐐀", table) is not None


def test_symbols_beyond_the_first_65536_code_points_are_no_letters(spark):
    table = letters()
    assert present("😀 🚀🎉", table) is None and present("𝟙𝟚 🜁", table) is None
    assert (present("ab 😀c", table) == present("ab 1c", table)).all()
    docs = [(k, "the words of a text", "en") for k in range(20)] + [(90, "😀🚀 🎉", "en"), (91, "𐐀𐐁", "en")]
    rows = languages(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert got[90] == ("und", 0.0) and got[91][0] == "en" and got[1][0] == "en"


def test_kernel_ridge_regression_against_the_full_kernel():
    """With every text a landmark, margins are those of the exact kernel matrix."""
    r = np.random.default_rng(1)
    sets = [np.sort(r.choice(200, 40, replace=False) + 100 * (k % 2)).astype(np.uint16) for k in range(60)]
    names = ["a" if k % 2 else "b" for k in range(60)]
    model = fit(sets, names)
    rows = np.zeros((60, language.SLOTS))
    for k, s in enumerate(sets):
        rows[k, s] = 1 / np.sqrt(len(s))
    kernel = rows @ rows.T
    truth = np.array([[1.0 if n == x else -1.0 for x in ("a", "b")] for n in names])
    exact = kernel @ np.linalg.solve(kernel + language.RIDGE * 60 * np.eye(60), truth)
    own = rows[:, model.slots] @ model.weights
    assert np.abs(own - exact).max() < 0.05
    assert [model.languages[j] for j in own.argmax(axis=1)] == names


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    rows = op5_language(spark, BIG).collect()
    assert {r.doc_id for r in rows} == docs.keys()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.98


def test_edges(spark):
    rows = languages(edge_documents(spark)).collect()
    got = {r.doc_id: r.lang_pred for r in rows}
    assert len(rows) == 10
    assert all(got[i] == "und" for i in (1, 2, 6, 7))
    assert all(got[i] in ("en", "de", "fr") for i in (3, 4, 5, 8, None))
    assert languages(no_documents(spark)).collect() == []
    unknown = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in languages(unknown).collect()] == [("und", 0.0)]
    assert fit([], []) is None


def test_small_tables(spark):
    assert op5_language(spark, SF).count() == 200
