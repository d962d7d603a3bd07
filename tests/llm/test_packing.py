from __future__ import annotations

import uuid
import zlib

import numpy as np
import pytest
from edge_rows import TEXTS, edge_documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tidecube.llm import packing
from tidecube.llm.packing import Encoder, ids_of, pack, packed, unpack, width, write_packed
from tidecube.llm.tables import shared_folder


@pytest.fixture(scope="module")
def encoder():
    return Encoder(packing.TOKENIZER)


def library(encoder, texts):
    return [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.whole(texts)]


@given(st.integers(1, 31), st.lists(st.integers(0, 2**31 - 1), max_size=300), st.data())
@settings(max_examples=80, deadline=None)
def test_packed_ids_come_back_whole_and_in_part(bits, ids, data):
    ids = np.array(ids, dtype="<u4") & np.uint32((1 << bits) - 1)
    stored = pack(ids, bits)
    assert len(stored) == (len(ids) * bits + 7) // 8
    assert unpack(stored, bits, 0, len(ids)).tolist() == ids.tolist()
    first = data.draw(st.integers(0, len(ids)))
    count = data.draw(st.integers(0, len(ids) - first))
    assert unpack(stored, bits, first, count).tolist() == ids[first : first + count].tolist()


def test_width():
    assert [width(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


PIECES = st.sampled_from(
    [" ", "  ", "\n", "\t", "　", "a", "word", "Größe", "it's", "3.14", ".", "...", ",", "é", "é",
     "²", "_", "<|endoftext|>", "Ġx", "中文", "—", "'", "###"]
)


@given(st.lists(st.lists(PIECES, max_size=12).map("".join), max_size=6))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_the_library(encoder, texts):
    assert [x.tolist() for x in encoder(texts)] == library(encoder, texts)


def test_small_generations_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_CHUNKS", 50)
    own = Encoder(packing.TOKENIZER)
    texts = [f"alpha{i} beta{i % 7}, gamma{i}.\nDelta{i % 3} the end" for i in range(300)]
    for at in range(0, 300, 20):
        assert [x.tolist() for x in own(texts[at : at + 20])] == library(own, texts[at : at + 20])


def test_new_words_are_merged_without_being_split_first(monkeypatch):
    own, seen = Encoder(packing.TOKENIZER), []
    texts = ["one alpha beta, gröÞe.\nDelta alpha; ŷŵ\u024f ŷŵ\u024f! last", "x " + " ".join(map(chr, range(0xC0, 0x250)))]
    want, whole = library(own, texts), own.whole
    monkeypatch.setattr(own, "whole", lambda texts: seen.extend(texts) or whole(texts))
    assert [x.tolist() for x in own(texts)] == want
    assert not any(word in text for text in seen for word in ("alpha", "beta", "grö", "ŷŵ", "last"))


def test_a_worker_keeps_as_many_chunks_as_its_last_task_asks_for():
    kept = Encoder.of_process(packing.TOKENIZER, 50)
    again = Encoder.of_process(packing.TOKENIZER, 70)
    assert again is kept and again.cached_chunks == 70
    for k in range(0, 3000, 30):
        again([" ".join(["a", *(f"w{i}x" for i in range(k, k + 30))])])
    assert len(again._known) <= 140


def test_documents_come_back_from_the_blocks(spark, encoder):
    docs = edge_documents(spark)
    rows = packed(docs).orderBy("start").collect()
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r.doc_id for r in rows] == [r[0] for r in order]
    at = 0
    for row, (_, text, *_) in zip(rows, order, strict=True):
        ids = np.array([*library(encoder, [text or ""])[0], 0], dtype="<u4")
        assert (row.start, row.n_tokens, row.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert packed(no_documents(spark)).collect() == []


def test_random_access_to_blocks(spark, encoder):
    path = f"{shared_folder(spark)}/access-{uuid.uuid4().hex}"
    docs = spark.createDataFrame([(i, f"text number {i} of some") for i in range(200)], "doc_id long, text string")
    write_packed(docs, path, block_ids=100)
    blocks = [r.asDict() for r in spark.read.parquet(path).collect()]
    assert len(blocks) > 10 and all(b["n_ids"] <= 100 for b in blocks)
    found = {d: ids_of(b, k).tolist() for b in blocks for k, d in enumerate(b["doc_ids"])}
    for i in (0, 57, 199):
        assert found[i] == [*library(encoder, [f"text number {i} of some"])[0], 0]


def test_the_order_of_packing_can_be_given(spark):
    """Ids follow the order columns; repeats of a document lie where these put them."""
    rows = [(5, "five", 2.0), (1, "one", 3.0), (5, "five", 0.5), (None, None, None), (2, "two", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at double")
    got = packed(docs, order=["at"]).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 5, 2, 5, 1]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(5)]
    assert [r.doc_id for r in packed(docs, order=["doc_id", "at"]).orderBy("start").collect()] == [None, 1, 2, 5, 5]
