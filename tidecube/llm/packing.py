"""Token ids as fixed-width bits, in a table of blocks.

Every id takes the fewest bits that hold the vocabulary. A block is one row: consecutive whole
documents, about ``block_ids`` ids, at least one document. It holds the packed bits, padded to a
byte, and where each document begins, so a reader unpacks any document of any block with numpy
and without touching the others. A file is what one task wrote of the global doc_id order; files
are numbered in that order, and the blocks of one file too.

Files are written by Spark into a Parquet container, because that reaches every store a cluster
has and its commit survives lost executors. Packed bits do not compress, so pages stay raw.
"""

from __future__ import annotations

import os
import re
import sys
import types
import uuid
import zlib
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain, compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import bounded, shared_folder, table

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
BLOCK_IDS = 1 << 16
CACHED_CHUNKS = 500_000
TEXTS_AT_ONCE = 64
#: How byte-level vocabularies show a space.
_SPACE = "\u0120"
#: Letters that all Unicode versions know as such, up to an ASCII character that is no letter, or
#: none; then the rest of the chunk.
_WORD_AND_TAIL = re.compile(
    r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]++(?=[\x00-@\[-`{-\x7f])|)([^ ]*) "
).findall
BLOCKS = (
    "file int, block long, bits int, first long, n_ids long, data binary, "
    "doc_ids array<long>, doc_first array<long>"
)
DOCS = "file int, doc_id long, first long, n_tokens long, ids_crc32 long"


def width(vocabulary: int) -> int:
    """The fewest bits that hold ids below ``vocabulary``, at least one."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Little-endian bit packing of ids below 2 to the power of ``bits``."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = []
    for at in range(0, len(ids), BLOCK_IDS):  # whole bytes, as BLOCK_IDS is a multiple of 8
        piece = ids[at : at + BLOCK_IDS]
        each = np.unpackbits(piece.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        out.append(np.packbits(each[:, :bits].reshape(-1), bitorder="little").tobytes())
    return b"".join(out)


def unpack(data: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from the ``first`` on; only the bytes that hold them are looked at."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count, first * bits // 8).astype("<u4")
    out = np.empty(count, dtype="<u4")
    for at in range(0, count, BLOCK_IDS):
        n = min(BLOCK_IDS, count - at)
        begin = (first + at) * bits
        raw = np.frombuffer(data, np.uint8)[begin // 8 : (begin + n * bits + 7) // 8]
        each = np.unpackbits(raw, bitorder="little")[begin % 8 : begin % 8 + n * bits]
        full = np.zeros((n, 32), dtype=np.uint8)
        full[:, :bits] = each.reshape(n, bits)
        out[at : at + n] = np.packbits(full, axis=1, bitorder="little").view("<u4")[:, 0]
    return out


class Encoder:
    """Ids of texts by the tokenizers library.

    The tokenizer splits a text into words before it merges, and always before a single space
    between characters other than white space. So a text is the sequence of its space-separated
    chunks, each is encoded once, and a dictionary has it afterwards. New words of letters go
    straight to the tokenizer's merges, as there is nothing to split. Other new chunks are encoded
    together as one text, which comes apart again at the tokens that begin with a space, as a
    chunk has none inside. Texts with spaces before other white space go through whole. The
    dictionary has two generations of a bounded size; what is used moves to the younger one.
    """

    def __init__(self, name: str, cached_chunks: int | None = None) -> None:
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self._tokenizer.encode_special_tokens = True
        self.cached_chunks = cached_chunks or CACHED_CHUNKS
        self.vocabulary = self._tokenizer.get_vocab_size(with_added_tokens=True)
        spaced = np.zeros(self.vocabulary, dtype=bool)
        for token, number in self._tokenizer.get_vocab(with_added_tokens=True).items():
            spaced[number] = token.startswith(_SPACE)
        self._spaced = spaced
        splitter = self._tokenizer.pre_tokenizer
        self._byte_level = self._tokenizer.normalizer is None and isinstance(splitter, ByteLevel)
        if self._byte_level:
            letters = filter(str.isalpha, map(chr, range(0xC0, 0x250)))
            self._shown = {ord(x): splitter.pre_tokenize_str(x)[-1][0][-2:] for x in letters}
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._tails: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    @classmethod
    def of_process(cls, name: str, cached_chunks: int) -> Encoder:
        """The encoder of this Python worker, which outlives the tasks that share the worker."""
        kept = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders"))
        if not hasattr(kept, name):
            setattr(kept, name, cls(name))
        encoder = getattr(kept, name)
        encoder.cached_chunks = cached_chunks
        return encoder

    def _word(self, word: str) -> bytes:
        """Ids of letters after a space, which a byte-level tokenizer only merges."""
        shown = word if word.isascii() else word.translate(self._shown)
        merged = self._tokenizer.model.tokenize(_SPACE + shown)
        return array("I", [t.id for t in merged]).tobytes()

    def _learn(self, chunks: list[str]) -> None:
        """Gets to know new chunks, from the older generation or by encoding them.

        A word with something behind it, such as a full stop, is the word and that: the
        tokenizer always splits where letters end.
        """
        if len(self._known) + len(chunks) > self.cached_chunks:
            self._older, self._known = self._known, {}
            self._tails.clear()
        known, tails = self._known, self._tails
        kept = list(map(self._older.get, chunks))
        known.update(compress(zip(chunks, kept, strict=True), kept))
        new = list(compress(chunks, map(not_, kept)))
        # One search over all of them, as no chunk has a space.
        parts = _WORD_AND_TAIL(" ".join([*new, ""])) if self._byte_level else [("", x) for x in new]
        ends = [x for x in dict.fromkeys(tail for head, tail in parts if head) if x not in tails]
        tails.update(zip(ends, self.whole(ends), strict=True))
        plain = []
        for x, (head, tail) in zip(new, parts, strict=True):
            if head:
                if (ids := known.get(head)) is None:
                    ids = known[head] = self._word(head)
                if tail:
                    known[x] = ids + tails[tail]
            elif x and not x[0].isspace() and not x[-1].isspace():
                plain.append(x)
        known.update(self._spaced_ids(plain))

    def _spaced_ids(self, chunks: list[str]) -> Iterator[tuple[str, bytes]]:
        """Chunks with their ids after a space, encoded many at once."""
        for at in range(0, len(chunks), 4096):
            part = chunks[at : at + 4096]
            ids = np.frombuffer(self.whole([" " + " ".join(part)])[0], dtype="<u4")
            begins = np.flatnonzero(self._spaced[ids])
            if len(begins) == len(part):
                data, places = ids.tobytes(), [*(4 * begins).tolist(), 4 * len(ids)]
                pieces = map(data.__getitem__, map(slice, places, places[1:]))
            else:
                pieces = self.whole([" " + x for x in part])
            yield from zip(part, pieces, strict=True)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [(x or "").split(" ") for x in texts]
        firsts = self.whole([parts[0] for parts in split])
        get = self._known.get
        found = [list(map(get, parts)) for parts in split]
        for rest in found:
            rest[0] = b""
        lacking = [(k, [i for i, y in enumerate(rest) if y is None]) for k, rest in enumerate(found)]
        missed = [list(map(split[k].__getitem__, places)) for k, places in lacking]
        self._learn(list(dict.fromkeys(chain.from_iterable(missed))))
        get = self._known.get
        odd = set()
        for (k, places), chunks in zip(lacking, missed, strict=True):
            learned = list(map(get, chunks))
            if None in learned:  # an empty chunk or one with white space at an end
                odd.add(k)
                continue
            rest = found[k]
            for i, ids in zip(places, learned, strict=True):
                rest[i] = ids
        out = []
        for k, (text, parts, first, rest) in enumerate(zip(texts, split, firsts, found, strict=True)):
            spaced = len(parts) > 1 and (not parts[0] or parts[0][-1].isspace())
            joined = self.whole([text])[0] if spaced or k in odd else first + b"".join(rest)
            out.append(np.frombuffer(joined, dtype="<u4"))
        return out


def _blocks_of(
    batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, block_ids: int, cached_chunks: int
) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    encode = Encoder.of_process(tokenizer, cached_chunks)
    bits, file = width(encode.vocabulary), TaskContext.get().partitionId()
    block, first, held, count = 0, 0, [], 0

    def finished() -> pa.RecordBatch:
        nonlocal block, first, held, count
        ids = np.concatenate([x for _, x in held])
        starts = np.cumsum([0, *(len(x) for _, x in held[:-1])])
        row = [file, block, bits, first, len(ids), pack(ids, bits), [d for d, _ in held], starts]
        block, first, held, count = block + 1, first + len(ids), [], 0
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(),
                 pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["file", "block", "bits", "first", "n_ids", "data", "doc_ids", "doc_first"]
        return pa.RecordBatch.from_arrays(
            [pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)], names
        )

    for batch in batches:
        doc_ids, texts = batch.column(0), batch.column(1)
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            encoded = encode(texts.slice(at, TEXTS_AT_ONCE).to_pylist())
            for doc_id, ids in zip(doc_ids.slice(at, TEXTS_AT_ONCE).to_pylist(), encoded, strict=True):
                if held and count + len(ids) + 1 > block_ids:
                    yield finished()
                held.append((doc_id, np.append(ids, np.uint32(end_id))))
                count += len(ids) + 1
    if held:
        yield finished()


def write_packed(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    order: Sequence[str] = ("doc_id",),
    cached_chunks: int = CACHED_CHUNKS,
) -> None:
    """Encodes (doc_id, text) in ascending ``order`` and writes the table of blocks to ``path``.

    Null texts are empty, and an empty text is the end id alone. Nulls come first in the order, rows
    that share it follow each other by doc_id and text, and no documents make an empty table. Columns
    other than doc_id, text and those of the order are not read. A Python worker keeps the ids of up
    to twice ``cached_chunks`` chunks, some 200 bytes each.
    """
    # Under names of their own, so that an order column may be called like one of the two.
    keys = [f"_order_{i}" for i in range(len(order))]
    placed = bounded(docs).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)],
    )
    ordered = (
        placed.repartitionByRange(*keys).sortWithinPartitions(*keys, "doc_id", "text")
        .select("doc_id", "text")
    )
    blocks = ordered.mapInArrow(
        lambda it: _blocks_of(it, tokenizer, end_id, block_ids, cached_chunks), BLOCKS
    )
    blocks.write.option("compression", "none").parquet(path)


def _docs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            places = [*row["doc_first"], row["n_ids"]]
            for doc_id, begin, end in zip(row["doc_ids"], places, places[1:], strict=False):
                ids = unpack(row["data"], row["bits"], begin, end - begin)
                rows.append(
                    (row["file"], doc_id, row["first"] + begin, end - begin, zlib.crc32(ids))
                )
        kinds = [pa.int32(), *[pa.int64()] * 4]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)],
            ["file", "doc_id", "first", "n_tokens", "ids_crc32"],
        )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Reads the blocks back: doc_id, start, n_tokens and ids_crc32 of every document.

    ``start`` continues over the files; their lengths are summed first, a row for each file.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        blocks.groupBy("file").agg(F.sum("n_ids").alias("_ids"))
        .select("file", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_base"))
    )
    found = blocks.select(
        "file", "bits", "first", "n_ids", "data", "doc_ids", "doc_first"
    ).mapInArrow(_docs_of, DOCS)
    return found.join(bases, "file").select(
        "doc_id", (F.col("first") + F.col("_base")).alias("start"), "n_tokens", "ids_crc32"
    )


def ids_of(block: dict, place: int) -> np.ndarray:
    """Random access: the ids of the ``place``-th document of a block row."""
    starts = [*block["doc_first"], block["n_ids"]]
    return unpack(block["data"], block["bits"], starts[place], starts[place + 1] - starts[place])


def packed(
    docs: DataFrame, order: Sequence[str] = ("doc_id",), cached_chunks: int = CACHED_CHUNKS
) -> DataFrame:
    """Writes the documents to a new place in the shared folder and reads the digests back."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/packed-{uuid.uuid4().hex}"
    write_packed(docs, path, order=order, cached_chunks=cached_chunks)
    return read_digests(spark, path)


def op7_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of ``documents``: doc_id, start, n_tokens, ids_crc32."""
    return packed(table(spark, sf_dir, "documents"))
