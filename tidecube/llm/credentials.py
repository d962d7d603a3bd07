"""Secrets: fixed patterns, wider candidates, and who owns a value across the corpus.

A credential that works belongs to someone: its value stands in the repositories of one owner or
two. A value out of documentation stands everywhere. So every candidate's value is hashed, and
Spark counts the distinct owners and repositories that have it. The fixed patterns' spans are
always reported. Wider candidates (random-looking tokens, passwords in addresses, assignments to
other names) are added as spans of kind ``key`` where their value is owner-specific and looks
live; copied examples are left out, and counted.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import bounded, table, written

KINDS = ("assign", "access", "hex", "key")
KEY = 3
# A value of more owners is an example, and one of two owners in more repositories.
MOST_OWNERS = 2
MOST_REPOSITORIES = 20
# Bits a character that a random-looking value has at least.
ENTROPY = 3.0

# The three patterns. A run of hexadecimal digits counts as a whole, so one that is
# long enough is found where it begins; the same holds for what follows AKIA.
_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
LEAST_VALUE = 12
# Wider forms: a name, if there is one, and the value as the last group.
_WIDER = (
    re.compile(r"(?P<name>)(?<![A-Za-z0-9+/_=-])([A-Za-z0-9+/_=-]{20,})"),
    re.compile(r"(?P<name>)://[^\s/:@]+:([^\s/@:]{8,})@"),
    re.compile(r"""\b(?P<name>[A-Za-z_]++)["']?\x20*[:=]\x20*(?:"([^"\s]{12,})"|'([^'\s]{12,})')"""),
)
_NAMES = ("key", "pwd", "auth", "cred")
# What placeholders are made of.
_PLACEHOLDER = re.compile(
    r"(?ai:example|sample|dummy|placeholder|changeme|change_me|redacted|your|xxxx|0000|1234567|abcdefg|\*\*\*)"
)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the fixed patterns' matches, sorted."""
    out = [
        (m.start(), 0, m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE
    ]
    out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


def looks_live(value: str) -> bool:
    """Whether a value is random enough for a credential and no placeholder.

    A token without quotes around it must hold letters and digits, which words do not.
    """
    if _PLACEHOLDER.search(value):
        return False
    n = len(value)
    bits = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    digits = sum(c.isdigit() for c in value)
    return bits >= ENTROPY and 10 * digits >= n and digits < n


def wider_spans(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, value) of live-looking candidates outside the sorted spans ``taken``.

    They do not overlap; of those that would, the first one counts, and the longer if they begin
    together.
    """
    found = []
    for form in _WIDER:
        for m in form.finditer(text):
            group, name = m.lastindex, m["name"].lower()
            if looks_live(m[group]) and (not name or any(x in name for x in _NAMES)):
                found.append((m.start(group), -m.end(group), m[group]))
    out: list[tuple[int, int, str]] = []
    k = last = 0
    for begin, end, value in sorted(found):
        while k < len(taken) and taken[k][1] <= begin:
            k += 1
        if begin >= last and not (k < len(taken) and taken[k][0] < -end):
            out.append((begin, -end, value))
            last = -end
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint sorted stretches that cover sorted spans."""
    out: list[tuple[int, int]] = []
    for begin, end in spans:
        if out and begin < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


_SPAN = "struct<start: int, kind: int, end: int, value: binary, live: boolean>"
CANDIDATES = f"row_id long, doc_id long, owner string, repository string, found array<{_SPAN}>"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()),
                      ("value", pa.binary()), ("live", pa.bool_())])
    for batch in batches:
        found = []
        for item in batch.column(4):
            text = item.as_py() or ""
            spans = base_spans(text)
            wider = wider_spans(text, merged([(a, b) for a, _, b, _ in spans]))
            spans = [(a, k, b, v, looks_live(v)) for a, k, b, v in spans]
            spans += [(a, KEY, b, v, True) for a, b, v in wider]
            found.append([
                {"start": a, "kind": k, "end": b, "live": live,
                 "value": hashlib.sha256(v.encode("utf-8", "surrogatepass")).digest()[:16]}
                for a, k, b, v, live in sorted(spans)
            ])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(4)), pa.array(found, pa.list_(span))],
            ["row_id", "doc_id", "owner", "repository", "found"],
        )


def candidates(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """A written table: every row of ``docs`` with its candidate spans in order."""
    rows = bounded(docs).select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"),
        "text",
    )
    return written(rows.mapInArrow(_scanned, CANDIDATES), "candidates")


def placed(scanned: DataFrame) -> DataFrame:
    """A row per candidate span."""
    return scanned.filter(F.size("found") > 0).select(
        "row_id", "doc_id", "owner", "repository", F.inline("found")
    )


def ownership(spans: DataFrame) -> DataFrame:
    """Rows (value, owners, repositories): how many distinct ones of each hold a value.

    Null is one owner, and one repository. Pairs are made distinct before they are counted, so a
    value that stands in a third of all documents is summed up where they are read.
    """
    def distinct(by: str, name: str) -> DataFrame:
        return spans.groupBy("value", by).agg(F.lit(1).alias("_one")).groupBy("value").agg(
            F.count(F.lit(1)).alias(name)
        )

    return distinct("owner", "owners").join(distinct("repository", "repositories"), "value")


def judged(scanned: DataFrame) -> DataFrame:
    """Every candidate span with its value's owners and repositories.

    ``example`` marks widely copied values, ``live`` owner-specific ones that look live.
    """
    spans = placed(scanned)
    example = (F.col("owners") > MOST_OWNERS) | (
        (F.col("owners") > 1) & (F.col("repositories") > MOST_REPOSITORIES)
    )
    return spans.join(ownership(spans), "value").select(
        "row_id", "doc_id", "owner", "repository", "start", "kind", "end", "value", "owners", "repositories",
        example.alias("example"), (F.col("live") & ~example).alias("live"),
    )


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: counts and digest of the fixed patterns' spans, and all spans.

    Columns are doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_key (spans added), n_live
    and n_example (of all candidates, those of owner-specific live-looking values and those of
    copied ones). An added span overlaps none of the fixed patterns' spans. A null or empty text
    has no spans, and the digest of an empty list. Rows that repeat are reported each, and count
    as one owner and one repository. Other columns are not read; an empty table gives no rows.
    """
    scanned = candidates(docs, owner, repository)
    verdicts = judged(scanned).filter(F.col("live") | F.col("example")).groupBy("row_id").agg(
        F.count_if("live").alias("n_live"), F.count_if("example").alias("n_example"),
        F.collect_list(F.when((F.col("kind") == KEY) & F.col("live"), F.struct("start", "kind", "end"))).alias("added"),
    )  # spans of one text
    every = scanned.select(
        "row_id", "doc_id",
        F.transform(
            F.filter("found", lambda s: s["kind"] != KEY),
            lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
        ).alias("base"),
    ).join(verdicts, "row_id", "left")
    none = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    added = F.coalesce("added", none)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return every.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:KEY])],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", added))).alias("spans"),
        F.size(added).cast("long").alias("n_key"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )


def op11_owned_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of ``documents``, whose sources are the owners and which are repositories."""
    return secrets(table(spark, sf_dir, "documents"))
