"""Personal data: fixed patterns, and bootstrapped contextual extraction on top of them.

What the fixed patterns find are seed entities. The words around an entity are a lexical pattern:
the two before it, the one before and the one after, or the two after. Patterns and the
identifiers that occur in them form a graph. Spark scores it in rounds: a pattern is as good as
the share of its distinct identifiers that are trusted to be of one kind, and an unseen
identifier is as good as the patterns that support it make it. Patterns that end with a high
confidence, drawn from enough distinct seeds, discover the unseen identifiers they surround and
that have their kind's loose form, such as a telephone number without a country code. Those found
with a high belief are seeds of that belief for new patterns, and so on until none is found.
Identifiers in good patterns are the spans that are added. Loose forms run
over single blanks between groups of digits, and between a name, "at" and a host.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import bounded, table, written
from .words import mix

KINDS = ("email", "ip", "card", "phone")
CONFIDENCE = 0.9
SUPPORT = 5
FOUND_SHARE = 0.5
SMOOTHING = 0.25
ROUNDS = 3

# The patterns of the four kinds, anchored where a match can begin at all.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARKED = re.compile(r"[0-9@]")
# Loose forms, for identifiers in a pattern's place.
_LOOSE = (
    re.compile(r"[^\s@]+(?:@|\(at\)|\[at\])[^\s@]+"),
    re.compile(r"[0-9]{1,3}(?:[.,:_-][0-9]{1,3}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}"),
    re.compile(r"[0-9](?:[./_-]?[0-9]){11,18}"),
    re.compile(r"\(?[0-9](?:[()./_-]{0,2}[0-9]){6,14}"),
)
_SPACED = (
    (2, re.compile(r"[0-9](?:(?:[./_-]|\x20(?:[./-]\x20)?)?[0-9]){11,18}")),
    (3, re.compile(r"\(?[0-9](?:(?:[()./_-]{1,2}|[()]?\x20(?:[./-]\x20)?[()]?)?[0-9]){6,14}\)?")),
)
_GROUP = r"\(?[0-9](?:[()./_-]{0,2}[0-9])*\)?"
_RUN = re.compile(rf"{_GROUP}(?:\x20(?:[./-]\x20)?{_GROUP})+")
_PART = re.compile(_GROUP)
_AT = re.compile(
    r"\x20(?:at|\(at\)|\[at\])\x20[a-z0-9-]+(?:(?:\.|\x20(?:dot|\(dot\)|\[dot\])\x20)[a-z0-9-]+)+", re.I
)
MOST_DIGITS = 19
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_EDGES = "\"'.,;:!?<>|*#$%&=[]{}"
_WORD = re.compile(r"\w+")
REACH = 120


def luhn(digits: str) -> bool:
    """Whether the digits' check sum is right: every second one from the right counts twice."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns' matches, sorted.

    Matches are leftmost and do not overlap within a kind. A local part that begins at the start
    of its run of characters, or where the last match ended, is the leftmost one, so every @ is
    looked at once; the other patterns begin at a digit that follows none, or at a plus sign.
    """
    out: list[tuple[int, int, int]] = []
    at, done = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(x) < 20 and int(x) <= 255 for x in (p.lstrip("0") or "0" for p in m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _hashed(text: str) -> int:
    """A 64-bit hash that does not depend on the process."""
    import zlib

    data = text.encode("utf-8", "surrogatepass")
    pair = np.array([zlib.crc32(data) | zlib.crc32(b"\x01" + data[::-1]) << 32], dtype=np.uint64)
    return int(mix(pair).view(np.int64)[0])


def _contexts(text: str, begin: int, end: int) -> list[int]:
    """Hashes of the lexical patterns around a span; numbers in words count as zeros."""
    before = [re.sub(r"\d", "0", x) for x in _WORD.findall(text[max(0, begin - REACH) : begin].lower())[-2:]]
    after = [re.sub(r"\d", "0", x) for x in _WORD.findall(text[end : end + REACH].lower())[:2]]
    out = []
    if len(before) == 2:
        out.append(_hashed("b " + " ".join(before)))
    if before and after:
        out.append(_hashed(f"m {before[-1]} {after[0]}"))
    if len(after) == 2:
        out.append(_hashed("a " + " ".join(after)))
    return out


def _alone(text: str, begin: int, end: int) -> bool:
    """Whether only marks stand between a span and the white space around it."""
    while begin > 0 and text[begin - 1] in _EDGES + "(":
        begin -= 1
    while end < len(text) and text[end] in _EDGES + ")":
        end += 1
    return (begin == 0 or text[begin - 1].isspace()) and (end == len(text) or text[end].isspace())


def _in_run(text: str, begin: int, end: int) -> list[tuple[int, int, list[int]]]:
    """The spans of loose form over blanks in a run of digit groups, longest first, disjoint."""
    groups = [m.span() for m in _PART.finditer(text, begin, end)]
    digits = [sum(c.isdigit() for c in text[a:b]) for a, b in groups]
    whole = []
    for i, (a, _) in enumerate(groups):
        n = digits[i]
        for j in range(i + 1, len(groups)):
            n += digits[j]
            if n > MOST_DIGITS:
                break
            x, y = a, groups[j][1]
            more = text.count("(", x, y) - text.count(")", x, y)
            x += more > 0 and text[x] == "("  # a bracket around more than this
            y -= more < 0 and text[y - 1] == ")"
            kinds = [k for k, form in _SPACED if form.fullmatch(text, x, y)]
            if kinds and _alone(text, x, y):
                whole.append((x - y, x, y, i, j, kinds))
    out, used = [], bytearray(len(groups))
    for _, x, y, i, j, kinds in sorted(whole):
        if not any(used[i : j + 1]):
            used[i : j + 1] = b"\x01" * (j + 1 - i)
            out.append((x, y, kinds))
    return out


def _spaced(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, list[int]]]:
    """(start, end, kinds) of identifiers over single blanks, outside the sorted spans ``taken``.

    They are sorted and do not overlap.
    """
    out = []
    # Base spans part the text, so that no run goes over one.
    at = 0
    for begin, end in [*taken, (len(text), len(text))]:
        for m in _RUN.finditer(text, at, max(at, begin)):
            out += _in_run(text, *m.span())
        at = max(at, end)
    done = 0
    for m in _AT.finditer(text):
        begin = m.start()
        while begin > done and not text[begin - 1].isspace() and text[begin - 1] not in "@<>\"'()[]{},;:":
            begin -= 1
        if begin < m.start():
            out.append((begin, m.end(), [0]))
            done = m.end()
    out.sort()
    free, last, k = [], 0, 0
    for begin, end, kinds in out:
        while k < len(taken) and taken[k][1] <= begin:
            k += 1
        if begin >= last and not (k < len(taken) and taken[k][0] < end):
            free.append((begin, end, kinds))
            last = end
    return free


def _unseen(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, kinds whose loose form it has) of identifiers outside all base spans.

    Within one that runs over blanks, only tokens that have a loose form themselves are listed.
    """
    taken = sorted((a, b) for a, _, b in taken)
    wide = _spaced(text, taken)
    yield from wide
    k = w = 0
    for m in _TOKEN.finditer(text):
        begin, end = m.span()
        while begin < end and text[begin] in _EDGES:
            begin += 1
        while end > begin and text[end - 1] in _EDGES:
            end -= 1
        while k < len(taken) and taken[k][1] <= begin:
            k += 1
        if begin == end or k < len(taken) and taken[k][0] < end:
            continue
        while w < len(wide) and wide[w][1] <= begin:
            w += 1
        kinds = [j for j, form in enumerate(_LOOSE) if form.fullmatch(text, begin, end)]
        if kinds or not (w < len(wide) and wide[w][0] < end):
            yield begin, end, kinds


ENTITIES = (
    "row_id long, doc_id long, spans array<struct<start: int, kind: int, end: int>>, "
    "found array<struct<start: int, end: int, kind: int, seed: boolean, value: long, "
    "patterns: array<long>>>"
)
OTHER = len(KINDS)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    entity = pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("seed", pa.bool_()),
         ("value", pa.int64()), ("patterns", pa.list_(pa.int64()))]
    )
    for batch in batches:
        spans, found = [], []
        for value in batch.column(2):
            text = value.as_py() or ""
            own, entities = [], []
            if _MARKED.search(text) or _AT.search(text):
                own = base_spans(text)
                for a, kind, b in own:
                    entities.append((a, b, kind, True))
                for a, b, kinds in _unseen(text, own):
                    entities += [(a, b, kind, False) for kind in kinds or [OTHER]]
            spans.append([{"start": a, "kind": kind, "end": b} for a, kind, b in own])
            found.append(
                [
                    {"start": a, "end": b, "kind": kind, "seed": seed,
                     "value": _hashed(text[a:b].lower()), "patterns": _contexts(text, a, b)}
                    for a, b, kind, seed in entities
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(spans, pa.list_(span)),
             pa.array(found, pa.list_(entity))],
            ["row_id", "doc_id", "spans", "found"],
        )


def good_patterns(edges: DataFrame) -> DataFrame:
    """Rows (pattern, kind) of high confidence, from rows (pattern, kind, value, seed).

    Edges are distinct pairs of a pattern and an identifier, with whether it is a seed of the
    kind. Patterns are scored over and over: what good patterns discover counts for others the next
    time, with the belief it has, and never for less. Each time before the last discovers another
    identifier, so it ends with the longest chain of discoveries; only a count reaches the driver.
    """
    sizes = written(edges.groupBy("pattern").agg(F.count_distinct("value").alias("n")), "sizes")
    edges = written(
        edges.select("pattern", "kind", "value", "seed", F.col("seed").cast("double").alias("base")), "edges"
    )
    known = 0
    while True:
        beliefs = written(_beliefs(edges, sizes), "beliefs")
        good = written(
            _confidence(beliefs).filter(F.col("confidence") >= CONFIDENCE).select("pattern", "kind"), "good"
        )
        found = (
            beliefs.filter(~F.col("seed") & (F.col("belief") >= CONFIDENCE)).join(good, ["pattern", "kind"])
            .groupBy("value", "kind").agg(F.max("belief").alias("_found"))
        )
        edges = written(
            edges.join(found, ["value", "kind"], "left")
            .withColumn("base", F.greatest("base", F.coalesce("_found", F.lit(0.0)))).drop("_found"),
            "edges",
        )
        counted = edges.filter(~F.col("seed") & (F.col("base") >= CONFIDENCE)).count()
        if counted == known:
            return good
        known = counted


def _beliefs(edges: DataFrame, sizes: DataFrame) -> DataFrame:
    """Beliefs in the identifiers of candidate patterns: pattern, kind, n, value, seed, base, belief.

    In each round a pattern's confidence in a kind is the sum of its identifiers' belief in it over
    the number of all its identifiers and a smoothing share; an unseen identifier's belief is the
    chance that one of its patterns is right, or ``base`` if that is more. Only patterns of enough
    distinct identifiers that are trusted from the start are candidates, which leaves the graph small;
    discovered ones count ``FOUND_SHARE`` of a seed there.
    """
    candidates = (
        edges.filter(F.col("kind") < OTHER).groupBy("pattern", "kind")
        .agg(
            (F.count_if("seed") + FOUND_SHARE * F.count_if(~F.col("seed") & (F.col("base") >= CONFIDENCE)))
            .alias("trusted")
        )
        .filter(F.col("trusted") >= SUPPORT).select("pattern", "kind")
    )
    graph = written(edges.join(candidates, ["pattern", "kind"]).join(sizes, "pattern"), "patterns")
    beliefs = graph.withColumn("belief", F.col("base"))
    for _ in range(ROUNDS):
        scored = graph.join(_confidence(beliefs), ["pattern", "kind"])
        doubt = F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))
        values = scored.groupBy("value", "kind").agg((1 - F.exp(F.sum(doubt))).alias("_belief"))
        beliefs = written(
            graph.join(values, ["value", "kind"])
            .withColumn("belief", F.greatest("base", "_belief")).drop("_belief"),
            "beliefs",
        )
    return beliefs


def _confidence(beliefs: DataFrame) -> DataFrame:
    return beliefs.groupBy("pattern", "kind").agg(
        (F.sum("belief") / (F.max("n") + SMOOTHING)).alias("confidence")
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


def personal_data(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one per row of ``docs``.

    Counts and digest are of the fixed patterns' spans; ``spans`` also lists those that patterns
    of context have added, which overlap none of the fixed ones. A null or empty text has none,
    and the digest of an empty list. Spans of different kinds may overlap. Rows that repeat are
    treated alike. Columns other than doc_id and text are not read; an empty table gives no rows.
    """
    rows = bounded(docs).select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    extracted = written(rows.mapInArrow(_extracted, ENTITIES), "entities")
    found = extracted.filter(F.size("found") > 0).select("row_id", F.explode("found").alias("x"))
    placed = found.select(
        "row_id", "x.start", "x.end", "x.kind", "x.seed", "x.value",
        F.explode("x.patterns").alias("pattern"),
    )
    edges = placed.groupBy("pattern", "kind", "value").agg(F.max("seed").alias("seed"))
    patterns = good_patterns(edges)
    added = (
        placed.filter(~F.col("seed") & (F.col("kind") < OTHER)).join(patterns, ["pattern", "kind"])
        .groupBy("row_id")
        .agg(F.collect_set(F.struct("start", "kind", "end")).alias("added"))  # those of one text
    )
    # Of a span over blanks and one inside it, of one kind, the longer one stays.
    longest = F.filter(
        "added",
        lambda x: ~F.exists(
            "added",
            lambda y: (y["kind"] == x["kind"]) & (y["start"] <= x["start"]) & (y["end"] >= x["end"])
            & (y["end"] - y["start"] > x["end"] - x["start"]),
        ),
    )
    every = extracted.select("row_id", "doc_id", "spans").join(
        added.select("row_id", longest.alias("added")), "row_id", "left"
    )
    no_spans = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    whole = F.array_sort(F.concat("spans", F.coalesce("added", no_spans)))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return every.select(
        "doc_id", *counts, F.sha2(_listed(F.col("spans")), 256).alias("base_sha256"),
        _listed(whole).alias("spans"),
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of ``documents``: counts, a digest of the base spans, and all spans."""
    return personal_data(table(spark, sf_dir, "documents"))
