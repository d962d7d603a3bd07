from __future__ import annotations

import hashlib
import random
import re

from conftest import SF
from edge_rows import edge_documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tidecube.llm.personal import (
    KINDS,
    _unseen,
    base_spans,
    good_patterns,
    luhn,
    op9_personal_data,
    personal_data,
)

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def passes_luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    """The spans by the patterns as they are given."""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and passes_luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return sorted(out)


PIECES = st.sampled_from(
    ["a", "b@", "@", ".", "..", "c.de", "1", "25", "256.", "255.1.2.3", "+", "+1 (23) 456-7890", "-", " ",
     "4111 1111 1111 1111", "4111-1111", "11111", "é", "_%", "\n"]
)


@given(st.lists(PIECES, max_size=14).map("".join))
@settings(max_examples=1000, deadline=None)
def test_base_spans_equal_the_patterns(text):
    assert base_spans(text) == plain(text)


@given(st.integers(0, 10**19))
def test_luhn(number):
    assert luhn(str(number)) == passes_luhn(str(number))


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "a@" * 100_000, "1." * 100_000, "+1 (" * 50_000):
        base_spans(text)


def listed(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_query_against_the_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_personal_data(spark, SF).collect()
    assert {r.doc_id for r in rows} == texts.keys()
    for r in rows:
        own = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(own).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[1] == i for x in own) for i in range(4)]
        assert set(filter(None, listed(own).split(","))) <= set(filter(None, r.spans.split(",")))


def test_contexts_discover_what_the_patterns_miss(spark):
    r = random.Random(1)
    docs = []
    for k in range(60):
        number = f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}"
        docs.append((k, f"noise{k} words please call me at {number} before noon today {k}x"))
    docs.append((100, "other words please call me at 555-867-5309 before noon"))
    docs.append((101, "the total of it was 555-867-5309 pieces in the end"))
    docs += [(200 + k, f"section {k} of it was 12{k} pieces") for k in range(30)]
    rows = {x.doc_id: x for x in personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    begin = docs[60][1].index("555")
    assert rows[100].spans == f"phone:{begin}:{begin + 12}" and rows[100].n_phone == 0
    assert rows[101].spans == ""
    assert all(rows[k].n_phone == 1 and "," not in rows[k].spans for k in range(60))
    assert all(rows[200 + k].spans == "" for k in range(30))


def test_contexts_discover_numbers_over_blanks(spark):
    r = random.Random(3)
    docs, want = [], {}

    def put(begin, found, end, kind):
        want[len(docs)] = f"{kind}:{len(begin)}:{len(begin) + len(found)}"
        docs.append((len(docs), begin + found + end))

    def card():
        digits = "4" + "".join(r.choice("0123456789") for _ in range(14))
        last = next(c for c in "0123456789" if luhn(digits + c))
        return " ".join((digits + last)[i : i + 4] for i in range(0, 16, 4))

    phones = ("555 867 5309", "(020) 7946 0958", "(555) 867-5309", "06 12 34 56 78", "555 - 867 - 5309")
    for k in range(60):
        put(f"noise{k} words please call me at ", f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}",
            f" before noon today {k}x", "phone")
        put(f"noise{k} words it goes to card number ", card(), f" valid from now {k}x", "card")
        put(f"noise{k} words and write to ", f"name{k}@host{k}.org", " with all questions", "email")
    for number in phones:
        put("other words please call me at ", number, " before noon", "phone")
        put("other words (please call me at ", number, ") before noon", "phone")
    put("other words it goes to card number ", "4111 1111 1111 1112", ", valid from now", "card")
    put("other words and write to ", "jane.doe at example.org", " with all questions", "email")
    put("other words and write to ", "jane (at) example dot org", " with all questions", "email")
    seen = len(docs)
    docs += [(seen + k, f"the total of it was {x} pieces in the end") for k, x in enumerate(phones)]
    docs.append((seen + 50, "they all met at example.org in the end"))
    docs.append((seen + 51, "please call me at 12 34 before noon"))
    rows = personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {x.doc_id: x.spans for x in rows if x.spans}
    assert got == want
    assert all(x.n_phone + x.n_card + x.n_email == (x.doc_id < 180) for x in rows)


def test_spans_over_blanks_keep_to_forms():
    def found(text):
        return [(text[a:b], kinds) for a, b, kinds in _unseen(text, base_spans(text))]

    assert found("x (020) 7946 0958.") == [("(020) 7946 0958", [3])]
    assert found("x (555) 867-5309, y") == [("(555) 867-5309", [3]), ("867-5309", [3])]
    assert found("555  867 5309 1")[0] != ("555  867 5309 1", [3])
    assert found("v555 867 530 x") == [("v555", []), ("867", []), ("530", [])]
    assert found("1 2 3") == [("1", []), ("2", []), ("3", [])]
    assert found("+1 (234) 555-1234 555 867 5309") != []
    text = "1 2 " * 50_000
    assert len(list(_unseen(text, []))) > 1000


def hops(contexts, per_hop, r):
    """Documents in which each context shares unseen numbers with the next, the first with seeds."""
    number = lambda: f"{r.randrange(200, 999)}-555-{r.randrange(1000, 9999)}"
    shared = [[number() for _ in range(per_hop)] for _ in contexts]
    texts = [f"noise{k} words {contexts[0][0]} +1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)} "
             f"{contexts[0][1]} {k}x" for k in range(60)]
    for i, (before, after) in enumerate(contexts):
        for x in shared[i] + (shared[i - 1] if i else []):
            texts.append(f"some {before} {x} {after} end")
    alone = number()
    texts.append(f"some {contexts[-1][0]} {alone} {contexts[-1][1]} end")
    return list(enumerate(texts)), shared, alone


def test_what_is_discovered_makes_new_patterns(spark):
    """Numbers that one context discovers teach a second one, and that discovers another number."""
    r = random.Random(5)
    docs, shared, alone = hops([("please call me at", "before noon today")], 30, r)
    docs += [(1000 + k, f"some her desk line {x} rings all day") for k, x in enumerate([*shared[0], alone[:-4] + "0001"])]
    docs += [(2000 + k, f"the order count was {k + 200}-555-{1000 + k} pieces overall") for k in range(30)]
    rows = {x.doc_id: x for x in personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all("phone:" in rows[k].spans for k in range(60, 91))
    assert all("phone:" in rows[1000 + k].spans and rows[1000 + k].n_phone == 0 for k in range(31))
    assert all(rows[2000 + k].spans == "" for k in range(30))


def brute_patterns(edges):
    """Good patterns by dictionaries, from {(pattern, kind, value): seed}."""
    base = {e: float(seed) for e, seed in edges.items()}
    of_pattern = {}
    for p, _, v in edges:
        of_pattern.setdefault(p, set()).add(v)
    known = set()
    while True:
        own = {}
        for (p, k, v), b in base.items():
            own.setdefault((p, k), {})[v] = b
        own = {c: vs for c, vs in own.items()
               if c[1] < len(KINDS)
               and sum(1 if edges[(*c, v)] else 0.5 * (b >= 0.9) for v, b in vs.items()) >= 5}
        belief = {c: dict(vs) for c, vs in own.items()}
        for _ in range(3):
            sure = {c: sum(vs.values()) / (len(of_pattern[c[0]]) + 0.25) for c, vs in belief.items()}
            doubt = {}
            for (p, k), vs in own.items():
                for v in vs:
                    doubt[v, k] = doubt.get((v, k), 1.0) * (1 - min(sure[p, k], 0.999))
            belief = {c: {v: max(b, 1 - doubt[v, c[1]]) for v, b in vs.items()} for c, vs in own.items()}
        sure = {c: sum(vs.values()) / (len(of_pattern[c[0]]) + 0.25) for c, vs in belief.items()}
        good = {c for c, x in sure.items() if x >= 0.9}
        found = {(v, c[1]): b for c in good for v, b in belief[c].items()
                 if b >= 0.9 and not edges[c[0], c[1], v]}
        for (p, k, v), seed in edges.items():
            if not seed and (v, k) in found:
                base[p, k, v] = max(base[p, k, v], found[v, k])
        now = {e for e, b in base.items() if b >= 0.9 and not edges[e]}
        if now == known:
            return good
        known = now


def test_patterns_equal_brute_force(spark):
    """On random graphs, in which some patterns are reached over one or more discoveries."""
    sizes, later = [], 0
    for seed in range(4):
        r = random.Random(seed)
        edges = {}
        for p in range(24):
            kind, near = p % 4, p // 4
            for _ in range(r.randrange(20, 120)):
                v = 200 * kind + r.randrange(9 * near, 9 * near + 36)
                k = kind if r.random() < 0.99 else r.randrange(5)
                edges[p, k, v] = k < 4 and v % 200 < 36 and v % 9 != 1
        rows = [(*e, s) for e, s in edges.items()]
        df = spark.createDataFrame(rows, "pattern long, kind int, value long, seed boolean")
        got = {(x.pattern, x.kind) for x in good_patterns(df).collect()}
        assert got == brute_patterns(edges)
        sizes.append(len(got))
        seeded = {(p, k) for p, k in got
                  if sum(s for (a, b, _), s in edges.items() if (a, b) == (p, k)) < 5}
        later += len(seeded)
    assert all(sizes) and later > 0


def test_edges(spark):
    nothing = hashlib.sha256(b"").hexdigest()
    rows = personal_data(edge_documents(spark)).collect()
    assert len(rows) == 10
    assert {tuple(x)[1:] for x in rows} == {(0, 0, 0, 0, nothing, "")}
    assert personal_data(no_documents(spark)).collect() == []
