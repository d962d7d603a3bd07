from __future__ import annotations

import random
import re

from edge_rows import LONG, edge_documents, no_documents
from pyspark.sql import functions as F

from tidecube.llm import fuzzy_lines
from tidecube.llm.fuzzy_lines import SHINGLE, deduplicated_lines, line_classes, linked_lines


def brute_force(docs, threshold=0.8):
    """Dropped line numbers of every document, comparing all pairs of lines."""
    places, nodes = [], {}
    for i, text in docs:
        for k, line in enumerate(text.split("\n")):
            if key := line.strip(" \t\r").lower():
                places.append((i, k, key))
                nodes.setdefault(key, len(nodes))
    sets = {n: {k[i : i + SHINGLE] for i in range(len(k) - SHINGLE + 1)} for k, n in nodes.items()}
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in sets.items():
        for b in range(a):
            if s and sets[b] and len(s & sets[b]) >= threshold * len(s | sets[b]):
                root[find(a)] = find(b)
    out, seen = {i: [] for i, _ in docs}, set()
    for i, k, key in sorted(places):
        if (c := find(nodes[key])) in seen:
            out[i].append(k)
        seen.add(c)
    return out


def lines(seed, n):
    r = random.Random(seed)
    return [" ".join(f"{r.choice('bcdfg')}{r.randrange(10**4)}" for _ in range(20)) for _ in range(n)]


def fixture():
    r = random.Random(2)
    base = lines(1, 12)
    docs = []
    for i in range(60):
        own = lines(100 + i, 3)
        for _ in range(3):
            line = r.choice(base)
            if r.random() < 0.7:
                words = line.split()
                words[r.randrange(20)] = f"z{r.randrange(100)}"
                line = " ".join(words)
            own.insert(r.randrange(3), line.upper() if r.random() < 0.2 else line)
        docs.append((i, "\n".join([*own, "", "Short.", "  "])))
    return docs


def test_equals_brute_force(spark):
    docs = fixture()
    want = brute_force(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.dropped for r in line_classes(df).collect()}
    # Bands find a pair with a chance of 98 % at the threshold and more above it.
    differing = sum(got[i] != want[i] for i in want)
    assert got.keys() == want.keys() and differing <= 1
    assert sum(map(len, want.values())) > 100
    cleaned = {r.doc_id: r.text for r in deduplicated_lines(df).collect()}
    for i, text in docs:
        kept = [x for k, x in enumerate(text.split("\n")) if k not in got[i]]
        assert cleaned[i] == "\n".join(kept)


def test_one_changed_character_in_an_ordinary_line(spark):
    """A line of 64 characters with one replaced, one lost or one added is a copy; short lines stay."""
    line = "the quick brown fox jumps over a lazy dog near seven wet bridges"
    copies = [line, line[:30] + "#" + line[31:], line[:20] + line[21:], line[:40] + "#" + line[40:]]
    docs = [*enumerate(copies), (10, "fin."), (11, "fin!"), (12, "Fin."), (13, "a brown dog"), (14, "a brawn dig")]
    rows = line_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows if r.dropped} == {1, 2, 3, 12}
    assert {i for i, d in brute_force(docs).items() if d} == {1, 2, 3, 12}


def test_lines_that_are_no_candidates_go_before_the_shuffle(spark, monkeypatch):
    nodes = spark.range(40000).selectExpr("unhex(md5(cast(id as string))) AS node", "id")
    wanted = nodes.filter("id % 20 = 0").select("node")
    for most in (fuzzy_lines.MOST_MAPS, 1):
        monkeypatch.setattr(fuzzy_lines, "MOST_MAPS", most)
        kept = {r.id for r in fuzzy_lines._perhaps(nodes, wanted).collect()}
        assert kept >= set(range(0, 40000, 20)) and len(kept) < (5000 if most > 1 else 8000)
    assert fuzzy_lines._perhaps(nodes, wanted.limit(0)).count() == 0


def test_candidates_are_let_through_before_they_are_joined(spark):
    """Spark moves a semi-join below the bitmaps; then all lines were shuffled for it."""
    lines = spark.range(3000).selectExpr("unhex(md5(cast(id as string))) AS node", "string(id) AS line")
    wanted = lines.filter("line like '%7'").select("node")
    found = fuzzy_lines._fetched(lines, wanted)
    assert {r.line for r in found.collect()} == {str(i) for i in range(7, 3000, 10)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    outer, inner = (x for x in plan.splitlines() if "Join" in x)
    assert "_map" in inner and "_map" not in outer


def test_sketches_rule_out_no_similar_lines(spark):
    """Most lines that are not similar need no comparison of their shingles."""
    r = random.Random(5)
    kinds = []
    for base in lines(7, 12):
        for changes in (0, 1, 1, 2, 4, 6, 9, 14):
            places = r.sample(range(len(base)), changes)
            kinds.append("".join("#" if k in places else c for k, c in enumerate(base)))
    sets = [{x[i : i + SHINGLE] for i in range(len(x) - SHINGLE + 1)} for x in kinds]
    rows = [(i, x, len(s), 0 if i % 8 == 7 else 99) for i, (x, s) in enumerate(zip(kinds, sets))]
    texts = spark.createDataFrame(rows, "node long, line string, n int, neighbours long")
    told = fuzzy_lines._sketched(texts).cache()
    assert {x.node for x in told.collect() if x.sketch} == {i for i, *_ in rows if i % 8 != 7}
    left = told.alias("x").join(
        told.alias("y"), (F.col("x.node") < F.col("y.node")) & fuzzy_lines._perhaps_alike("x", "y", 0.8)
    ).select("x.node", "y.node").collect()
    left = {tuple(x) for x in left}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    pairs = [(a, b) for b in range(len(sets)) for a in range(b)]
    similar = {p for p in pairs if alike(*p) >= 0.8}
    assert len(similar) > 40 and similar <= left
    assert {p for p in pairs if 7 in (p[0] % 8, p[1] % 8)} <= left
    others = [p for p in pairs if 7 not in (p[0] % 8, p[1] % 8) and alike(*p) < 0.65]
    assert len(others) > 2500 and len(left & set(others)) < len(others) / 20


def test_points_are_found_from_any_stride(spark, monkeypatch):
    texts = [x[:k] for k, x in zip((4, 5, 6, 12, 30, 60, 90, 200), lines(3, 8))]
    texts += [" ".join(lines(4, 9)), "aaaaaaaaaaaa", None]
    df = spark.createDataFrame(list(enumerate(texts)), "node long, line string")
    seen = []
    for stride in (fuzzy_lines.BANDS * fuzzy_lines.ROWS, fuzzy_lines.STRIDE, 9):
        monkeypatch.setattr(fuzzy_lines, "STRIDE", stride)
        seen.append({x.node: x["keys"] for x in fuzzy_lines._keyed(df).collect()})
    assert seen[0] == seen[1] == seen[2] and seen[0][0] is None and seen[0][10] is None
    assert all(len(seen[0][i]) == fuzzy_lines.BANDS for i in range(1, 10))


def test_no_python_in_the_plan(spark, capsys):
    df = spark.createDataFrame(fixture()[:5], "doc_id long, text string")
    for result in (line_classes(df), linked_lines(df)):
        result.explain("formatted")
        assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_edges(spark):
    docs = edge_documents(spark)
    rows = line_classes(docs).collect()
    assert len(rows) == 10
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_lines, r.dropped))
    assert got[1] == [(1, [])] and got[2] == [(0, [])] and got[3] == [(1, [])] and got[6] == [(2, [])]
    assert sorted(got[4]) == [(1, []), (1, [0])] and got[5] == [(1, [0])] and got[None] == [(1, [])]
    assert got[7] == [(1, [])] and got[8] == [(1, [])]
    clean = deduplicated_lines(docs)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[2] is None and texts[5] == "" and texts[3] == LONG and texts[6] == " \n\t "
    assert line_classes(no_documents(spark)).collect() == []
    assert deduplicated_lines(no_documents(spark)).collect() == []
