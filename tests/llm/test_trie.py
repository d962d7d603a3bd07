from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from tidecube.llm import trie
from tidecube.llm.trie import SQL, RangeMinimum, conversation_trie, op12_prefix_trie, prefix_trie, rebuilt

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
SCHEMA = "conv_id long, turn long, role string, text string"


def sequences_of(rows):
    """Rebuilt conversations by the contract's words; no two turns of one tie unless equal."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        first = c - int(c / 5) * 5 if c < 0 else c % 5
        out[c] = turns.get(c - first, [])[:h] + turns[c][h:]
    return out


def plain(sequences):
    """The nodes as a dictionary of prefixes."""
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[x] for x in below) or 1
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        saved[path] = own + sum(saved[x] for x in below)
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(path))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
                    len(children.get(path, [])), leaves[path], saved[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


@given(st.lists(st.integers(-1, 4), min_size=1, max_size=40), st.data())
@settings(max_examples=300, deadline=None)
def test_range_minimum(values, data):
    spans = RangeMinimum(np.array(values))
    start = data.draw(st.integers(0, len(values) - 1))
    least = data.draw(st.integers(-1, 5))
    left = right = start
    while left >= 1 and values[left] >= least:
        left -= 1
    while right + 1 < len(values) and values[right + 1] >= least:
        right += 1
    one = np.array([start]), np.array([least])
    assert (spans.left(*one)[0], spans.right(*one)[0]) == (left, right)
    end = data.draw(st.integers(start, len(values) - 1))
    assert spans.between(np.array([start]), np.array([end]))[0] == min(values[start : end + 1])


def test_query_equals_sql(spark, duck):
    want = duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({SQL})").fetchall()
    got = rows(op12_prefix_trie(spark, SF))
    assert got == sorted(want, key=str) and got


def random_rows(seed, convs, most=14):
    r = random.Random(seed)
    out = []
    for c in r.sample(range(-20, 3 * convs), convs):
        hot = r.random() < 0.4  # many share their turns
        for turn in range(most // 2 if hot else r.randrange(1, most)):
            text = "é" * turn if hot else r.choice(["", "a", "bb", "ccc", None])
            out.append((c, turn if turn else None, r.choice(["user", None]) if not hot else "user", text))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_random_conversations_in_parts(spark, parts, monkeypatch):
    data = random_rows(parts, 90)
    monkeypatch.setattr(trie, "BATCH", 7)
    want = plain(sequences_of(data))
    got = rows(prefix_trie(rebuilt(spark.createDataFrame(data, SCHEMA).repartition(3)), parts))
    assert got == want


def test_copies_and_one_long_conversation(spark):
    data = [(5 * c, t, "user", f"turn {t}") for c in range(60) for t in range(3)]  # one group of copies
    data += [(1000, t, "user", f"turn {t}") for t in range(500)]
    data += [(1007, 0, "user", "alone"), (2, 0, "user", "turn 0")]
    want = plain(sequences_of(data))
    assert rows(prefix_trie(rebuilt(spark.createDataFrame(data, SCHEMA)), 7)) == want


def test_edge_rows(spark):
    data = [
        (None, 0, "user", "of no conversation"), (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""),
        (2, 3, "user", "x" * 300_000), (2, 4, None, "b"), (7, 0, "a", "b"), (7, 0, "ab", ""), (9, 1, "", "ab"),
        (-6, 0, "user", "t"), (-5, 0, "user", "t"), (11, 0, "user", "only one turn"), (0, 0, "user", "z"),
    ]
    clashing = ["part", "codes", "sizes", "depth", "node", "before", "code", "size", "listed", "turns"]
    df = spark.createDataFrame([(*r, *["x"] * len(clashing)) for r in data],
                               SCHEMA + ", " + ", ".join(f"{c} string" for c in clashing))
    got = rows(conversation_trie(df))
    sequences = sequences_of(data)
    swapped = dict(sequences)  # conversation 7 has two turns that tie: either order is one of them
    swapped[7] = list(reversed(sequences[7]))
    assert got in (plain(sequences), plain(swapped))
    assert got == rows(conversation_trie(df.repartition(5)))


def test_turnless_and_empty(spark):
    # The first turns of a conversation are replaced by those of one that is not there.
    missing = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    df = spark.createDataFrame([(missing, 0, "user", "gone")], SCHEMA)
    assert rows(conversation_trie(df)) == plain({missing: []})
    assert rows(conversation_trie(df)) == [
        (missing, 0, None, 1, 0, 1, 0, hashlib.sha256(str(missing).encode()).hexdigest())]
    for none in (df.limit(0), df.selectExpr("CAST(NULL AS BIGINT) AS conv_id", "turn", "role", "text")):
        assert rows(conversation_trie(none)) == []
