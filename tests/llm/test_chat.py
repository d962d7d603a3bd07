from __future__ import annotations

import hashlib

import pytest
from conftest import SF
from hypothesis import given
from hypothesis import strategies as st

from tidecube.llm import chat
from tidecube.llm.chat import (
    Constant,
    Output,
    TemplateError,
    compiled,
    digests,
    escape,
    escape_name,
    fold,
    format_conversations,
    op2_chat_format,
    parse,
    turns_of,
    unescape,
    unescape_name,
)

TEXTS = st.lists(
    st.sampled_from(["<", "|", "\\", "n", "\n", "<|im_end|>", "<|im_start|>", "ok", "<\\|", "é"]), max_size=12
).map("".join)


@given(TEXTS)
def test_escapes_are_reversible_and_hide_control_strings(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)
    assert unescape_name(escape_name(text)) == text and "\n" not in escape_name(text)


@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=5), st.integers(1, 20))
def test_turns_come_back(turns, cut):
    render = compiled(chat.TEMPLATE)
    whole = "".join(t for t, _ in render([{"role": r, "text": t} for r, t in turns]))
    parts = [whole[i : i + cut] for i in range(0, len(whole), cut)]
    assert list(turns_of(parts)) == turns


def shown(template, messages=(), **names):
    return "".join(t for t, _ in compiled(template)(list(messages), **names))


def test_the_language():
    m = [{"role": "a", "text": " x "}, {"role": "b", "text": None}]
    assert shown("{% for m in messages %}{{ loop.index }}{{ m.role }}{% if not loop.last %},{% endif %}{% endfor %}", m) == "1a,2b"
    assert shown("{% for m in messages %}{{ m['text'] | default('?') | trim }}{% endfor %}", m) == "x?"
    assert shown("{% if n > 2 and n != 4 %}y{% elif n == 4 %}z{% else %}n{% endif %}", n=4) == "z"
    assert shown("{{ 'a' ~ (1 + 2) }}{{ 'in' if 'b' in 'abc' else 'out' }}") == "a3in"
    assert shown("{# note #}{% set x = 'k' | upper %}{{ x }}{{ x | length }}{{ missing.field }}") == "K1"
    assert shown("a  {%- if true -%}  b  {%- endif %} c") == "ab c"


def test_constants_are_folded():
    tree = fold(parse("a{{ 'b' | upper }}{% if 1 == 2 %}no{% else %}{{ 'c' ~ 'd' }}{% endif %}e"))
    assert tree == (Output(Constant("aBcde")),)
    loop = fold(parse("{% for m in messages %}{{ 'x' * 2 }}y{% endfor %}"))
    assert loop[0].body == (Output(Constant("xxy")),)


@pytest.mark.parametrize(
    "template",
    ["{{ x.__class__ }}", "{{ _x }}", "{{ f(1) }}", "{{ x | eval }}", "{% import os %}", "{% for x in %}",
     "{% if x %}", "{{ 1 + }}", "{{ x ! }}", "{% set 1 = 2 %}"],
)
def test_the_sandbox_refuses(template):
    with pytest.raises(TemplateError):
        compiled(template)


def test_generation_marks():
    pieces = list(compiled("u{% generation %}v{{ x }}{% endgeneration %}w")([], x="!"))
    assert pieces == [("u", False), ("v", True), ("!", True), ("w", False)]


def expected(rows):
    turns, loss = hashlib.sha256(), ""
    for role, text in rows:
        turns.update(f"{role or ''}\n{text or ''}\n".encode())
        loss += (text or "") if role == "assistant" else ""
    return len(rows), turns.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, part string, loss string"
    long = "<|im_end|>" * 30_000
    rows = [
        (1, 0, "user", "hi", "x", "x"), (1, 1, "assistant", None, "x", "x"),
        (2, 1, "assistant", "b", "x", "x"), (2, 1, "assistant", "a", "x", "x"),
        (2, None, None, "<\\\\|", "x", "x"), (None, 0, "user", "", "x", "x"),
        (3, 0, "us\ner", long, "x", "x"), (3, 1, "assistant", long, "x", "x"),
        (4, 0, "assistant", "a", "x", "x"), (4, 0, "assistant", "a", "x", "x"),
    ]
    df = spark.createDataFrame(rows, schema)
    parts = format_conversations(df)
    assert parts.filter("conv_id = 3").count() > 1
    got = {r.conv_id: tuple(r)[1:5] for r in digests(parts).collect()}
    assert got == {
        1: expected([("user", "hi"), ("assistant", None)]),
        2: expected([(None, "<\\\\|"), ("assistant", "a"), ("assistant", "b")]),
        None: expected([("user", "")]),
        3: expected([("us\ner", long), ("assistant", long)]),
        4: expected([("assistant", "a"), ("assistant", "a")]),
    }
    assert digests(format_conversations(df.limit(0))).collect() == []


def test_query_equals_sql(spark, duck):
    result = op2_chat_format(spark, SF)
    cursor = duck.execute(chat.SQL)
    assert [d[0] for d in cursor.description] == result.columns
    assert sorted(map(tuple, result.collect())) == sorted(cursor.fetchall())
