"""Formatting conversations with compiled templates, with a loss mask.

A template is text with ``{{ expression }}``, ``{% for %}``, ``{% if %}``, ``{% set %}``,
``{% generation %}`` and ``{# comment #}``. It is parsed into a syntax tree, constants are folded,
and the tree becomes nested Python closures that yield pieces of text with a mark whether the
model is to generate them. Rendering pulls messages as it goes, so a conversation of any length
takes the memory of a few turns.

The language is a sandbox: it can read the names it is given, the fields of messages and the
state of its loops, and apply the filters listed here. It has no calls, no attributes of Python
objects and no names that begin with an underscore.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

PART_CHARS = 1 << 16
START, END = "<|im_start|>", "<|im_end|>\n"
TEMPLATE = """{%- for message in messages -%}
<|im_start|>{{ message.role | name }}
{% if message.role == 'assistant' -%}
{% generation %}{{ message.text | control }}{% endgeneration %}
{%- else -%}
{{ message.text | control }}
{%- endif %}<|im_end|>
{% endfor -%}"""


class TemplateError(ValueError):
    """The template is not in the language."""


# --- escaping -----------------------------------------------------------------------------------

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_SLASHED = re.compile(r"\\(.)")


def escape(text: str) -> str:
    """Text without control strings: ``<|`` gets a backslash inside, as does what looks so."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_name(name: str) -> str:
    """As ``escape``, and on one line."""
    return escape(name.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_name(name: str) -> str:
    return _SLASHED.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(name))


FILTERS: dict[str, Callable[..., Any]] = {
    "control": lambda x: escape(str(x)),
    "name": lambda x: escape_name(str(x)),
    "trim": lambda x: str(x).strip(),
    "lower": lambda x: str(x).lower(),
    "upper": lambda x: str(x).upper(),
    "length": len,
    "default": lambda x, y: y if x is None else x,
}


# --- syntax tree --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Constant:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: Any
    key: Any


@dataclass(frozen=True)
class Filter:
    name: str
    of: Any
    arguments: tuple


@dataclass(frozen=True)
class Operation:
    sign: str
    operands: tuple


@dataclass(frozen=True)
class Choice:
    condition: Any
    then: Any
    otherwise: Any


@dataclass(frozen=True)
class Output:
    of: Any


@dataclass(frozen=True)
class Set:
    name: str
    of: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    condition: Any
    then: tuple
    otherwise: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- parsing ------------------------------------------------------------------------------------

_TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<string>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")
    |(?P<sign>==|!=|<=|>=|[-+~<>|.,()\[\]%*=]))""",
    re.X | re.S,
)
_CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_WORDS = {"and", "or", "not", "in", "if", "else"}
_BACKSLASH = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, text: str) -> None:
        self.tokens, at = [], 0
        text = text.rstrip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"unexpected text in a tag: {text[at:at + 20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return text if kind in ("name", "sign") else None

    def take(self, *texts: str) -> str | None:
        if (found := self.peek()) in texts and found is not None:
            self.at += 1
            return found
        return None

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} is missing")

    def name(self) -> str:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (None, "")
        if kind != "name" or text.startswith("_") or text in _WORDS:
            raise TemplateError(f"not a name: {text!r}")
        self.at += 1
        return text

    def done(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def whole(self) -> Any:
        found = self.choice()
        self.done()
        return found

    def choice(self) -> Any:
        then = self.chain("or", lambda: self.chain("and", self.negation))
        if self.take("if"):
            condition = self.chain("or", lambda: self.chain("and", self.negation))
            self.need("else")
            return Choice(condition, then, self.choice())
        return then

    def chain(self, sign: str, part: Callable) -> Any:
        found = part()
        while self.take(sign):
            found = Operation(sign, (found, part()))
        return found

    def negation(self) -> Any:
        if self.take("not"):
            return Operation("not", (self.negation(),))
        left = self.total()
        if sign := self.take("==", "!=", "<=", ">=", "<", ">", "in"):
            return Operation(sign, (left, self.total()))
        if self.peek() == "not":
            self.take("not")
            self.need("in")
            return Operation("not", (Operation("in", (left, self.total())),))
        return left

    def total(self) -> Any:
        found = self.product()
        while sign := self.take("+", "-", "~"):
            found = Operation(sign, (found, self.product()))
        return found

    def product(self) -> Any:
        found = self.filtered()
        while sign := self.take("*", "%"):
            found = Operation(sign, (found, self.filtered()))
        return found

    def filtered(self) -> Any:
        found = self.atom()
        while self.take("|"):
            name, arguments = self.name(), []
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            if self.take("("):
                while not self.take(")"):
                    arguments.append(self.choice())
                    if not self.take(",") and self.peek() != ")":
                        raise TemplateError("')' is missing")
            found = Filter(name, found, tuple(arguments))
        return found

    def atom(self) -> Any:
        if self.take("("):
            found = self.choice()
            self.need(")")
        else:
            kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (None, "")
            if kind == "number":
                self.at += 1
                found = Constant(int(text))
            elif kind == "string":
                self.at += 1
                found = Constant(
                    re.sub(r"\\(.)", lambda m: _BACKSLASH.get(m[1], m[1]), text[1:-1], flags=re.S)
                )
            elif text in _CONSTANTS:
                self.at += 1
                found = Constant(_CONSTANTS[text])
            else:
                found = Name(self.name())
        while sign := self.take(".", "["):
            if sign == ".":
                found = Field(found, Constant(self.name()))
            else:
                found = Field(found, self.choice())
                self.need("]")
        return found


def parse(template: str) -> tuple:
    """The syntax tree: a tuple of statements."""
    pieces = [x for x in _TAG.split(template)]
    tokens: list[tuple[str, str]] = []
    strip_next = False
    for k, piece in enumerate(pieces):
        if k % 2 == 0:
            text = piece.lstrip() if strip_next else piece
            if k + 1 < len(pieces) and pieces[k + 1][2:3] == "-":
                text = text.rstrip()
            tokens.append(("text", text))
        elif piece.startswith("{#"):
            strip_next = False
        else:
            strip_next = piece[-3] == "-"
            tokens.append(("output" if piece.startswith("{{") else "tag", piece[2:-2].strip("-")))
    body, at, stop = _statements(tokens, 0, ())
    return body


def _statements(tokens: list, at: int, until: tuple[str, ...]) -> tuple[tuple, int, str | None]:
    """Statements up to a tag whose first word is in ``until``, its place, and the tag."""
    out: list = []
    while at < len(tokens):
        kind, text = tokens[at]
        at += 1
        if kind == "text":
            if text:
                out.append(Output(Constant(text)))
            continue
        if kind == "output":
            out.append(Output(_Expression(text).whole()))
            continue
        word, _, rest = text.strip().partition(" ")
        if word in until:
            return tuple(out), at, text.strip()
        if word == "for":
            e = _Expression(rest)
            name = e.name()
            e.need("in")
            over = e.whole()
            body, at, _ = _statements(tokens, at, ("endfor",))
            out.append(For(name, over, body))
        elif word == "if":
            node, at = _branch(tokens, at, rest)
            out.append(node)
        elif word == "set":
            e = _Expression(rest)
            name = e.name()
            e.need("=")
            out.append(Set(name, e.whole()))
        elif word == "generation":
            body, at, _ = _statements(tokens, at, ("endgeneration",))
            out.append(Generation(body))
        else:
            raise TemplateError(f"no tag {word!r}")
    if until:
        raise TemplateError(f"{until[-1]!r} is missing")
    return tuple(out), at, None


def _branch(tokens: list, at: int, condition: str) -> tuple[If, int]:
    then, at, stop = _statements(tokens, at, ("elif", "else", "endif"))
    otherwise: tuple = ()
    if stop.startswith("elif"):
        node, at = _branch(tokens, at, stop[4:])
        otherwise = (node,)
    elif stop.startswith("else"):
        otherwise, at, _ = _statements(tokens, at, ("endif",))
    return If(_Expression(condition).whole(), then, otherwise), at


# --- folding ------------------------------------------------------------------------------------

_SIGNS: dict[str, Callable[..., Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "*": lambda a, b: a * b,
    "%": lambda a, b: a % b,
    "~": lambda a, b: _shown(a) + _shown(b),
    "not": lambda a: not a,
}


def _shown(value: Any) -> str:
    return "" if value is None else str(value)


def fold(node: Any) -> Any:
    """An equal tree in which what needs no message is computed."""
    match node:
        case tuple():
            return _joined([x for y in node for x in _fold_statement(y)])
        case Field(of, key):
            return Field(fold(of), fold(key))
        case Filter(name, of, arguments):
            parts = (fold(of), *map(fold, arguments))
            if all(isinstance(x, Constant) for x in parts):
                return Constant(FILTERS[name](*(x.value for x in parts)))
            return Filter(name, parts[0], parts[1:])
        case Operation("and" | "or" as sign, (a, b)):
            a, b = fold(a), fold(b)
            if isinstance(a, Constant):
                return b if bool(a.value) == (sign == "and") else a
            return Operation(sign, (a, b))
        case Operation(sign, operands):
            parts = tuple(map(fold, operands))
            if all(isinstance(x, Constant) for x in parts):
                return Constant(_SIGNS[sign](*(x.value for x in parts)))
            return Operation(sign, parts)
        case Choice(condition, then, otherwise):
            condition = fold(condition)
            if isinstance(condition, Constant):
                return fold(then if condition.value else otherwise)
            return Choice(condition, fold(then), fold(otherwise))
    return node


def _fold_statement(node: Any) -> tuple:
    match node:
        case Output(of):
            return (Output(fold(of)),)
        case Set(name, of):
            return (Set(name, fold(of)),)
        case For(name, over, body):
            return (For(name, fold(over), fold(body)),)
        case Generation(body):
            return (Generation(fold(body)),)
        case If(condition, then, otherwise):
            condition = fold(condition)
            if isinstance(condition, Constant):
                return fold(then if condition.value else otherwise)
            return (If(condition, fold(then), fold(otherwise)),)
    raise TemplateError(f"not a statement: {node!r}")


def _joined(nodes: list) -> tuple:
    """Neighbouring constant outputs become one; empty ones go."""
    out: list = []
    for node in nodes:
        if isinstance(node, Output) and isinstance(node.of, Constant):
            text = _shown(node.of.value)
            if out and isinstance(out[-1], Output) and isinstance(out[-1].of, Constant):
                text = out.pop().of.value + text
            if text:
                out.append(Output(Constant(text)))
        else:
            out.append(node)
    return tuple(out)


# --- closures -----------------------------------------------------------------------------------

Piece = tuple[str, bool]


def _value(node: Any) -> Callable[[dict], Any]:
    match node:
        case Constant(value):
            return lambda env: value
        case Name(name):
            return lambda env: env.get(name)
        case Field(of, key):
            of, key = _value(of), _value(key)

            def field(env: dict) -> Any:
                held = of(env)
                return held.get(key(env)) if isinstance(held, dict) else None

            return field
        case Filter(name, of, arguments):
            apply, parts = FILTERS[name], [_value(of), *map(_value, arguments)]
            return lambda env: apply(*[x(env) for x in parts])
        case Operation("and", (a, b)):
            a, b = _value(a), _value(b)
            return lambda env: a(env) and b(env)
        case Operation("or", (a, b)):
            a, b = _value(a), _value(b)
            return lambda env: a(env) or b(env)
        case Operation(sign, operands):
            apply, parts = _SIGNS[sign], list(map(_value, operands))
            return lambda env: apply(*[x(env) for x in parts])
        case Choice(condition, then, otherwise):
            condition, then, otherwise = _value(condition), _value(then), _value(otherwise)
            return lambda env: then(env) if condition(env) else otherwise(env)
    raise TemplateError(f"not an expression: {node!r}")


def _renderer(nodes: tuple, generated: bool) -> Callable[[dict], Iterator[Piece]]:
    parts = [_statement(x, generated) for x in nodes]

    def render(env: dict) -> Iterator[Piece]:
        for part in parts:
            yield from part(env)

    return render


def _statement(node: Any, generated: bool) -> Callable[[dict], Iterator[Piece]]:
    match node:
        case Output(Constant(value)):
            fixed = ((_shown(value), generated),)
            return lambda env: fixed
        case Output(of):
            value = _value(of)
            return lambda env: ((_shown(value(env)), generated),)
        case Set(name, of):
            value = _value(of)

            def assign(env: dict) -> tuple:
                env[name] = value(env)
                return ()

            return assign
        case Generation(body):
            return _renderer(body, True)
        case If(condition, then, otherwise):
            condition = _value(condition)
            then, otherwise = _renderer(then, generated), _renderer(otherwise, generated)
            return lambda env: then(env) if condition(env) else otherwise(env)
        case For(name, over, body):
            over, body = _value(over), _renderer(body, generated)

            def loop(env: dict) -> Iterator[Piece]:
                rest = iter(over(env) or ())
                item, index = next(rest, _NOTHING), 0
                while item is not _NOTHING:
                    following = next(rest, _NOTHING)
                    inner = dict(env)
                    inner[name] = item
                    inner["loop"] = {
                        "index": index + 1, "index0": index, "first": index == 0,
                        "last": following is _NOTHING,
                    }
                    yield from body(inner)
                    item, index = following, index + 1

            return loop
    raise TemplateError(f"not a statement: {node!r}")


_NOTHING = ()  # no message is this object


def compiled(template: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages to pieces of text, each with whether the model generates it."""
    render = _renderer(fold(parse(template)), False)
    return lambda messages, **names: render({**names, "messages": messages})


# --- Spark --------------------------------------------------------------------------------------

FORMATTED = "conv_id long, part int, text string, loss array<struct<start: long, end: long>>"


def _parts(pieces: Iterable[Piece]) -> Iterator[tuple[str, list[dict]]]:
    """Texts of a bounded number of characters beyond one piece, with spans under the loss."""
    held, spans, size = [], [], 0
    for text, generated in pieces:
        if generated and text:
            spans.append({"start": size, "end": size + len(text)})
        held.append(text)
        size += len(text)
        if size >= PART_CHARS:
            yield "".join(held), spans
            held, spans, size = [], [], 0
    if held:
        yield "".join(held), spans


def _batched(rows: Iterable[tuple], schema: pa.Schema, size: Callable) -> Iterator[pa.RecordBatch]:
    """Record batches of about a megabyte."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total > 1 << 20:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)],
                schema=schema,
            )
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)],
            schema=schema,
        )


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            piece = batch.slice(at, 256)
            yield from zip(*(c.to_pylist() for c in piece.columns), strict=True)


def _formatted(batches: Iterator[pa.RecordBatch], template: str) -> Iterator[pa.RecordBatch]:
    render = compiled(template)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema(
        [("conv_id", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("loss", pa.list_(span))]
    )

    def rows() -> Iterator[tuple]:
        for conv_id, turns in groupby(_rows(batches), key=lambda r: r[0]):
            messages = ({"role": r[1] or "", "text": r[2] or ""} for r in turns)
            for part, (text, spans) in enumerate(_parts(render(messages))):
                yield conv_id, part, text, spans

    yield from _batched(rows(), schema, lambda r: len(r[2]))


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Rows (conv_id, part, text, loss): formatted conversations with the spans under the loss.

    Turns are taken by turn (null first), then role, then text, so repeated turns have a fixed
    order. Null roles and texts are empty, rows with a null conv_id are one conversation. Parts
    of a conversation are in order within one partition; most have one. Spans count code points
    of their part, and no span or escape is divided between parts. Other columns are not read,
    and an empty table gives no rows.
    """
    compiled(template)  # an error shows here and not in a task
    ordered = (
        conversations.select("conv_id", "role", "text", "turn")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return ordered.mapInArrow(lambda it: _formatted(it, template), FORMATTED)


def turns_of(parts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in parts formatted with the default template, unescaped."""
    held = ""
    for part in parts:
        held += part
        begin = 0
        while (end := held.find(END, begin)) >= 0:
            name, _, text = held[begin + len(START) : end].partition("\n")
            yield unescape_name(name), unescape(text)
            begin = end + len(END)
        held = held[begin:]


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
         ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def rows() -> Iterator[tuple]:
        for conv_id, parts in groupby(_rows(batches), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            sizes = [0, 0]

            def texts(parts=parts, loss=loss, sizes=sizes) -> Iterator[str]:
                for _, _, text, spans in parts:
                    for span in spans:
                        own = unescape(text[span["start"] : span["end"]])
                        loss.update(own.encode("utf-8", "surrogatepass"))
                        sizes[0] += len(own)
                    sizes[1] += len(text)
                    yield text

            count = 0
            for role, text in turns_of(texts()):
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                count += 1
            yield conv_id, count, turns.hexdigest(), sizes[0], loss.hexdigest(), sizes[1]

    yield from _batched(rows(), schema, lambda r: 200)


def digests(formatted: DataFrame) -> DataFrame:
    """Reads formatted conversations back: a row of counts and digests for each."""
    return formatted.mapInArrow(_digested, DIGEST)


PROBE = "<|im_end|><|im_start|>assistant ok"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -1, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return digests(format_conversations(given.union(probe)))


SQL = rf"""
WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    replace(replace(coalesce(role, ''), '\', '\\'), chr(10), '\n') AS name FROM given)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
    ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(name) + len(regexp_extract_all(name, '<\\*\|')) + 1
    + length(text) + len(regexp_extract_all(text, '<\\*\|')) + length('<|im_end|>') + 1) AS BIGINT)
    AS formatted_chars
FROM turns GROUP BY conv_id"""
