"""A small sandboxed template language, compiled to Python closures.

Text is copied. ``{{ expression }}`` writes a value; ``{# ... #}`` is nothing; tags are
``{% for x in list %} {% else %} {% endfor %}``, ``{% if %} {% elif %} {% else %}
{% endif %}``, ``{% set x = expression %}`` and ``{% generation %} {% endgeneration %}``,
which marks what a model is to generate. A ``-`` inside a brace takes white space off
that side. Inside a loop, ``loop`` has index, index0, first, last and length.

Expressions: strings, integers, true, false, none, lists, names, ``a.b``, ``a[b]``,
``not``, ``and``, ``or``, comparisons, ``in``, ``+ - * %``, ``~`` (joins texts) and
filters ``a | f(b)``. Values are those given and what these make of them: there are no
calls, and ``.`` reads keys of mappings only, so a template cannot reach Python.

A template is parsed to a tree, constant parts of it are folded, and each node becomes
a closure over its parts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from typing import Any, NamedTuple


class TemplateError(ValueError):
    """A template that cannot be parsed, or values it cannot work on."""


# Tree -------------------------------------------------------------------------


class Constant(NamedTuple):
    value: Any


class Name(NamedTuple):
    name: str


class Operation(NamedTuple):
    """An operator or filter on expressions."""

    name: str
    parts: tuple


class Text(NamedTuple):
    text: str


class Write(NamedTuple):
    value: Any


class Branch(NamedTuple):
    test: Any
    then: tuple
    other: tuple


class Loop(NamedTuple):
    name: str
    items: Any
    body: tuple
    other: tuple


class Assign(NamedTuple):
    name: str
    value: Any


class Generation(NamedTuple):
    body: tuple


# Operators --------------------------------------------------------------------


def _text(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def _get(value: Any, key: Any) -> Any:
    """A key of a mapping, or an item of a list; none where there is none."""
    if isinstance(value, Mapping):
        return value.get(key)
    if isinstance(value, list) and isinstance(key, int):
        return value[key] if -len(value) <= key < len(value) else None
    return None


def _add(a: Any, b: Any) -> Any:
    same = isinstance(a, int) == isinstance(b, int) and isinstance(a, str) == isinstance(b, str)
    if not same or not isinstance(a, int | str | list):
        raise TemplateError("+ takes two numbers, two texts or two lists")
    return a + b


def _number(a: Any) -> int:
    if not isinstance(a, int):
        raise TemplateError("a number is needed")
    return a


_COMPARE = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "not in": lambda a, b: a not in b,
}
OPERATORS: dict[str, Callable] = {
    **_COMPARE,
    "not": lambda a: not a,
    "+": _add,
    "-": lambda a, b: _number(a) - _number(b),
    "*": lambda a, b: _number(a) * _number(b),
    "%": lambda a, b: _number(a) % _number(b),
    "~": lambda a, b: _text(a) + _text(b),
    "get": _get,
    "list": lambda *a: list(a),
}
FILTERS: dict[str, Callable] = {
    "trim": lambda a: _text(a).strip(),
    "upper": lambda a: _text(a).upper(),
    "lower": lambda a: _text(a).lower(),
    "length": lambda a: len(a),
    "default": lambda a, b: b if a is None else a,
    "first": lambda a: a[0] if a else None,
    "last": lambda a: a[-1] if a else None,
    "join": lambda a, b="": _text(b).join(map(_text, a)),
    "replace": lambda a, b, c: _text(a).replace(b, c),
}


# Parsing ----------------------------------------------------------------------

_PIECES = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#-?(.*?)-?#\}", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")"""
    r"""|(?P<sign>==|!=|<=|>=|[<>+\-*%~|().,\[\]=]))""",
    re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}


def _string(literal: str) -> str:
    return re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), literal[1:-1], flags=re.S)


class _Expressions:
    """A recursive-descent parser of one expression."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.tokens: list[tuple[str, str]] = []
        self.filters = filters
        self.at = 0
        source = source.rstrip()
        place = 0
        while place < len(source):
            found = _TOKEN.match(source, place)
            if not found:
                raise TemplateError(f"cannot read {source[place:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            place = found.end()

    def peek(self) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "string":
            return self.tokens[self.at][1]
        return None

    def take(self, *wanted: str) -> str | None:
        if (token := self.peek()) in wanted:
            self.at += 1
            return token
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def whole(self) -> Any:
        found = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return found

    def either(self) -> Any:
        left = self.both()
        while self.take("or"):
            left = Operation("or", (left, self.both()))
        return left

    def both(self) -> Any:
        left = self.negated()
        while self.take("and"):
            left = Operation("and", (left, self.negated()))
        return left

    def negated(self) -> Any:
        if self.take("not"):
            return Operation("not", (self.negated(),))
        return self.compared()

    def compared(self) -> Any:
        left = self.sum()
        while sign := self.take("==", "!=", "<", "<=", ">", ">=", "in", "not"):
            if sign == "not":
                self.need("in")
                sign = "not in"
            left = Operation(sign, (left, self.sum()))
        return left

    def sum(self) -> Any:
        left = self.product()
        while sign := self.take("+", "-", "~"):
            left = Operation(sign, (left, self.product()))
        return left

    def product(self) -> Any:
        left = self.filtered()
        while sign := self.take("*", "%"):
            left = Operation(sign, (left, self.filtered()))
        return left

    def filtered(self) -> Any:
        left = self.reached()
        while self.take("|"):
            name = self.name()
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            left = Operation("|" + name, (left, *self.arguments("(", ")", optional=True)))
        return left

    def arguments(self, opening: str, closing: str, optional: bool = False) -> list:
        if not self.take(opening):
            if optional:
                return []
            raise TemplateError(f"{opening!r} is missing")
        found = []
        while not self.take(closing):
            found.append(self.either())
            if not self.take(","):
                self.need(closing)
                break
        return found

    def reached(self) -> Any:
        left = self.single()
        while sign := self.take(".", "["):
            if sign == ".":
                left = Operation("get", (left, Constant(self.name())))
            else:
                left = Operation("get", (left, self.either()))
                self.need("]")
        return left

    def single(self) -> Any:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, token = self.tokens[self.at]
        if kind == "string":
            self.at += 1
            return Constant(_string(token))
        if kind == "number":
            self.at += 1
            return Constant(int(token))
        if kind == "name":
            self.at += 1
            return Constant(_WORDS[token]) if token in _WORDS else Name(token)
        if token == "[":
            return Operation("list", tuple(self.arguments("[", "]")))
        if self.take("-"):
            return Operation("-", (Constant(0), self.reached()))
        self.need("(")
        found = self.either()
        self.need(")")
        return found


class _Statements:
    """A parser of text, values and tags into a tree."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.filters = filters
        self.pieces: list[tuple[str, str]] = []
        self.at = 0
        place, strip = 0, False
        for found in _PIECES.finditer(source):
            text = source[place : found.start()]
            text = text.lstrip() if strip else text
            self.pieces.append(("text", text.rstrip() if found[0][2] == "-" else text))
            strip, place = found[0][-3] == "-", found.end()
            if found[1] is not None:
                self.pieces.append(("value", found[1].strip()))
            elif found[2] is not None:
                self.pieces.append(("tag", found[2].strip()))
        text = source[place:]
        self.pieces.append(("text", text.lstrip() if strip else text))

    def expressions(self, source: str) -> _Expressions:
        return _Expressions(source, self.filters)

    def body(self, *ends: str) -> tuple[tuple, str, str]:
        """Statements up to a tag of one of ``ends``; that tag, and what follows in it."""
        found: list = []
        while self.at < len(self.pieces):
            kind, source = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                found.append(Text(source))
            elif kind == "value":
                found.append(Write(self.expressions(source).whole()))
            else:
                word, _, rest = source.partition(" ")
                if word in ends:
                    return tuple(found), word, rest
                found.append(self.tag(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tuple(found), "", ""

    def tag(self, word: str, rest: str) -> Any:
        if word == "set":
            parts = self.expressions(rest)
            name = parts.name()
            parts.need("=")
            return Assign(name, parts.whole())
        if word == "generation":
            return Generation(self.body("endgeneration")[0])
        if word == "for":
            parts = self.expressions(rest)
            name = parts.name()
            parts.need("in")
            items = parts.whole()
            body, end, _ = self.body("else", "endfor")
            other = self.body("endfor")[0] if end == "else" else ()
            return Loop(name, items, body, other)
        if word == "if":
            return self.branch(rest)
        raise TemplateError(f"no tag {word!r}")

    def branch(self, test: str) -> Branch:
        condition = self.expressions(test).whole()
        then, end, rest = self.body("elif", "else", "endif")
        if end == "elif":
            return Branch(condition, then, (self.branch(rest),))
        other = self.body("endif")[0] if end == "else" else ()
        return Branch(condition, then, other)


def parse(source: str, filters: Mapping[str, Callable] = FILTERS) -> tuple:
    return _Statements(source, filters).body()[0]


# Folding ----------------------------------------------------------------------


def fold(node: Any, filters: Mapping[str, Callable] = FILTERS) -> Any:
    """The expression with its constant parts computed."""
    if not isinstance(node, Operation):
        return node
    parts = tuple(fold(x, filters) for x in node.parts)
    if node.name in {"and", "or"}:
        left, right = parts
        if isinstance(left, Constant):
            return right if bool(left.value) == (node.name == "and") else left
        return Operation(node.name, parts)
    if all(isinstance(x, Constant) for x in parts) and node.name != "list":
        work = filters[node.name[1:]] if node.name[0] == "|" else OPERATORS[node.name]
        return Constant(work(*(x.value for x in parts)))
    return Operation(node.name, parts)


def fold_body(body: tuple, filters: Mapping[str, Callable] = FILTERS) -> tuple:
    """Statements with constants written as text, dead branches gone and texts joined."""
    out: list = []

    def add(node: Any) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        elif node != Text(""):
            out.append(node)

    for node in body:
        if isinstance(node, Write):
            value = fold(node.value, filters)
            add(Text(_text(value.value)) if isinstance(value, Constant) else Write(value))
        elif isinstance(node, Branch):
            test = fold(node.test, filters)
            then, other = fold_body(node.then, filters), fold_body(node.other, filters)
            if isinstance(test, Constant):
                for x in then if test.value else other:
                    add(x)
            else:
                add(Branch(test, then, other))
        elif isinstance(node, Loop):
            parts = fold_body(node.body, filters), fold_body(node.other, filters)
            add(Loop(node.name, fold(node.items, filters), *parts))
        elif isinstance(node, Assign):
            add(Assign(node.name, fold(node.value, filters)))
        elif isinstance(node, Generation):
            add(Generation(fold_body(node.body, filters)))
        else:
            add(node)
    return tuple(out)


# Closures ---------------------------------------------------------------------


class Output:
    """What is written, and the ranges (in characters) of what is to be generated."""

    def __init__(self):
        self.parts: list[str] = []
        self.size = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _value(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict], Any]:
    if isinstance(node, Constant):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    parts = [_value(x, filters) for x in node.parts]
    if node.name == "and":
        left, right = parts
        return lambda scope: left(scope) and right(scope)
    if node.name == "or":
        left, right = parts
        return lambda scope: left(scope) or right(scope)
    work = filters[node.name[1:]] if node.name[0] == "|" else OPERATORS[node.name]
    return lambda scope: work(*[x(scope) for x in parts])


def _run(body: tuple, filters: Mapping[str, Callable]) -> Callable[[dict, Output], None]:
    steps = [_statement(x, filters) for x in body]

    def run(scope: dict, out: Output) -> None:
        for step in steps:
            step(scope, out)

    return steps[0] if len(steps) == 1 else run


def _statement(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict, Output], None]:
    if isinstance(node, Text):
        text = node.text
        return lambda scope, out: out.write(text)
    if isinstance(node, Write):
        value = _value(node.value, filters)
        return lambda scope, out: out.write(_text(value(scope)))
    if isinstance(node, Assign):
        name, value = node.name, _value(node.value, filters)
        return lambda scope, out: scope.__setitem__(name, value(scope))
    if isinstance(node, Branch):
        test = _value(node.test, filters)
        then, other = _run(node.then, filters), _run(node.other, filters)
        return lambda scope, out: (then if test(scope) else other)(scope, out)
    if isinstance(node, Generation):
        body = _run(node.body, filters)

        def generation(scope: dict, out: Output) -> None:
            start = out.size
            body(scope, out)
            out.spans.append((start, out.size))

        return generation
    name, items = node.name, _value(node.items, filters)
    body, other = _run(node.body, filters), _run(node.other, filters)

    def loop(scope: dict, out: Output) -> None:
        values = items(scope) or []
        if not isinstance(values, list):
            raise TemplateError("for takes a list")
        last = len(values) - 1
        for i, value in enumerate(values):
            place = {"index": i + 1, "index0": i, "first": i == 0, "last": i == last,
                     "length": last + 1}
            body({**scope, name: value, "loop": place}, out)
        if not values:
            other(scope, out)

    return loop


def compile_template(
    source: str, filters: Mapping[str, Callable] | None = None
) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from values to the text and the spans to be generated.

    ``filters`` are added to FILTERS.
    """
    known = {**FILTERS, **(filters or {})}
    run = _run(fold_body(parse(source, known), known), known)

    def render(values: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run(dict(values), out)
        return "".join(out.parts), out.spans

    return render
