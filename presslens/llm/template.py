"""A sandboxed template language, compiled to Python generators.

    {{ expression }}                      output
    {% for x in list %} ... {% endfor %}  with loop.first, loop.last and loop.index0
    {% if a %} ... {% elif b %} ... {% else %} ... {% endif %}
    {% set name = expression %}
    {% generation %} ... {% endgeneration %}   marks text that the model is to learn
    {# comment #}, and a dash inside a tag strips white space on that side

Expressions know strings, whole numbers, true, false, none, names, x.key, x['key'], + ~ == !=
in, not, and, or, parentheses and the filters given to `compile_template`. Keys are looked
up in mappings only and nothing can be called, so a template reaches nothing but its data.

Parsing gives a syntax tree of tuples; constant parts are folded; every node becomes a closure.
A compiled template yields (text, learnt) pieces one after the other, and a loop looks one
element ahead, so a list may be an iterator of any length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping

_TAG = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.DOTALL)
_LEXEME = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|(\w+)|(==|!=|[()\[\].|+~=]))""", re.DOTALL)
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
_END = ("", "end")


class TemplateError(ValueError):
    """The template does not parse, or names something that it may not reach."""


def _lex(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _LEXEME.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        kind = ("string", "number", "name", "sign")[m.lastindex - 1]
        text = m[m.lastindex]
        if kind == "string":
            text = re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[0]), text[1:-1], flags=re.DOTALL)
        out.append((text, kind))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over the lexemes of one expression."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.left, self.filters = _lex(source), filters

    def peek(self) -> tuple[str, str]:
        return self.left[0] if self.left else _END

    def take(self, *signs: str) -> str | None:
        text, kind = self.peek()
        if text in signs and kind in ("sign", "name"):
            self.left.pop(0)
            return text
        return None

    def need(self, kind: str, text: str | None = None) -> str:
        got = self.peek()
        if got[1] != kind or text not in (None, got[0]):
            raise TemplateError(f"{text or kind} wanted before {got[0]!r}")
        self.left.pop(0)
        return got[0]

    def whole(self) -> tuple:
        tree = self.either()
        if self.left:
            raise TemplateError(f"{self.left[0][0]!r} left over")
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.joined()
        while sign := self.take("==", "!=", "in", "not"):
            if sign == "not":
                self.need("name", "in")
                tree = ("not", ("in", tree, self.joined()))
            else:
                tree = (sign, tree, self.joined())
        return tree

    def joined(self) -> tuple:
        tree = self.filtered()
        while sign := self.take("+", "~"):
            tree = (sign, tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.member()
        while self.take("|"):
            name = self.need("name")
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def member(self) -> tuple:
        tree = self.atom()
        while sign := self.take(".", "["):
            if sign == ".":
                tree = ("key", tree, ("constant", self.need("name")))
            else:
                tree = ("key", tree, self.either())
                self.need("sign", "]")
        return tree

    def atom(self) -> tuple:
        if self.take("("):
            tree = self.either()
            self.need("sign", ")")
            return tree
        text, kind = self.peek()
        if kind in ("end", "sign"):
            raise TemplateError(f"value wanted before {text!r}")
        self.left.pop(0)
        if kind == "string":
            return ("constant", text)
        if kind == "number":
            return ("constant", int(text))
        fixed = {"true": True, "false": False, "none": None}
        return ("constant", fixed[text]) if text in fixed else ("name", text)


def parse(source: str, filters: Mapping[str, Callable]) -> list[tuple]:
    """Syntax tree of a template: a list of statements."""
    pieces: list[tuple[str, str]] = []
    at, strip = 0, False
    for m in _TAG.finditer(source):
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        text = text.rstrip() if m[0].startswith("-", 2) else text
        pieces.append(("text", text))
        if m[1] is not None:
            pieces.append(("output", m[1]))
        elif m[2] is not None:
            pieces.append(("tag", m[2].strip()))
        at, strip = m.end(), m[0].endswith(("-}}", "-%}"))
    pieces.append(("text", source[at:].lstrip() if strip else source[at:]))

    def expression(text: str) -> tuple:
        return _Expression(text, filters).whole()

    def block(*ends: str) -> tuple[list[tuple], str]:
        body: list[tuple] = []
        while pieces:
            kind, text = pieces.pop(0)
            if kind == "text":
                body.append(("text", text))
            elif kind == "output":
                body.append(("output", expression(text)))
            else:
                word, _, rest = text.partition(" ")
                if word in ends:
                    return body, text
                body.append(statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[0]} is missing")
        return body, ""

    def statement(word: str, rest: str) -> tuple:
        if word == "generation":
            return ("generation", block("endgeneration")[0])
        if word == "set":
            name, _, value = rest.partition("=")
            if not name.strip().isidentifier():
                raise TemplateError(f"cannot set {name!r}")
            return ("set", name.strip(), expression(value))
        if word == "for":
            m = re.fullmatch(r"(\w+)\s+in\s+(.*)", rest.strip(), re.DOTALL)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            return ("for", m[1], expression(m[2]), block("endfor")[0])
        if word == "if":
            body, end = block("elif", "else", "endif")
            if end.startswith("elif"):
                return ("if", expression(rest), body, [statement("if", end[4:])])
            other = block("endif")[0] if end == "else" else []
            return ("if", expression(rest), body, other)
        raise TemplateError(f"no statement {word!r}")

    return block()[0]


def fold(tree: tuple) -> tuple:
    """The tree with constant expressions replaced by their values."""
    if tree[0] in ("constant", "name", "text", "filter_"):
        return tree
    folded = tuple(fold(t) if isinstance(t, tuple) else t for t in tree)
    values = [t[1] for t in folded[1:] if isinstance(t, tuple) and t[0] == "constant"]
    if len(values) == sum(isinstance(t, tuple) for t in folded[1:]):
        sign = folded[0]
        if sign == "not":
            return ("constant", not values[0])
        if sign in _BINARY:
            return ("constant", _combined(sign, *values))
    if folded[0] in ("and", "or") and folded[1][0] == "constant":
        decided = bool(folded[1][1]) == (folded[0] == "or")
        return folded[1] if decided else folded[2]
    return folded


_BINARY = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b,
    "+": lambda a, b: a + b,
    "~": lambda a, b: f"{_shown(a)}{_shown(b)}",
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}


def _combined(sign: str, a, b):
    try:
        return _BINARY[sign](a, b)
    except TypeError as e:
        raise TemplateError(f"{sign!r} does not fit its values: {e}") from e


def _shown(value) -> str:
    return "" if value is None else str(value)


def _value(tree: tuple, filters: Mapping[str, Callable]) -> Callable[[dict], object]:
    """Closure that evaluates an expression."""
    kind = tree[0]
    if kind == "constant":
        return lambda env, value=tree[1]: value
    if kind == "name":
        def name(env, key=tree[1]):
            if key not in env:
                raise TemplateError(f"{key!r} is not set")
            return env[key]

        return name
    if kind == "filter":
        apply, inner = filters[tree[1]], _value(tree[2], filters)
        return lambda env: apply(inner(env))
    if kind == "key":
        inner, key = _value(tree[1], filters), _value(tree[2], filters)

        def member(env):
            holder = inner(env)
            if not isinstance(holder, Mapping):
                raise TemplateError("only mappings have keys")
            try:
                return holder.get(key(env))
            except TypeError as e:
                raise TemplateError("a key is a text or a number") from e

        return member
    if kind == "not":
        inner = _value(tree[1], filters)
        return lambda env: not inner(env)
    left, right = _value(tree[1], filters), _value(tree[2], filters)
    if kind == "and":
        return lambda env: left(env) and right(env)
    if kind == "or":
        return lambda env: left(env) or right(env)
    return lambda env: _combined(kind, left(env), right(env))


Piece = tuple[str, bool]
Writer = Callable[[dict, bool], Iterator[Piece]]


def _ahead(items: Iterable) -> Iterator[tuple[object, bool]]:
    """Elements with whether they are the last."""
    try:
        items = iter(items)
    except TypeError as e:
        raise TemplateError("a loop needs a list") from e
    for item in items:
        for following in items:
            yield item, False
            item = following
        yield item, True


def _body(statements: list[tuple], filters: Mapping[str, Callable]) -> Writer:
    writers: list[Writer] = []
    text = ""

    def flush() -> None:
        nonlocal text
        if text:
            writers.append(lambda env, learnt, piece=text: iter(((piece, learnt),)))
        text = ""

    for statement in statements:
        kind = statement[0]
        if kind == "text":
            text += statement[1]
            continue
        if kind == "output":
            tree = fold(statement[1])
            if tree[0] == "constant":  # joins the text around it
                text += _shown(tree[1])
                continue
        flush()
        writers.append(_writer(statement, filters))
    flush()

    def write(env: dict, learnt: bool) -> Iterator[Piece]:
        for writer in writers:
            yield from writer(env, learnt)

    return write


def _writer(statement: tuple, filters: Mapping[str, Callable]) -> Writer:
    kind = statement[0]
    if kind == "output":
        value = _value(fold(statement[1]), filters)
        return lambda env, learnt: iter(((_shown(value(env)), learnt),))
    if kind == "set":
        name, value = statement[1], _value(fold(statement[2]), filters)

        def assign(env: dict, learnt: bool) -> Iterator[Piece]:
            env[name] = value(env)
            return iter(())

        return assign
    if kind == "generation":
        body = _body(statement[1], filters)

        def generation(env: dict, learnt: bool) -> Iterator[Piece]:
            yield "", True  # a mark even where nothing is written
            yield from body(env, True)
            yield "", False

        return generation
    if kind == "if":
        tree = fold(statement[1])
        then, other = _body(statement[2], filters), _body(statement[3], filters)
        if tree[0] == "constant":
            return then if tree[1] else other
        test = _value(tree, filters)
        return lambda env, learnt: (then if test(env) else other)(env, learnt)
    name, items = statement[1], _value(fold(statement[2]), filters)
    body = _body(statement[3], filters)

    def loop(env: dict, learnt: bool) -> Iterator[Piece]:
        outer = {k: env[k] for k in (name, "loop") if k in env}
        for i, (item, last) in enumerate(_ahead(items(env))):
            env[name] = item
            env["loop"] = {"first": i == 0, "last": last, "index0": i}
            yield from body(env, learnt)
        env.pop(name, None), env.pop("loop", None)
        env.update(outer)

    return loop


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[[dict], Iterator[Piece]]:
    """Function from data to the pieces (text, learnt) of the rendered template."""
    filters = filters or {}
    try:
        write = _body(parse(source, filters), filters)
    except RecursionError as e:
        raise TemplateError("the template is nested too deeply") from e
    return lambda data: write(dict(data), False)
