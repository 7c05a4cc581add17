"""A small, closed template language for conversations, compiled to closures.

    {{ expression }}                      output
    {% for m in messages %} {% endfor %}  loop.first, loop.last, loop.index0
    {% if a %} {% elif b %} {% else %} {% endif %}
    {% set name = expression %}
    {% generation %} {% endgeneration %}  output that a model learns to write
    {# comment #}                         and {%- -%} to strip white space

Expressions: strings, whole numbers, true, false, none, names, ``m.key``,
``m['key']``, ``a ~ b``, ``+``, comparisons, ``in``, ``and``, ``or``, ``not``,
``a if b else c`` and the filters given to the compiler. A dot is a key of a
mapping, never a Python attribute; nothing can be called, so a template reaches
only what it is given. The text is parsed to a syntax tree, constant parts are
folded, and what is left becomes nested Python functions that yield pieces.
"""

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, fields, replace
from typing import Any


class TemplateError(ValueError):
    """What is wrong with a template, or with the data given to it."""


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """An operator or a filter over its operands."""

    what: str
    args: tuple


@dataclass(frozen=True)
class Choose:
    """``and``, ``or`` and ``if``: operands that may stay unevaluated."""

    what: str
    args: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


OPERATORS: dict[str, Callable] = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "in": lambda a, b: a in b,
    "not in": lambda a, b: a not in b,
    "+": operator.add,
    "~": lambda a, b: _shown(a) + _shown(b),
    "not": operator.not_,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda s: _shown(s).strip(),
    "upper": lambda s: _shown(s).upper(),
    "lower": lambda s: _shown(s).lower(),
    "length": len,
    "default": lambda x, d: d if x is None else x,
}

_TAG = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#-?.*?-?#\}", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<num>[0-9]+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>+~|.()\[\],=]))""",
    re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _shown(x: Any) -> str:
    return "" if x is None else x if isinstance(x, str) else str(x)


class _Expression:
    """Recursive descent over an expression's tokens."""

    def __init__(self, source: str):
        self.source, self.tokens, at = source, [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return None if kind == "str" else text

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted and self.peek() is not None:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing in {self.source!r}")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError(f"a name is missing in {self.source!r}")

    def done(self, value: Any) -> Any:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {self.source!r}")
        return value

    def whole(self) -> Any:
        value = self.either()
        if self.take("if"):
            test = self.either()
            other = self.whole() if self.take("else") else Const(None)
            return Choose("if", (test, value, other))
        return value

    def either(self) -> Any:
        value = self.both()
        while self.take("or"):
            value = Choose("or", (value, self.both()))
        return value

    def both(self) -> Any:
        value = self.negated()
        while self.take("and"):
            value = Choose("and", (value, self.negated()))
        return value

    def negated(self) -> Any:
        if self.take("not"):
            return Apply("not", (self.negated(),))
        value = self.sum()
        while op := self.take("==", "!=", "<", "<=", ">", ">=", "in", "not"):
            if op == "not":
                self.need("in")
                op = "not in"
            value = Apply(op, (value, self.sum()))
        return value

    def sum(self) -> Any:
        value = self.postfix()
        while op := self.take("+", "~"):
            value = Apply(op, (value, self.postfix()))
        return value

    def postfix(self) -> Any:
        value = self.primary()
        while op := self.take(".", "[", "|"):
            if op == ".":
                value = Key(value, Const(self.name()))
            elif op == "[":
                value = Key(value, self.whole())
                self.need("]")
            else:
                what, args = self.name(), [value]
                if self.take("("):
                    args.append(self.whole())
                    while self.take(","):
                        args.append(self.whole())
                    self.need(")")
                value = Apply("|" + what, tuple(args))
        return value

    def primary(self) -> Any:
        if self.take("("):
            value = self.whole()
            self.need(")")
            return value
        if self.at >= len(self.tokens):
            raise TemplateError(f"a value is missing in {self.source!r}")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "num":
            return Const(int(text))
        if kind == "name":
            fixed = {"true": True, "false": False, "none": None}
            return Const(fixed[text]) if text in fixed else Name(text)
        raise TemplateError(f"unexpected {text!r} in {self.source!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts, at, strip = [], 0, False
    for m in _TAG.finditer(source):
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        parts.append(("text", text.rstrip() if m[0][2] == "-" else text))
        if m[1] is not None:
            parts.append(("out", m[1]))
        elif m[2] is not None:
            parts.append(("tag", m[2].strip()))
        at, strip = m.end(), m[0][-3] == "-"
    parts.append(("text", source[at:].lstrip() if strip else source[at:]))
    parts.reverse()

    def block(ends: tuple[str, ...]) -> tuple[tuple, str]:
        body: list = []
        while parts:
            kind, text = parts.pop()
            if kind == "text":
                if text:
                    body.append(Text(text))
                continue
            if kind == "out":
                e = _Expression(text)
                body.append(Output(e.done(e.whole())))
                continue
            word = text.split(None, 1)[0] if text else ""
            if word in ends:
                return tuple(body), text
            e = _Expression(text)
            e.at = 1
            if word == "if":
                body.append(choice(e))
            elif word == "for":
                name = e.name()
                e.need("in")
                over = e.done(e.whole())
                body.append(For(name, over, block(("endfor",))[0]))
            elif word == "set":
                name = e.name()
                e.need("=")
                body.append(Set(name, e.done(e.whole())))
            elif word == "generation":
                e.done(None)
                body.append(Generation(block(("endgeneration",))[0]))
            else:
                raise TemplateError(f"unexpected tag {text!r}")
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tuple(body), ""

    def choice(e: _Expression) -> If:
        test = e.done(e.whole())
        then, end = block(("elif", "else", "endif"))
        if end == "endif":
            return If(test, then, ())
        if end == "else":
            return If(test, then, block(("endif",))[0])
        inner = _Expression(end)
        inner.at = 1
        return If(test, then, (choice(inner),))

    return block(())[0]


class Template:
    """A compiled template; ``filters`` are added to the standard ones."""

    def __init__(self, source: str, filters: Mapping[str, Callable] | None = None):
        self.filters = FILTERS | dict(filters or {})
        self.tree = self._fold_all(parse(source))
        self._run = self._block(self.tree)

    # constant folding

    def _fold(self, node: Any) -> Any:
        if isinstance(node, (Const, Name, Text)):
            return node
        if isinstance(node, (Apply, Choose)):
            if isinstance(node, Apply) and node.what[0] == "|" and node.what[1:] not in self.filters:
                raise TemplateError(f"no filter {node.what[1:]!r}")
            node = replace(node, args=tuple(self._fold(a) for a in node.args))
            first = node.args[0]
            if isinstance(node, Choose) and isinstance(first, Const):
                if node.what == "if":
                    return node.args[1] if first.value else node.args[2]
                return node.args[1] if bool(first.value) == (node.what == "and") else first
            if isinstance(node, Apply) and all(isinstance(a, Const) for a in node.args):
                return Const(self._expression(node)({}))
            return node
        changed = {}
        for f in fields(node):
            old = getattr(node, f.name)
            changed[f.name] = (
                self._fold_all(old) if isinstance(old, tuple) else old if isinstance(old, str) else self._fold(old)
            )
        return replace(node, **changed)

    def _fold_all(self, body: tuple) -> tuple:
        out: list = []
        for node in map(self._fold, body):
            if isinstance(node, Output) and isinstance(node.value, Const):
                node = Text(_shown(node.value.value))
            if isinstance(node, If) and isinstance(node.test, Const):
                inner = node.then if node.test.value else node.other
            else:
                inner = (node,)
            for x in inner:
                if isinstance(x, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].text + x.text)
                elif x != Text(""):
                    out.append(x)
        return tuple(out)

    # closures

    def _expression(self, node: Any) -> Callable[[Mapping], Any]:
        if isinstance(node, Const):
            value = node.value
            return lambda scope: value
        if isinstance(node, Name):
            name = node.name

            def named(scope: Mapping) -> Any:
                if name not in scope:
                    raise TemplateError(f"{name!r} is not defined")
                return scope[name]

            return named
        if isinstance(node, Key):
            of, key = self._expression(node.of), self._expression(node.key)

            def keyed(scope: Mapping) -> Any:
                base, k = of(scope), key(scope)
                if isinstance(base, Mapping) and k in base:
                    return base[k]
                raise TemplateError(f"no key {k!r}")

            return keyed
        args = [self._expression(a) for a in node.args]
        if isinstance(node, Choose):
            a, b = args[:2]
            if node.what == "if":
                c = args[2]
                return lambda scope: b(scope) if a(scope) else c(scope)
            if node.what == "and":
                return lambda scope: a(scope) and b(scope)
            return lambda scope: a(scope) or b(scope)
        f = self.filters[node.what[1:]] if node.what[0] == "|" else OPERATORS[node.what]
        if len(args) == 1:
            one = args[0]
            return lambda scope: f(one(scope))
        return lambda scope: f(*[x(scope) for x in args])

    def _block(self, body: tuple) -> Callable[[dict], Iterator[tuple[str, bool]]]:
        steps = [self._statement(n) for n in body]

        def run(scope: dict) -> Iterator[tuple[str, bool]]:
            for step in steps:
                yield from step(scope)

        return run

    def _statement(self, node: Any) -> Callable[[dict], Iterable[tuple[str, bool]]]:
        if isinstance(node, Text):
            fixed = ((node.text, False),)
            return lambda scope: fixed
        if isinstance(node, Output):
            value = self._expression(node.value)
            return lambda scope: ((_shown(value(scope)), False),)
        if isinstance(node, Set):
            name, value = node.name, self._expression(node.value)

            def assign(scope: dict) -> tuple:
                scope[name] = value(scope)
                return ()

            return assign
        if isinstance(node, If):
            test, then, other = self._expression(node.test), self._block(node.then), self._block(node.other)
            return lambda scope: then(scope) if test(scope) else other(scope)
        if isinstance(node, Generation):
            inner = self._block(node.body)
            return lambda scope: ((text, True) for text, _ in inner(scope))
        name, over, inner = node.name, self._expression(node.over), self._block(node.body)

        def loop(scope: dict) -> Iterator[tuple[str, bool]]:
            items, index, end = iter(over(scope)), 0, object()
            item = next(items, end)
            while item is not end:
                after = next(items, end)  # one ahead, so streams stay streams
                place = {"index0": index, "first": index == 0, "last": after is end}
                yield from inner(scope | {name: item, "loop": place})
                item, index = after, index + 1

        return loop

    def render(self, **values: Any) -> Iterator[tuple[str, bool]]:
        """(text, whether a model learns it) of each piece; ``messages`` may be a
        stream, and pieces come while it is read."""
        return ((text, learned) for text, learned in self._run(dict(values)) if text)
