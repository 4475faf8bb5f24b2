"""A small template language for chat formats, compiled to Python closures.

Source text becomes tokens, tokens a syntax tree, constants in the tree are folded, and every
node that is left becomes one closure. Rendering a conversation only calls closures.

The language: text; ``{{ expression }}``; ``{% for m in messages %}..{% endfor %}`` with
``loop.index``, ``loop.index0``, ``loop.first``, ``loop.last``; ``{% if %}..{% elif %}..{% else %}..
{% endif %}``; ``{% set name = expression %}``; ``{% generation %}..{% endgeneration %}`` around what
a model shall learn to write; ``{# remarks #}``. A ``-`` inside a tag strips the white space beside it.
Expressions have strings, whole numbers, true, false, none, names, fields (``m.role``, ``m['role']``),
``or and not``, comparisons, ``in``, ``+ - * // %`` on numbers, ``~`` (joins texts), ``a if c else b``
and filters: ``trim``, ``upper``, ``lower``, ``length``, ``escape``.

Sandbox: a template reads only the names it is given, only keys of mappings (never attributes of
Python objects), calls nothing but the filters, and loops only over the lists it is given, so that
every template ends. Anything else is a ``TemplateError``.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

MESSAGES = "messages"

#: Tags may be nested this deep, and expressions as well.
DEPTH = 50


class TemplateError(ValueError):
    pass


# --- syntax tree ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Get:
    of: object
    key: object


@dataclass(frozen=True)
class Unary:
    op: str
    of: object


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Choice:
    test: object
    yes: object
    no: object


@dataclass(frozen=True)
class Filter:
    of: object
    name: str


@dataclass(frozen=True)
class Emit:
    of: object


@dataclass(frozen=True)
class If:
    test: object
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class For:
    var: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    of: object


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- escaping ------------------------------------------------------------------------------


class Escape:
    """Reversible escape of control strings: a backslash goes after the first character of every
    place where one begins, and a backslash of the text is doubled. An escaped text holds no control
    string: what looks like one would have begun in the text as well, and has been split there."""

    def __init__(self, controls: Sequence[str]):
        if any(len(c) < 2 or "\\" in c for c in controls):
            raise TemplateError("a control string has two characters or more and no backslash")
        begins = "|".join(re.escape(c) for c in sorted(controls))
        self._mark = re.compile(rf"\\|(?=(?:{begins}))." if controls else r"\\", re.S)

    def __call__(self, text: str) -> str:
        return self._mark.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)

    @staticmethod
    def undo(text: str) -> str:
        return text if "\\" not in text else re.sub(r"\\(\\?)", r"\1", text)


# --- reading a template --------------------------------------------------------------------

_TOKEN = re.compile(
    r"""\s*(?:(?P<close>-?%\}|-?\}\})|(?P<int>\d+)|(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")"""
    r"""|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|//|[-+*%~|.()\[\]<>=]))""", re.S)
_OPEN = re.compile(r"\{\{-?|\{%-?|\{#")
_QUOTED = {"n": "\n", "t": "\t"}
_WORDS = {"true": True, "false": False, "none": None}
_COMPARE = ("==", "!=", "<", "<=", ">", ">=", "in")


def _pieces(source: str):
    """(kind, value) in order: ("text", str), ("emit" or "tag", tokens)."""
    at, strip = 0, False
    while at < len(source):
        found = _OPEN.search(source, at)
        text = source[at:found.start() if found else len(source)]
        text = text.lstrip() if strip else text
        if found is None:
            yield "text", text
            return
        yield "text", text.rstrip() if found[0].endswith("-") else text
        if found[0] == "{#":
            end = source.find("#}", found.end())
            if end < 0:
                raise TemplateError("a remark is not closed")
            at, strip = end + 2, False
            continue
        tokens, at = [], found.end()
        while True:
            token = _TOKEN.match(source, at)
            if token is None:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            at = token.end()
            if token.lastgroup == "close":
                break
            tokens.append((token.lastgroup, token[token.lastgroup]))
        if (found[0][1] == "{") != token["close"].endswith("}}"):
            raise TemplateError("a tag is closed by the other kind's end")
        strip = token["close"].startswith("-")
        yield ("emit" if found[0][1] == "{" else "tag"), tokens


class _Parser:
    """Recursive descent over the tokens of one tag; statements take their bodies from ``pieces``."""

    def __init__(self, source: str):
        self.pieces, self.tokens, self.deep = _pieces(source), [], 0

    def template(self) -> tuple:
        body, end = self.block(())
        return body

    def block(self, ends: tuple[str, ...], in_generation: bool = False) -> tuple[tuple, str | None]:
        """Nodes up to one of the tags ``ends``, and that tag."""
        self.deep += 1
        if self.deep > DEPTH:
            raise TemplateError("nested too deeply")
        nodes = []
        for kind, value in self.pieces:
            if kind == "text":
                nodes.append(Emit(Const(value)))
                continue
            self.tokens = value[::-1]
            if kind == "emit":
                nodes.append(Emit(self.whole()))
                continue
            word = self.name()
            if word in ends:
                self.deep -= 1
                return tuple(nodes), word
            nodes.append(self.statement(word, in_generation))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return tuple(nodes), None

    def statement(self, word: str, inside: bool):
        if word == "if":
            return self.branch(inside)
        if word == "for":
            var = self.name()
            self.take("name", "in")
            over = self.whole()
            return For(var, over, self.body("endfor", inside))
        if word == "set":
            name = self.name()
            self.take("op", "=")
            return Set(name, self.whole())
        if word == "generation":
            self.done()
            if inside:
                raise TemplateError("generation inside generation")
            return Generation(self.body("endgeneration", True))
        raise TemplateError(f"unknown tag {word!r}")

    def branch(self, inside: bool) -> If:
        test = self.whole()
        yes, end = self.block(("elif", "else", "endif"), inside)
        if end == "elif":
            return If(test, yes, (self.branch(inside),))
        self.done()
        return If(test, yes, self.body("endif", inside) if end == "else" else ())

    def body(self, end: str, inside: bool) -> tuple:
        nodes, _ = self.block((end,), inside)
        self.done()
        return nodes

    # tokens
    def peek(self):
        return self.tokens[-1] if self.tokens else (None, None)

    def accept(self, kind: str, *values: str) -> str | None:
        if self.tokens and self.tokens[-1][0] == kind and (not values or self.tokens[-1][1] in values):
            return self.tokens.pop()[1]
        return None

    def take(self, kind: str, *values: str) -> str:
        found = self.accept(kind, *values)
        if found is None:
            raise TemplateError(f"expected {' or '.join(values) or kind}, not {self.peek()[1]!r}")
        return found

    def name(self) -> str:
        return self.take("name")

    def done(self) -> None:
        if self.tokens:
            raise TemplateError(f"unexpected {self.peek()[1]!r}")

    # expressions, loosest first
    def whole(self):
        node = self.choice()
        self.done()
        return node

    def choice(self):
        self.deep += 1
        if self.deep > DEPTH:
            raise TemplateError("nested too deeply")
        node = self.either()
        if self.accept("name", "if"):
            test = self.either()
            self.take("name", "else")
            node = Choice(test, node, self.choice())
        self.deep -= 1
        return node

    def chain(self, kind: str, ops: tuple[str, ...], part: Callable):
        node = part()
        while op := self.accept(kind, *ops):
            node = Binary(op, node, part())
        return node

    def either(self):
        return self.chain("name", ("or",), lambda: self.chain("name", ("and",), self.negated))

    def negated(self):
        turns = 0
        while self.accept("name", "not"):
            turns += 1
        node = self.compared()
        for _ in range(turns):
            node = Unary("not", node)
        return node

    def compared(self):
        node = self.joined()
        op = self.accept("op", *_COMPARE) or self.accept("name", "in")
        return Binary(op, node, self.joined()) if op else node

    def joined(self):
        return self.chain("op", ("~",), lambda: self.chain("op", ("+", "-"), lambda: self.chain("op", ("*", "//", "%"), self.signed)))

    def signed(self):
        return Unary("-", self.filtered()) if self.accept("op", "-") else self.filtered()

    def filtered(self):
        node = self.single()
        while True:
            if self.accept("op", "."):
                node = Get(node, Const(self.name()))
            elif self.accept("op", "["):
                node = Get(node, self.choice())
                self.take("op", "]")
            elif self.accept("op", "|"):
                node = Filter(node, self.name())
            else:
                return node

    def single(self):
        if self.accept("op", "("):
            node = self.choice()
            self.take("op", ")")
            return node
        if (number := self.accept("int")) is not None:
            return Const(int(number))
        if (quoted := self.accept("str")) is not None:
            return Const(re.sub(r"\\(.)", lambda m: _QUOTED.get(m[1], m[1]), quoted[1:-1], flags=re.S))
        name = self.name()
        return Const(_WORDS[name]) if name in _WORDS else Name(name)


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    return _Parser(source).template()


# --- meaning of the expressions ------------------------------------------------------------


def _number(value) -> int:
    if type(value) is not int:
        raise TemplateError(f"not a whole number: {value!r}")
    return value


def _text(value) -> str:
    if value is None:
        return ""
    if type(value) is str:
        return value
    return str(_number(value))


def _get(of, key):
    if isinstance(of, Mapping) and key in of:
        return of[key]
    if isinstance(of, (list, tuple)) and type(key) is int and -len(of) <= key < len(of):
        return of[key]
    raise TemplateError(f"no field {key!r}")


def _contains(part, whole) -> bool:
    if type(whole) is str and type(part) is str or isinstance(whole, (list, tuple, Mapping)):
        return part in whole
    raise TemplateError("in wants a text, a list or a mapping")


def _ordered(compare: Callable) -> Callable:
    def check(a, b):
        if type(a) is not type(b) or type(a) not in (int, str):
            raise TemplateError("only two numbers or two texts have an order")
        return compare(a, b)

    return check


def _whole_division(divide: Callable) -> Callable:
    def check(a, b):
        if _number(b) == 0:
            raise TemplateError("division by zero")
        return divide(_number(a), b)

    return check


_BINARY: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "in": _contains, "~": lambda a, b: _text(a) + _text(b),
    "<": _ordered(operator.lt), "<=": _ordered(operator.le), ">": _ordered(operator.gt), ">=": _ordered(operator.ge),
    "+": lambda a, b: _number(a) + _number(b), "-": lambda a, b: _number(a) - _number(b),
    "*": lambda a, b: _number(a) * _number(b), "//": _whole_division(operator.floordiv), "%": _whole_division(operator.mod),
}
_UNARY: dict[str, Callable] = {"not": operator.not_, "-": lambda a: -_number(a)}


def _filters(escape: Escape) -> dict[str, Callable]:
    return {
        "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(), "lower": lambda v: _text(v).lower(),
        "length": lambda v: len(v) if isinstance(v, (list, tuple, Mapping)) else len(_text(v)),
        "escape": lambda v: escape(_text(v)),
    }


# --- folding -------------------------------------------------------------------------------


def fold(node, constants: Mapping[str, object], filters: Mapping[str, Callable]):
    """The tree with everything computed that depends on constants alone: known names become
    their values, operations on values their results, decided branches replace their tests, and
    neighbouring pieces of text become one."""

    def go(n, known):
        if isinstance(n, Name):
            return Const(known[n.name]) if n.name in known else n
        if isinstance(n, Get):
            return value(_get, (go(n.of, known), go(n.key, known)), lambda of, key: Get(of, key))
        if isinstance(n, Unary):
            return value(_UNARY[n.op], (go(n.of, known),), lambda of: Unary(n.op, of))
        if isinstance(n, Filter):
            if n.name not in filters:
                raise TemplateError(f"unknown filter {n.name!r}")
            return value(filters[n.name], (go(n.of, known),), lambda of: Filter(of, n.name))
        if isinstance(n, Binary):
            left, right = go(n.left, known), go(n.right, known)
            if n.op in ("and", "or"):
                if isinstance(left, Const):
                    return right if bool(left.value) == (n.op == "and") else left
                return Binary(n.op, left, right)
            return value(_BINARY[n.op], (left, right), lambda a, b: Binary(n.op, a, b))
        if isinstance(n, Choice):
            test = go(n.test, known)
            if isinstance(test, Const):
                return go(n.yes if test.value else n.no, known)
            return Choice(test, go(n.yes, known), go(n.no, known))
        return n

    def value(fn, parts, otherwise):
        return Const(fn(*[p.value for p in parts])) if all(isinstance(p, Const) for p in parts) else otherwise(*parts)

    def block(nodes, known):
        """Folded statements; a name that is set or looped over is no constant from there on."""
        known, out = dict(known), []
        for n in nodes:
            if isinstance(n, Emit):
                of = go(n.of, known)
                if isinstance(of, Const):
                    text = _text(of.value)
                    if out and isinstance(out[-1], Emit) and isinstance(out[-1].of, Const):
                        text = out.pop().of.value + text
                    if text:
                        out.append(Emit(Const(text)))
                else:
                    out.append(Emit(of))
            elif isinstance(n, If):
                test = go(n.test, known)
                if isinstance(test, Const):
                    chosen = n.yes if test.value else n.no
                    for part in block(chosen, known):
                        if (isinstance(part, Emit) and isinstance(part.of, Const)
                                and out and isinstance(out[-1], Emit) and isinstance(out[-1].of, Const)):
                            part = Emit(Const(out.pop().of.value + part.of.value))
                        out.append(part)
                else:
                    out.append(If(test, block(n.yes, known), block(n.no, known)))
                for name in _set_in((n,)):
                    known.pop(name, None)
            elif isinstance(n, For):
                over = go(n.over, known)
                inner = {k: v for k, v in known.items() if k not in {n.var, "loop", *_set_in(n.body)}}
                out.append(For(n.var, over, block(n.body, inner)))
            elif isinstance(n, Set):
                out.append(Set(n.name, go(n.of, known)))
                known.pop(n.name, None)
            elif isinstance(n, Generation):
                out.append(Generation(block(n.body, known)))
                for name in _set_in(n.body):
                    known.pop(name, None)
        return tuple(out)

    return block(node, constants)


def _set_in(nodes: tuple) -> set[str]:
    """Names that these statements set, loops (which have their own names) left out."""
    found = set()
    for n in nodes:
        if isinstance(n, Set):
            found.add(n.name)
        elif isinstance(n, If):
            found |= _set_in(n.yes) | _set_in(n.no)
        elif isinstance(n, Generation):
            found |= _set_in(n.body)
    return found


# --- closures ------------------------------------------------------------------------------


class Output:
    """Text written so far and the spans of it that a model shall learn."""

    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)

    def text(self) -> str:
        return "".join(self.parts)


def _expression(node, filters) -> Callable[[dict], object]:
    if isinstance(node, Const):
        constant = node.value
        return lambda env: constant
    if isinstance(node, Name):
        name = node.name

        def read(env):
            if name not in env:
                raise TemplateError(f"unknown name {name!r}")
            return env[name]

        return read
    if isinstance(node, Get):
        of = _expression(node.of, filters)
        key = _expression(node.key, filters)
        return lambda env: _get(of(env), key(env))
    if isinstance(node, (Unary, Filter)):
        fn, of = _UNARY[node.op] if isinstance(node, Unary) else filters[node.name], _expression(node.of, filters)
        return lambda env: fn(of(env))
    if isinstance(node, Choice):
        test, yes, no = (_expression(n, filters) for n in (node.test, node.yes, node.no))
        return lambda env: yes(env) if test(env) else no(env)
    left, right = _expression(node.left, filters), _expression(node.right, filters)
    if node.op == "and":
        return lambda env: left(env) and right(env)
    if node.op == "or":
        return lambda env: left(env) or right(env)
    fn = _BINARY[node.op]
    return lambda env: fn(left(env), right(env))


def _statement(node, filters) -> Callable[[dict, Output], None]:
    if isinstance(node, Emit):
        if isinstance(node.of, Const):
            constant = node.of.value
            return lambda env, out: out.write(constant)
        of = _expression(node.of, filters)
        return lambda env, out: out.write(_text(of(env)))
    if isinstance(node, If):
        test, yes, no = _expression(node.test, filters), _block(node.yes, filters), _block(node.no, filters)
        return lambda env, out: yes(env, out) if test(env) else no(env, out)
    if isinstance(node, Set):
        name, of = node.name, _expression(node.of, filters)

        def assign(env, out):
            env[name] = of(env)

        return assign
    if isinstance(node, Generation):
        body = _block(node.body, filters)

        def mark(env, out):
            start = out.length
            body(env, out)
            if out.length > start:
                out.spans.append((start, out.length))

        return mark
    over, turn = _expression(node.over, filters), _loop(node, filters)

    def each(env, out):
        values = over(env)
        if not isinstance(values, (list, tuple)):
            raise TemplateError("for wants a list")
        for i, value in enumerate(values):
            turn(env, out, value, i, i == len(values) - 1)

    return each


def _loop(node: For, filters) -> Callable:
    """One turn of a loop; what the body sets is gone after it."""
    var, body = node.var, _block(node.body, filters)

    def turn(env, out, value, i: int, last: bool):
        loop = {"index": i + 1, "index0": i, "first": i == 0, "last": last}
        body({**env, var: value, "loop": loop}, out)

    return turn


def _block(nodes: tuple, filters) -> Callable[[dict, Output], None]:
    steps = [_statement(n, filters) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(env, out):
        for step in steps:
            step(env, out)

    return run


def _names(node) -> list[str]:
    """All names that a node reads."""
    if isinstance(node, Name):
        return [node.name]
    if isinstance(node, tuple):
        return [n for part in node for n in _names(part)]
    if hasattr(node, "__dataclass_fields__") and not isinstance(node, Const):
        return [n for f in node.__dataclass_fields__ for n in _names(getattr(node, f))]
    return []


class Template:
    """A compiled template. ``tree`` is the folded syntax tree.

    A template whose messages are read by one loop at the top level and nowhere else is
    ``splittable``: a long conversation can be rendered in runs of turns, each where it lies.
    """

    def __init__(self, source: str, controls: Sequence[str] = (), constants: Mapping[str, object] | None = None):
        filters = _filters(Escape(controls))
        self.tree = fold(parse(source), dict(constants or {}), filters)
        self._render = _block(self.tree, filters)
        loops = [i for i, n in enumerate(self.tree) if isinstance(n, For) and n.over == Name(MESSAGES)]
        self.splittable = len(loops) == 1 and _names(self.tree).count(MESSAGES) == 1
        if self.splittable:
            at = loops[0]
            self._before, self._turn = _block(self.tree[:at], filters), _loop(self.tree[at], filters)
            self._after = _block(self.tree[at + 1:], filters)

    def render(self, messages: Sequence[Mapping]) -> Output:
        out = Output()
        self._render({MESSAGES: list(messages)}, out)
        return out

    def start(self, first: bool) -> tuple[dict, Output]:
        """Names and output for a run of turns; the text before the loop is only written for the
        first run of a conversation."""
        env, out = {}, Output()
        self._before(env, out if first else Output())
        return env, out

    def turn(self, env: dict, out: Output, message: Mapping, index: int, last: bool) -> None:
        self._turn(env, out, message, index, last)

    def end(self, env: dict, out: Output) -> None:
        self._after(env, out)
