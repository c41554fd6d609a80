"""Chat formatting: a compiler for a small sandboxed template language.

``compile_template`` parses a template into a syntax tree, folds constants (operators and filters over literals, ``if``
over a literal, neighbouring literal text) and generates Python closures; no Python source is made and nothing of
Python can be reached: names are the given variables and loop variables, a dot looks up keys of mappings only.

    {{ expression }}   {% set x = ... %}   {% generation %} ... {% endgeneration %}
    {% for x in ... %} ... {% endfor %}    {% if ... %} ... {% elif ... %} ... {% else %} ... {% endif %}

Expressions: strings, whole numbers, true/false/none, names, ``a.b``, ``a[b]``, ``not and or == != < <= > >= in + - ~``,
parentheses, filters ``trim upper lower length string``; loops know ``loop.index``, ``loop.first`` and ``loop.last``.
Text inside ``generation`` is under the loss mask.  Loops take ``MAX_STEPS`` steps in all, and ``LOOPS`` more for each element
of the lists given, so loops within loops end while a conversation of any number of turns is rendered.

Texts and roles are escaped: a backslash is doubled, and one is put behind the first character wherever a control
string starts, so no control string of the template stands in a text and ``unescape`` gives the text back.

``format_conversations`` sorts turns within partitions and renders conversation by conversation as rows stream by.

Defined results: null text and null role are empty; turns are ordered by turn, then role, then text (nulls first), and
repeated rows are turns of their own; rows with a null conv_id make up one conversation; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks of the default template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[TEXT]", "[/ROLE]")
TEMPLATE = (
    "{{ '<s>' }}{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text }} [/INST]"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text }}{% endgeneration %}</s>"
    "{% else %}[ROLE] {{ m.role }} [TEXT] {{ m.text }} [/ROLE]{% endif %}"
    "{% endfor %}"
)
MAX_STEPS, LOOPS = 10_000_000, 16


class TemplateError(ValueError):
    pass


# --- syntax tree: tuples of a kind and parts -----------------------------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~<>().,|\[\]]))")
_WORDS = {"true": True, "false": False, "none": None}
_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, Any]] = []
        at = 0
        source = source.rstrip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            number, text, name, sign = found.groups()
            if number:
                self.tokens.append(("value", int(number)))
            elif text:
                self.tokens.append(("value", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S)))
            elif name and name.lower() in _WORDS and name in (name.lower(), name.capitalize()):
                self.tokens.append(("value", _WORDS[name.lower()]))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
            at = found.end()
        self.at = 0

    def take(self, *words: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "value" and self.tokens[self.at][1] in words:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self) -> tuple:
        tree = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
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
        tree = self.summed()
        while sign := self.take("==", "!=", "<", "<=", ">", ">=", "in"):
            tree = ("binary", sign, tree, self.summed())
        return tree

    def summed(self) -> tuple:
        tree = self.postfixed()
        while sign := self.take("+", "-", "~"):
            tree = ("binary", sign, tree, self.postfixed())
        return tree

    def postfixed(self) -> tuple:
        tree = self.atom()
        while sign := self.take(".", "[", "|"):
            if sign == "[":
                tree = ("item", tree, self.either())
                if not self.take("]"):
                    raise TemplateError("missing ]")
                continue
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name":
                raise TemplateError(f"a name must follow {sign}")
            self.at += 1
            tree = ("item", tree, ("value", name)) if sign == "." else ("filter", name, tree)
        return tree

    def atom(self) -> tuple:
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return tree
        if self.at >= len(self.tokens) or self.tokens[self.at][0] == "sign":
            raise TemplateError("an expression ends too early")
        kind, what = self.tokens[self.at]
        self.at += 1
        return (kind, what)


def parse(source: str) -> tuple:
    """("block", parts) of a template."""
    frames: list[list] = [["block", []]]  # open statements: kind, parts of the branch being read, more

    def close(kind: str) -> list:
        if frames[-1][0] != kind:
            raise TemplateError(f"end of {kind} inside of {frames[-1][0]}")
        return frames.pop()

    at = 0
    for tag in _TAG.finditer(source):
        if tag.start() > at:
            frames[-1][1].append(("text", source[at : tag.start()]))
        at = tag.end()
        if tag[1] is not None:
            frames[-1][1].append(("print", _Expression(tag[1]).whole()))
            continue
        if tag[2] is None:
            continue
        word, _, rest = tag[2].strip().partition(" ")
        if word == "for":
            found = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not found:
                raise TemplateError(f"for {rest}")
            frames.append(["for", [], found[1], _Expression(found[2]).whole()])
        elif word == "if":
            frames.append(["if", [], [], _Expression(rest).whole()])
        elif word in ("elif", "else"):
            frame = frames[-1]
            if frame[0] != "if" or frame[3] is None:
                raise TemplateError(f"{word} without if")
            frame[2].append((frame[3], ("block", tuple(frame[1]))))
            frame[1], frame[3] = [], _Expression(rest).whole() if word == "elif" else None
        elif word == "set":
            name, _, value = rest.partition("=")
            if not name.strip().isidentifier():
                raise TemplateError(f"set {rest}")
            frames[-1][1].append(("set", name.strip(), _Expression(value).whole()))
        elif word == "generation":
            frames.append(["generation", []])
        elif word == "endfor":
            _, parts, name, over = close("for")
            frames[-1][1].append(("for", name, over, ("block", tuple(parts))))
        elif word == "endif":
            _, parts, branches, test = close("if")
            branches = [*branches, (("value", True) if test is None else test, ("block", tuple(parts)))]
            frames[-1][1].append(("if", tuple(branches)))
        elif word == "endgeneration":
            _, parts = close("generation")
            frames[-1][1].append(("generation", ("block", tuple(parts))))
        else:
            raise TemplateError(f"unknown statement {word}")
    if at < len(source):
        frames[-1][1].append(("text", source[at:]))
    return ("block", tuple(close("block")[1]))


# --- constant folding -----------------------------------------------------------------------------------------------


def _text(value: Any) -> str:
    return "" if value is None else str(value)


_FILTERS: dict[str, Callable] = {"trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(), "length": lambda x: 0 if x is None else len(x), "string": _text}
_BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b, "+": lambda a, b: a + b, "-": lambda a, b: a - b, "~": lambda a, b: _text(a) + _text(b),
}


def _applied(function: Callable, *values: Any) -> Any:
    try:
        return function(*values)
    except TypeError as e:
        raise TemplateError(str(e)) from e


def fold(tree: tuple) -> tuple:
    """An equal tree in which what depends on literals only is a literal."""
    kind = tree[0]
    if kind == "block":
        parts: list[tuple] = []
        for part in map(fold, tree[1]):
            for piece in part[1] if part[0] == "block" else (part,):
                if piece[0] == "text" and parts and parts[-1][0] == "text":
                    parts[-1] = ("text", parts[-1][1] + piece[1])
                elif piece != ("text", ""):
                    parts.append(piece)
        return ("block", tuple(parts))
    if kind == "print":
        value = fold(tree[1])
        return ("text", _text(value[1])) if value[0] == "value" else ("print", value)
    if kind == "if":
        branches = []
        for test, body in tree[1]:
            test, body = fold(test), fold(body)
            if test[0] == "value":
                if test[1]:
                    branches.append((test, body))
                    break
                continue
            branches.append((test, body))
        if not branches:
            return ("block", ())
        return branches[0][1] if branches[0][0][0] == "value" else ("if", tuple(branches))
    if kind == "for":
        return ("for", tree[1], fold(tree[2]), fold(tree[3]))
    if kind in ("generation", "not"):
        inner = fold(tree[1])
        return ("value", not inner[1]) if kind == "not" and inner[0] == "value" else (kind, inner)
    if kind == "set":
        return ("set", tree[1], fold(tree[2]))
    if kind in ("and", "or"):
        left, right = fold(tree[1]), fold(tree[2])
        if left[0] == "value":
            return right if bool(left[1]) == (kind == "and") else left
        return (kind, left, right)
    if kind == "binary":
        left, right = fold(tree[2]), fold(tree[3])
        if left[0] == right[0] == "value":
            return ("value", _applied(_BINARY[tree[1]], left[1], right[1]))
        return ("binary", tree[1], left, right)
    if kind == "filter":
        if tree[1] not in _FILTERS:
            raise TemplateError(f"unknown filter {tree[1]}")
        inner = fold(tree[2])
        return ("value", _applied(_FILTERS[tree[1]], inner[1])) if inner[0] == "value" else ("filter", tree[1], inner)
    if kind == "item":
        return ("item", fold(tree[1]), fold(tree[2]))
    return tree


# --- closures -------------------------------------------------------------------------------------------------------


class _Output:
    def __init__(self, steps: int) -> None:
        self.parts: list[tuple[str, bool]] = []
        self.under_loss = False
        self.steps = steps  # that loops may still take

    def put(self, text: str) -> None:
        if text:
            self.parts.append((text, self.under_loss))


def _value(tree: tuple) -> Callable[[dict], Any]:
    kind = tree[0]
    if kind == "value":
        constant = tree[1]
        return lambda scope: constant
    if kind == "name":
        name = tree[1]
        return lambda scope: scope.get(name)
    if kind == "not":
        inner = _value(tree[1])
        return lambda scope: not inner(scope)
    if kind in ("and", "or"):
        left, right = _value(tree[1]), _value(tree[2])
        return (lambda scope: left(scope) and right(scope)) if kind == "and" else (lambda scope: left(scope) or right(scope))
    if kind == "binary":
        function, left, right = _BINARY[tree[1]], _value(tree[2]), _value(tree[3])
        return lambda scope: _applied(function, left(scope), right(scope))
    if kind == "filter":
        function, inner = _FILTERS[tree[1]], _value(tree[2])
        return lambda scope: _applied(function, inner(scope))
    of, key = _value(tree[1]), _value(tree[2])

    def item(scope: dict) -> Any:
        holder, what = of(scope), key(scope)
        if isinstance(holder, dict):
            return holder.get(what)
        if isinstance(holder, (list, tuple, str)) and isinstance(what, int):
            return holder[what] if -len(holder) <= what < len(holder) else None
        return None

    return item


def _statement(tree: tuple) -> Callable[[dict, _Output], None]:
    kind = tree[0]
    if kind == "block":
        steps = [_statement(part) for part in tree[1]]

        def block(scope: dict, out: _Output) -> None:
            for step in steps:
                step(scope, out)

        return block
    if kind == "text":
        text = tree[1]
        return lambda scope, out: out.put(text)
    if kind == "print":
        value = _value(tree[1])
        return lambda scope, out: out.put(_text(value(scope)))
    if kind == "set":
        name, value = tree[1], _value(tree[2])
        return lambda scope, out: scope.__setitem__(name, value(scope))
    if kind == "if":
        branches = [(_value(test), _statement(body)) for test, body in tree[1]]

        def choose(scope: dict, out: _Output) -> None:
            for test, body in branches:
                if test(scope):
                    body(scope, out)
                    return

        return choose
    if kind == "generation":
        body = _statement(tree[1])

        def under_loss(scope: dict, out: _Output) -> None:
            before, out.under_loss = out.under_loss, True
            body(scope, out)
            out.under_loss = before

        return under_loss
    name, over, body = tree[1], _value(tree[2]), _statement(tree[3])

    def loop(scope: dict, out: _Output) -> None:
        items = over(scope) or []
        inner = dict(scope)
        for i, item in enumerate(items):
            out.steps -= 1
            if out.steps < 0:
                raise TemplateError("too many loop steps")
            inner[name], inner["loop"] = item, {"index": i + 1, "first": i == 0, "last": i == len(items) - 1}
            body(inner, out)

    return loop


def compile_template(source: str) -> Callable[..., list[tuple[str, bool]]]:
    """A function of variables that gives pieces of text and whether each is under the loss mask."""
    run = _statement(fold(parse(source)))

    def render(**variables: Any) -> list[tuple[str, bool]]:
        out = _Output(MAX_STEPS + LOOPS * sum(len(v) for v in variables.values() if isinstance(v, (list, tuple))))
        run(dict(variables), out)
        return out.parts

    return render


# --- escaping, formatting and reading back --------------------------------------------------------------------------


def escaper(controls: tuple[str, ...]) -> Callable[[str], str]:
    starts = re.compile("(?:" + "|".join(f"(?={re.escape(c)})" for c in controls) + ")(.)", re.S) if controls else None

    def escape(text: str) -> str:
        text = text.replace("\\", "\\\\")
        return starts.sub(r"\1\\", text) if starts else text

    return escape


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of what the default template made."""
    marks = re.compile(r"\[INST\] (.*?) \[/INST\]|\[ROLE\] (.*?) \[TEXT\] (.*?) \[/ROLE\]|(.*?)</s>", re.S)
    out, at = [], len("<s>")
    while at < len(formatted):
        found = marks.match(formatted, at)
        if not found:
            raise ValueError("not made by this template")
        user, role, text, assistant = found.groups()
        turn = ("user", user) if user is not None else (role, text) if role is not None else ("assistant", assistant)
        out.append((unescape(turn[0]), unescape(turn[1])))
        at = found.end()
    return out


class Formatted(NamedTuple):
    text: str
    loss: list[tuple[int, int]]  # code point spans under the loss mask, one per generation


def formatter(template: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS) -> Callable[[list[tuple[str, str]]], Formatted]:
    render, escape = compile_template(template), escaper(controls)

    def form(turns: list[tuple[str, str]]) -> Formatted:
        pieces, at, spans = render(messages=[{"role": escape(r), "text": escape(t)} for r, t in turns]), 0, []
        for text, under_loss in pieces:
            if under_loss:
                spans.append((at, at + len(text)))
            at += len(text)
        return Formatted("".join(t for t, _ in pieces), spans)

    return form


def _stream(batches: Iterator[pa.RecordBatch], template: str, controls: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    form, rows, size = formatter(template, controls), [], 0

    def made() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["conv_id", "formatted", "loss_spans"])

    none = object()
    now, turns = none, []
    for batch in batches:
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv != now:
                if now is not none:
                    out = form(turns)
                    rows.append((now, out.text, [list(s) for s in out.loss]))
                    size += len(out.text)
                now, turns = conv, []
            turns.append((role or "", text or ""))
            if size > 1 << 22:
                yield made()
                rows, size = [], 0
    if now is not none:
        out = form(turns)
        rows.append((now, out.text, [list(s) for s in out.loss]))
    if rows:
        yield made()


def format_conversations(turns: DataFrame, template: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """conv_id, formatted, loss_spans ([from, to) in code points) of each conversation."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return rows.mapInArrow(lambda b: _stream(b, template, controls), "conv_id long, formatted string, loss_spans array<array<long>>")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, formatted, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            turns = read_back(formatted)
            whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
            loss = "".join(unescape(formatted[a:b]) for a, b in spans)
            rows.append((conv, len(turns), whole, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = [pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(formatted: DataFrame) -> DataFrame:
    """What the default template's output says, read back from it."""
    return formatted.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
