"""User message templates, compiled to one native string column.

A template is text with actions between ``{{`` and ``}}``:

* ``{{.Field}}``, ``{{$var}}``, ``{{.}}`` (in ``range``: the element), strings, numbers, ``true``, ``false``;
* calls, ``{{md .Role}}``, ``{{index .OriginalLinks 0}}``, with parentheses and pipes;
* ``{{$x := ...}}``, valid to the end of its block;
* ``{{if ...}} ... {{else if ...}} ... {{else}} ... {{end}}``: empty strings and lists, 0 and false do not hold;
* ``{{range .List}}``, ``{{range $v := .List}}``, ``{{range $i, $v := .List}}``, each with ``{{else}}``;
* ``{{/* comments */}}``; ``{{-`` and ``-}}`` trim the white space before and behind.

Functions: ``md``, ``tgtag``, ``index``, ``len``, ``eq``, ``ne``, ``and``, ``or``, ``not``.  A template that
is not of this form, or names a field or function that is not there, raises
``TemplateError`` when it is compiled, before any job starts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import text as T

_ACTION = re.compile(r'\{\{(?P<l>-(?=\s))?(?P<body>(?:/\*.*?\*/|"(?:\\.|[^"\\\n])*"|`[^`]*`|[^"`}]|\}(?!\}))*?)(?P<r>(?<=\s)-)?\}\}', re.S)
_TOKEN = re.compile(r'\s*(?:(?P<str>"(?:\\.|[^"\\\n])*"|`[^`]*`)|(?P<num>-?\d+)|(?P<var>\$\w*)|(?P<field>\.\w*)|(?P<word>\w+)|(?P<sym>:=|[|(),=]))')


class TemplateError(ValueError):
    """The template cannot be compiled."""


class Value(NamedTuple):
    """A column with its kind: string, int, bool or list (of strings)."""

    col: Column
    kind: str


class Node(NamedTuple):
    """text, print, let, if or range, with what it holds."""

    kind: str
    args: tuple
    then: list = []
    other: list = []


# ------------------------------------------------------------------ parsing
def _actions(source: str):
    """Texts and actions in order, white space trimmed where asked for."""
    at, trim, out = 0, False, []
    for m in _ACTION.finditer(source):
        text = source[at:m.start()]
        text = text.lstrip(" \t\r\n") if trim else text
        text = text.rstrip(" \t\r\n") if m.group("l") else text
        if "{{" in text:
            raise TemplateError(f"unclosed action near {text[text.index('{{'):][:30]!r}")
        out.append(("text", text))
        body = m.group("body").strip()
        if not (body.startswith("/*") and body.endswith("*/")):
            out.append(("action", body))
        at, trim = m.end(), bool(m.group("r"))
    rest = source[at:]
    if "{{" in rest:
        raise TemplateError(f"unclosed action near {rest[rest.index('{{'):][:30]!r}")
    return out + [("text", rest.lstrip(" \t\r\n") if trim else rest)]


def _tokens(body: str) -> list[tuple[str, str]]:
    out, at = [], 0
    body = body.rstrip()
    while at < len(body):
        m = _TOKEN.match(body, at)
        if not m:
            raise TemplateError(f"unexpected {body[at:at + 20]!r} in {body!r}")
        out.append((m.lastgroup, m.group(m.lastgroup)))
        at = m.end()
    return out


class _Parser:
    def __init__(self, source: str):
        self.items, self.at = _actions(source), 0

    def block(self, ends: tuple[str, ...]) -> tuple[list[Node], str, list]:
        """Nodes up to an action that starts with one of ``ends``; that word and what follows it."""
        out: list[Node] = []
        while self.at < len(self.items):
            kind, value = self.items[self.at]
            self.at += 1
            if kind == "text":
                if value:
                    out.append(Node("text", (value,)))
                continue
            tokens = _tokens(value)
            if not tokens:
                raise TemplateError("empty action")
            word = tokens[0][1] if tokens[0][0] == "word" else ""
            if word in ("end", "else"):
                if word not in ends or (word == "end" and len(tokens) > 1):
                    raise TemplateError(f"unexpected {{{{{value}}}}}")
                return out, word, tokens[1:]
            if word == "if":
                out.append(self.branch(tokens[1:]))
            elif word == "range":
                out.append(self.loop(tokens[1:]))
            elif tokens[0][0] == "var" and tokens[1:2] == [("sym", ":=")]:
                out.append(Node("let", (self.name(tokens[0]), self.pipeline(tokens[2:]))))
            else:
                out.append(Node("print", (self.pipeline(tokens),)))
        if ends:
            raise TemplateError("a block has no {{end}}")
        return out, "", []

    def branch(self, tokens) -> Node:
        then, word, rest = self.block(("else", "end"))
        other: list[Node] = []
        if word == "else":
            if rest and rest[0] == ("word", "if"):
                other = [self.branch(rest[1:])]
            elif rest:
                raise TemplateError("unexpected words behind else")
            else:
                other = self.block(("end",))[0]
        return Node("if", (self.pipeline(tokens),), then, other)

    def loop(self, tokens) -> Node:
        names: tuple[str, ...] = ()
        if ("sym", ":=") in tokens:
            cut = tokens.index(("sym", ":="))
            head, tokens = tokens[:cut], tokens[cut + 1:]
            if len(head) not in (1, 3) or (len(head) == 3 and head[1] != ("sym", ",")):
                raise TemplateError("range declares one or two variables")
            names = tuple(self.name(t) for t in head[::2])
        then, word, rest = self.block(("else", "end"))
        if rest:
            raise TemplateError("unexpected words behind else")
        return Node("range", (names, self.pipeline(tokens)), then, self.block(("end",))[0] if word == "else" else [])

    @staticmethod
    def name(token) -> str:
        if token[0] != "var" or token[1] == "$":
            raise TemplateError(f"{token[1]!r} is no variable name")
        return token[1]

    def pipeline(self, tokens) -> tuple:
        """``("call", name, args)`` or a leaf, of all ``tokens``."""
        tree, rest = self._pipe(tokens)
        if rest:
            raise TemplateError(f"unexpected {rest[0][1]!r}")
        return tree

    def _pipe(self, tokens):
        tree, tokens = self._command(tokens, None)
        while tokens and tokens[0] == ("sym", "|"):
            tree, tokens = self._command(tokens[1:], tree)
        return tree, tokens

    def _command(self, tokens, piped):
        args = []
        name = tokens[0][1] if tokens and tokens[0][0] == "word" and tokens[0][1] not in ("true", "false") else None
        tokens = tokens[1:] if name else tokens
        while tokens and tokens[0] not in (("sym", "|"), ("sym", ")")):
            kind, value = tokens[0]
            if (kind, value) == ("sym", "("):
                tree, tokens = self._pipe(tokens[1:])
                if not tokens or tokens[0] != ("sym", ")"):
                    raise TemplateError("missing )")
                args.append(tree)
            elif kind == "sym":
                raise TemplateError(f"unexpected {value!r}")
            else:
                if kind == "word" and value not in ("true", "false"):  # a function without arguments
                    raise TemplateError(f"{value!r} cannot be an argument")
                args.append((kind, value))
            tokens = tokens[1:]
        if name:
            return ("call", name, [*args, *([piped] if piped else [])]), tokens
        if len(args) != 1 or piped:
            raise TemplateError("a value is missing" if not args else "only functions take arguments")
        return args[0], tokens


# --------------------------------------------------------------- compiling
def column_name(field: str) -> str:
    """``SourceURL`` -> ``source_url``."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", field).lower()


def _truth(v: Value) -> Column:
    c = {"string": lambda: v.col != "", "int": lambda: v.col != 0, "bool": lambda: v.col, "list": lambda: F.size(v.col) > 0}[v.kind]()
    return F.coalesce(c, F.lit(False))


def _shown(v: Value) -> Column:
    if v.kind == "list":
        raise TemplateError("a list cannot be printed; use range")
    if v.kind == "bool":
        return F.when(_truth(v), "true").otherwise("false")
    return F.coalesce(v.col, F.lit("")) if v.kind == "string" else F.coalesce(v.col.cast("string"), F.lit("0"))


def _need(name: str, args: list[Value], *kinds: str) -> None:
    if len(args) != len(kinds) or any(k not in ("any", v.kind) for v, k in zip(args, kinds)):
        raise TemplateError(f"{name} takes ({', '.join(kinds)}), not ({', '.join(v.kind for v in args)})")


def _string_call(fn: Callable[[Column], Column]):
    def call(name, args):
        _need(name, args, "string")
        return Value(fn(_shown(args[0])), "string")
    return call


def _index(name, args):
    _need(name, args, "list", "int")
    return Value(F.get(args[0].col, args[1].col), "string")


def _len(name, args):
    _need(name, args, "list" if args and args[0].kind == "list" else "string")
    return Value(F.size(args[0].col) if args[0].kind == "list" else F.octet_length(_shown(args[0])), "int")


def _equal(negate: bool):
    def call(name, args):
        if len(args) != 2 or args[0].kind != args[1].kind or args[0].kind == "list":
            raise TemplateError(f"{name} compares two values of one kind")
        same = _shown(args[0]) == _shown(args[1])
        return Value(~same if negate else same, "bool")
    return call


def _choice(stop_at: bool):
    def call(name, args):
        if not args:
            raise TemplateError(f"{name} takes values")
        if len({a.kind for a in args}) > 1:  # a condition, not a value
            args = [Value(_truth(a), "bool") for a in args]
        out = args[-1].col
        for a in reversed(args[:-1]):
            out = F.when(_truth(a) if stop_at else ~_truth(a), a.col).otherwise(out)
        return Value(out, args[0].kind)
    return call


def _not(name, args):
    _need(name, args, "any")
    return Value(~_truth(args[0]), "bool")


FUNCTIONS = {"md": _string_call(T.escape_markdown), "tgtag": _string_call(T.normalize_tag), "index": _index, "len": _len, "eq": _equal(False),
             "ne": _equal(True), "and": _choice(False), "or": _choice(True), "not": _not}


class _Compiler:
    def __init__(self, fields: dict[str, str]):
        self.fields = fields

    def value(self, tree, env) -> Value:
        kind = tree[0]
        if kind == "call":
            if tree[1] not in FUNCTIONS:
                raise TemplateError(f"no function {tree[1]!r}")
            return FUNCTIONS[tree[1]](tree[1], [self.value(a, env) for a in tree[2]])
        text = tree[1]
        if kind == "str":
            return Value(F.lit(text[1:-1] if text[0] == "`" else json.loads(text)), "string")
        if kind == "num":
            return Value(F.lit(int(text)), "int")
        if kind == "word":
            return Value(F.lit(text == "true"), "bool")
        if kind == "var":
            if text not in env:
                raise TemplateError(f"no variable {text!r}")
            return env[text]
        if text == ".":
            if "." not in env:
                raise TemplateError("the whole item cannot be a value")
            return env["."]
        if "." in env:
            raise TemplateError(f"an element has no field {text!r}")
        name = column_name(text[1:])
        if name not in self.fields:
            raise TemplateError(f"no field {text!r}")
        typ = self.fields[name]
        if typ.startswith("array"):
            return Value(F.coalesce(F.col(name), F.array().cast("array<string>")), "list")
        return Value(F.col(name), "int" if typ in ("int", "bigint", "long") else "bool" if typ == "boolean" else "string")

    def nodes(self, nodes: list[Node], env: dict) -> Column:
        parts: list[Column] = []
        for i, n in enumerate(nodes):
            if n.kind == "text":
                parts.append(F.lit(n.args[0]))
            elif n.kind == "print":
                parts.append(_shown(self.value(n.args[0], env)))
            elif n.kind == "let":
                parts.append(self.bound(n.args[0], self.value(n.args[1], env), nodes[i + 1:], env))
                break
            elif n.kind == "if":
                parts.append(F.when(_truth(self.value(n.args[0], env)), self.nodes(n.then, env)).otherwise(self.nodes(n.other, env)))
            else:
                parts.append(self.loop(n, env))
        return F.concat(*parts) if len(parts) > 1 else parts[0] if parts else F.lit("")

    def bound(self, name: str, v: Value, rest: list[Node], env) -> Column:
        """The rest of a block with a variable, whose value is computed once."""
        return F.element_at(F.transform(F.array(v.col), lambda x: self.nodes(rest, env | {name: Value(x, v.kind)})), 1)

    def loop(self, n: Node, env) -> Column:
        names, tree = n.args
        items = self.value(tree, env)
        if items.kind != "list":
            raise TemplateError("range needs a list")

        def body(x, i):
            own = {".": Value(x, "string")} | dict(zip(names[-1:], [Value(x, "string")])) | (dict(zip(names[:1], [Value(i, "int")])) if len(names) == 2 else {})
            return self.nodes(n.then, env | own)
        out = F.array_join(F.transform(items.col, body), "")
        return F.when(_truth(items), out).otherwise(self.nodes(n.other, env)) if n.other else out


def compile_template(source: str, fields: dict[str, str]) -> Column:
    """The template over columns ``fields`` (name: type) as a string column."""
    parser = _Parser(source)
    return _Compiler(fields).nodes(parser.block(())[0], {})


def layout(source: str, fields: dict[str, str]) -> Callable[[DataFrame], Column]:
    """A layout function for ``publish.render_messages``; a bad template raises here."""
    compile_template(source, fields)
    return lambda df: compile_template(source, fields)
