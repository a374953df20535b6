"""Paths into JSON documents with wildcards, descent and conditions, as expressions over VARIANT.

A path is a sequence of steps from the document, ``$``: ``.name``, ``."any name"``, ``[n]``, ``[*]``, ``.*``,
``..name`` (at any depth) and ``? (condition)``. Conditions compare ``@`` or a path from it with a literal or another
path (``== != < <= > >=``), join with ``&&``, ``||``, ``!`` and parentheses, and know ``exists(@.name)`` and ``@ starts with
"x"``. Steps are lax: a member of an array is that of its elements, and what is no array counts as an array of one. A
comparison of several values holds when it holds for one; values of different types are unequal.

Every step is a higher-order function from an array of values to an array of values, so a whole path is one expression.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, functions as F

from lakestead.functions.documents import member

#: Levels that a descent looks into; a deeper document raises an error.
DEEPEST = 12

Step = Callable[[Column], Column]
_TOKEN = re.compile(
    r'\s*("(?:[^"\\]|\\.)*"|\.\.|&&|\|\||[=!<>]=|starts\s+with\b|exists\b|-?[0-9]+(?:\.[0-9]+)?|[A-Za-z_][A-Za-z_0-9]*|[$@.\[\]*?()!<>])'
)


def query(doc: Column, path: str) -> Column:
    """All values that a path leads to, as an array of VARIANT; empty where there is none."""
    whole = F.filter(F.array(F.try_parse_json(doc)), lambda v: v.isNotNull())
    return _Compiler(path).compile()(whole)


def query_text(doc: Column, path: str) -> Column:
    """The same, each as JSON text."""
    return F.transform(query(doc, path), lambda v: F.to_json(v))


def exists(doc: Column, path: str) -> Column:
    return F.size(query(doc, path)) > 0


# ---- steps ----------------------------------------------------------------------------------
def _each(values: Column, to: Callable[[Column], Column]) -> Column:
    """to() of every value, without those that have none."""
    return F.filter(F.transform(values, to), lambda v: v.isNotNull())


def _elements(values: Column) -> Column:
    # NULL where the value is none; the schema of a whole value costs more than the value.
    of_array = lambda v: F.try_variant_get(v, "$", "array<variant>")
    return F.flatten(F.transform(values, lambda v: F.coalesce(of_array(v), F.array(v))))


def _members(values: Column) -> Column:
    of_object = lambda v: F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))
    none = F.array().cast("array<variant>")
    return F.flatten(F.transform(values, lambda v: F.coalesce(of_object(v), none)))


def _children(values: Column) -> Column:
    return _members(_elements(values))


def _named(name: str) -> Step:
    return lambda values: _each(_elements(values), lambda v: member(v, name))


def _at(index: int) -> Step:
    def step(values: Column) -> Column:
        one = lambda v: F.when(
            F.schema_of_variant(v).startswith("ARRAY"), F.get(F.try_variant_get(v, "$", "array<variant>"), F.lit(index))
        )
        return _each(values, lambda v: F.coalesce(one(v), v) if index == 0 else one(v))

    return step


def _anywhere(name: str) -> Step:
    def step(values: Column) -> Column:
        # From level to level through array variables, so that a level is computed once.
        start = F.struct(values.alias("level"), _named(name)(values).alias("found"))

        def deeper(at: Column, _: Column) -> Column:
            return F.transform(
                F.array(_children(at["level"])),
                lambda below: F.struct(below.alias("level"), F.concat(at["found"], _named(name)(below)).alias("found")),
            )[0]

        whole = F.aggregate(F.sequence(F.lit(1), F.lit(DEEPEST)), start, deeper)
        too_deep = F.raise_error(F.lit(f"a document is deeper than {DEEPEST} levels")).cast("array<variant>")
        return F.transform(
            F.array(whole), lambda w: F.when(F.size(_children(w["level"])) > 0, too_deep).otherwise(w["found"])
        )[0]

    return step


# ---- conditions -----------------------------------------------------------------------------
_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def _typed(value: Column, wanted: Any) -> Column:
    """The value in the type of a literal; NULL where it has another one."""
    kind = F.schema_of_variant(value)
    if isinstance(wanted, bool):
        return F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
    if isinstance(wanted, (int, float)):
        number = kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "FLOAT")
        return F.when(number, F.try_variant_get(value, "$", "decimal(38,10)"))
    return F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))


def _literal(wanted: Any) -> Column:
    if isinstance(wanted, (int, float)) and not isinstance(wanted, bool):
        return F.lit(str(wanted)).cast("decimal(38,10)")
    return F.lit(wanted)


def _compared(values: Column, operator: str, wanted: Any) -> Column:
    if wanted is None:
        is_null = lambda v: F.is_variant_null(v) if operator == "==" else ~F.is_variant_null(v)
        return F.exists(values, is_null)
    holds = lambda v: F.coalesce(_COMPARE[operator](_typed(v, wanted), _literal(wanted)), F.lit(operator == "!="))
    return F.exists(values, holds)


def _compared_paths(left: Column, operator: str, right: Column) -> Column:
    def holds(a: Column, b: Column) -> Column:
        same = [_COMPARE[operator](_typed(a, k), _typed(b, k)) for k in (True, 1, "")]
        return F.coalesce(*same, F.lit(operator == "!="))

    return F.exists(left, lambda a: F.exists(right, lambda b: holds(a, b)))


class _Compiler:
    """Reads a path from left to right; every method takes what it knows and leaves the rest."""

    def __init__(self, path: str):
        self.path, self.tokens, at = path, [], 0
        while path[at:].strip():
            hit = _TOKEN.match(path, at)
            if not hit:
                self.fail(path[at:])
            self.tokens.append(re.sub(r"\s+", " ", hit[1]) if hit[1][0] != '"' else hit[1])
            at = hit.end()

    def fail(self, found: object) -> None:
        raise ValueError(f"path {self.path!r} cannot be read at {found!r}")

    def next(self, *wanted: str) -> str:
        token = self.tokens.pop(0) if self.tokens else None
        if token is None or (wanted and token not in wanted):
            self.fail(token)
        return token

    def sees(self, *tokens: str) -> bool:
        return bool(self.tokens) and self.tokens[0] in tokens

    def compile(self) -> Step:
        self.next("$")
        steps = self.steps()
        if self.tokens:
            self.fail(self.tokens[0])
        return steps

    def steps(self) -> Step:
        done: list[Step] = []
        while self.sees(".", "..", "[", "?"):
            token = self.next()
            if token == "[":
                inner = self.next()
                done.append(_elements if inner == "*" else _at(self.index(inner)))
                self.next("]")
            elif token == "?":
                self.next("(")
                condition = self.any_of()
                self.next(")")
                done.append(lambda values, c=condition: F.filter(_elements(values), lambda v: c(v)))
            elif self.sees("*"):
                self.next()
                done.append(_children)
            else:
                done.append((_named if token == "." else _anywhere)(self.name()))

        def run(values: Column) -> Column:
            for step in done:
                values = step(values)
            return values

        return run

    def name(self) -> str:
        token = self.next()
        if token[0] == '"':
            return json.loads(token)
        if not re.fullmatch(r"[A-Za-z_][A-Za-z_0-9]*|starts with|exists", token):
            self.fail(token)
        return token

    def index(self, token: str) -> int:
        if not token.isdigit():
            self.fail(token)
        return int(token)

    def any_of(self) -> Callable[[Column], Column]:
        parts = [self.all_of()]
        while self.sees("||"):
            self.next()
            parts.append(self.all_of())
        return _joined(parts, lambda a, b: a | b)

    def all_of(self) -> Callable[[Column], Column]:
        parts = [self.one()]
        while self.sees("&&"):
            self.next()
            parts.append(self.one())
        return _joined(parts, lambda a, b: a & b)

    def one(self) -> Callable[[Column], Column]:
        if self.sees("!"):
            self.next()
            inner = self.one()
            return lambda v: ~inner(v)
        if self.sees("("):
            self.next()
            inner = self.any_of()
            self.next(")")
            return inner
        if self.sees("exists"):
            self.next()
            self.next("(")
            path = self.from_here()
            self.next(")")
            return lambda v: F.size(path(v)) > 0
        path = self.from_here()
        if self.sees("starts with"):
            self.next()
            start = self.literal()
            return lambda v: F.exists(path(v), lambda x: F.coalesce(F.startswith(_typed(x, ""), F.lit(start)), F.lit(False)))
        operator = self.next(*_COMPARE)
        if self.sees("@"):
            other = self.from_here()
            return lambda v: _compared_paths(path(v), operator, other(v))
        wanted = self.literal()
        return lambda v: _compared(path(v), operator, wanted)

    def from_here(self) -> Callable[[Column], Column]:
        self.next("@")
        steps = self.steps()
        return lambda v: steps(F.array(v))

    def literal(self) -> Any:
        token = self.next()
        try:
            return json.loads(token)
        except ValueError:
            self.fail(token)


def _joined(parts: list, how: Callable[[Column, Column], Column]) -> Callable[[Column], Column]:
    def condition(value: Column) -> Column:
        out = parts[0](value)
        for part in parts[1:]:
            out = how(out, part(value))
        return out

    return condition
