"""Declarative maps: classes whose slots are expressions over a row's columns, compiled to column expressions.

    class_derivations:
      Person:
        populated_from: CommonsMembersRow
        slot_derivations:
          id: {expr: "'gckg:Person:Commons:' + str(person_id)"}
          name: {populated_from: person_official_last_name}

An expression is a small part of Python's: names of slots, texts, numbers, None, +, or, and, not, comparisons, `x if c else y`,
and the functions below. Anything else is refused when the map is read. As in Python, str(None) is 'None' and an
empty text counts as false; unlike there, + with None gives None, and a slot that is None isn't written.
"""

from __future__ import annotations

import ast
from pathlib import Path

import yaml
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmere.functions import columns as C
from quillmere.operators.fragments import FIELDS, Materializer, fragment
from quillmere.plans.errors import SchemaConfigError

FUNCTIONS = {
    "str": lambda x: F.coalesce(x.cast("string"), F.lit("None")),
    "lower": F.lower,
    "upper": F.upper,
    "strip": C.trimmed,
    "slug": C.slug,
}
COMPARE = {ast.Eq: lambda a, b: a.eqNullSafe(b), ast.NotEq: lambda a, b: ~a.eqNullSafe(b), ast.Is: lambda a, b: a.eqNullSafe(b), ast.IsNot: lambda a, b: ~a.eqNullSafe(b)}


def _true(x: Column) -> Column:
    """Whether a text counts as true: neither None nor empty."""
    return F.coalesce(x.cast("string") != "", F.lit(False))


def compiled(expr: str, names: list[str]) -> Column:
    """The column of an expression over columns of these names."""

    def of(n: ast.AST) -> Column:
        match n:
            case ast.Constant(value=None):
                return F.lit(None).cast("string")
            case ast.Constant(value=str() | int() | float() as v) if not isinstance(v, bool):
                return F.lit(str(v))
            case ast.Name(id=name) if name in names:
                return F.col(f"`{name}`")
            case ast.Name(id=name):
                raise SchemaConfigError(f"no slot {name!r} for {expr!r}")
            case ast.BinOp(left=a, op=ast.Add(), right=b):
                return F.concat(of(a), of(b))
            case ast.BoolOp(op=op, values=values):
                out = of(values[-1])
                for v in reversed(values[:-1]):
                    own = of(v)
                    out = F.when(_true(own), own).otherwise(out) if isinstance(op, ast.Or) else F.when(_true(own), out).otherwise(own)
                return out
            case ast.IfExp(test=t, body=a, orelse=b):
                return F.when(test(t), of(a)).otherwise(of(b))
            case ast.Call(func=ast.Name(id=f), args=[x], keywords=[]) if f in FUNCTIONS:
                return FUNCTIONS[f](of(x))
        raise SchemaConfigError(f"{ast.unparse(n)!r} isn't allowed in {expr!r}")

    def test(n: ast.AST) -> Column:
        match n:
            case ast.Compare(left=a, ops=[op], comparators=[b]) if type(op) in COMPARE:
                return COMPARE[type(op)](of(a), of(b))
            case ast.UnaryOp(op=ast.Not(), operand=x):
                return ~test(x)
            case ast.BoolOp(op=op, values=values):
                out = test(values[0])
                for v in values[1:]:
                    out = (out | test(v)) if isinstance(op, ast.Or) else (out & test(v))
                return out
        return _true(of(n))

    try:
        return of(ast.parse(expr.strip(), mode="eval").body)
    except SyntaxError as e:
        raise SchemaConfigError(f"{expr!r}: {e}") from e


class Mapped(Materializer):
    """Fragments by a map: one of each class, in the map's order; a fragment that has neither an id nor a subject isn't made."""

    def __init__(self, source: str, run_id: str, path: Path, row_class: str, names: list[str]):
        super().__init__(source, run_id)
        spec = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
        self.classes: list[tuple[str, dict[str, Column]]] = []
        for kind, how in (spec.get("class_derivations") or {}).items():
            if how.get("populated_from", row_class) != row_class:
                continue
            slots = {}
            for slot, by in (how.get("slot_derivations") or {}).items():
                by = by or {}
                if slot not in FIELDS[2:]:
                    raise SchemaConfigError(f"{kind} has no slot {slot!r}")
                slots[slot] = compiled(by.get("expr") or by.get("populated_from") or slot, names)
            self.classes.append((kind, slots))
        if not self.classes:
            raise SchemaConfigError(f"{path} has no class for {row_class}")

    def fragments(self, line: Column) -> Column:
        ref, null = self.reference(line), F.lit(None).cast("string")
        made = [F.when(F.coalesce(s.get("id", null), s.get("subject", null)).isNotNull(), fragment(k, ref, **s)) for k, s in self.classes]
        return F.filter(F.array(*made), lambda x: x.isNotNull())
