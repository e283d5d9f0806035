"""Declared records compiled to expressions: what a reply lacks, has too much of, or has wrong."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Of a kind, what its values' schema begins with.
_KINDS = {"string": ("STRING",), "boolean": ("BOOLEAN",), "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "integer": ("BIGINT",)}


@dataclass(frozen=True)
class Value:
    """A single value: its kind (string, boolean, number, integer), whether null will do, and the values that are allowed."""

    kind: str = "string"
    null: bool = False
    one_of: Sequence[str] = ()


@dataclass(frozen=True)
class Items:
    """An array of least to most items, each as declared."""

    each: Value | Items | Record
    least: int = 0
    most: int | None = None


@dataclass(frozen=True)
class Record:
    """An object: its fields, which of them must be there (all without a list), and whether others may be."""

    fields: Mapping[str, Value | Items | Record] = field(default_factory=dict)
    required: Sequence[str] | None = None
    closed: bool = True


def violations(json: str | Column, declared: Value | Items | Record) -> Column:
    """Sorted distinct violations of a JSON text, as `path: what`; an empty array if it keeps to the record, `$: not JSON` if it cannot be read.

    A declaration is compiled once to one expression over variants; elements of
    arrays have the path `[]`, so the list is bounded by the declaration and not
    by the data.
    """
    text = F.col(json) if isinstance(json, str) else json
    parsed = F.try_parse_json(text)
    return F.when(parsed.isNull(), F.array(F.lit("$: not JSON"))).otherwise(F.array_sort(F.array_distinct(_compiled(parsed, declared, "$"))))


def keeps_to(json: str | Column, declared: Value | Items | Record) -> Column:
    return F.size(violations(json, declared)) == 0


def _none() -> Column:
    return F.array().cast("array<string>")


def _if(condition: Column, what: str) -> Column:
    return F.when(condition, F.array(F.lit(what))).otherwise(_none())


def _joined(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: F.concat(a, b), parts, _none())


def _compiled(v: Column, declared: Value | Items | Record, path: str) -> Column:
    if isinstance(declared, Value):
        return _value(v, declared, path)
    if isinstance(declared, Items):
        items = F.try_variant_get(v, "$", "array<variant>")
        size = F.size(items)
        over = F.lit(False) if declared.most is None else size > declared.most
        inside = F.flatten(F.transform(items, lambda x: _compiled(x, declared.each, f"{path}[]")))
        whole = _joined([_if(size < declared.least, f"{path}: too few"), _if(over, f"{path}: too many"), inside])
        return F.when(items.isNull(), F.array(F.lit(f"{path}: not an array"))).otherwise(whole)
    found = F.try_variant_get(v, "$", "map<string,variant>")
    names = F.map_keys(found)
    known = F.array(*[F.lit(n) for n in declared.fields]).cast("array<string>")
    required = declared.fields if declared.required is None else declared.required
    parts = [_if(~F.array_contains(names, n), f"{path}.{n}: missing") for n in required]
    parts += [F.when(F.array_contains(names, n), _compiled(F.element_at(found, F.lit(n)), d, f"{path}.{n}")).otherwise(_none()) for n, d in declared.fields.items()]
    if declared.closed:
        parts.append(_if(F.size(F.array_except(names, known)) > 0, f"{path}: not declared"))
    return F.when(found.isNull(), F.array(F.lit(f"{path}: not an object"))).otherwise(_joined(parts))


def _value(v: Column, declared: Value, path: str) -> Column:
    kind = F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    right = reduce(lambda a, b: a | b, [kind.startswith(k) for k in _KINDS[declared.kind]])
    empty = kind == "VOID"
    wrong = _if(~right & ~(empty & F.lit(declared.null)), f"{path}: not {declared.kind}")
    if not declared.one_of:
        return wrong
    outside = ~F.coalesce(F.try_variant_get(v, "$", "string").isin(*declared.one_of), F.lit(False))
    return F.concat(wrong, _if(right & outside, f"{path}: not allowed"))
