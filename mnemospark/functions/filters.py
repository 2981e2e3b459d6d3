"""Structured filters as Column predicates.

A filter is a nested dict: ``{"field": value}``, ``{"field": {"$gt": value}}``,
``{"$and": [...]}`` and ``{"$or": [...]}``; operator names work with or without ``$``.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, functions as F

_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
}
_OPERATORS = {"eq", "ne", "in", "nin", *_COMPARE}


def _op(name: str) -> str:
    return name[1:] if name.startswith("$") else name


#: Markers of typed values: the kind, which is also the key of its text, and how the text is read.
_MARKERS: dict[str, Callable[[str], dt.datetime]] = {
    "date": lambda text: dt.datetime.fromisoformat(text + "T00:00:00"),
    "datetime": dt.datetime.fromisoformat,
}


def filter_value(value: Any) -> Any:
    """A filter's value with its date and datetime markers read; anything else as it is."""
    if isinstance(value, (list, tuple)):
        return list(map(filter_value, value))
    kind = value.get("type") if isinstance(value, Mapping) else None
    return _MARKERS[kind](value[kind]) if kind in _MARKERS and kind in value else value


def _naive(value: dt.datetime) -> Column:
    return F.to_timestamp_ntz(F.lit(value.isoformat(sep=" ")))


def _instant(value: Any) -> bool:
    return isinstance(value, dt.datetime) and value.tzinfo is not None


def _literal(value: Any) -> Column:
    return _naive(value) if isinstance(value, dt.datetime) else F.lit(value)


def _against(col: Column, value: Any, test: Callable[[Column, Column], Column]) -> Column:
    """``test`` of the column with the value as a literal of the column's own time type.

    An instant is compared as one with TIMESTAMP columns, whatever the session zone, and as the UTC
    clock with columns that have no zone. The type is known when the plan is made, so one branch
    stays and reaches the scan.
    """
    if not _instant(value):
        return test(col, _literal(value))
    utc = value.astimezone(dt.timezone.utc)
    micros = (utc - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return F.when(F.typeof(col) == "timestamp", test(col, F.timestamp_micros(F.lit(micros)))).otherwise(test(col, _naive(utc.replace(tzinfo=None))))


def _compare(col: Column, op: str, value: Any) -> Column:
    if op in ("in", "nin"):
        values = value if isinstance(value, list) else [value]
        plain = [_literal(v) for v in values if v is not None and not _instant(v)]
        hit = col.isin(*plain) if plain else F.lit(False)
        for v in filter(_instant, values):
            hit = hit | _against(col, v, lambda c, x: c == x)
        if None in values:
            hit = col.isNull() | F.coalesce(hit, F.lit(False))
            return hit if op == "in" else ~hit
        return hit if op == "in" else (~hit | col.isNull())
    if value is None and op in ("eq", "ne"):
        return col.isNull() if op == "eq" else col.isNotNull()
    if op == "eq":
        return _against(col, value, lambda c, x: c == x)
    if op == "ne":
        return _against(col, value, lambda c, x: c != x) | col.isNull()  # a missing field is not equal to anything
    return _against(col, value, _COMPARE[op])


def filter_to_column(spec: Mapping[str, Any],
                     resolve: Callable[[str], Column] = F.col) -> Column:
    """Predicate for a structured filter; an empty filter keeps every row."""
    terms: list[Column] = []
    for key, value in spec.items():
        name = _op(key)
        if name in ("and", "or") and isinstance(value, list):
            if not value:
                raise ValueError(f"{key} needs at least one operand")
            parts = [filter_to_column(v, resolve) for v in value]
            joined = parts[0]
            for part in parts[1:]:
                joined = (joined & part) if name == "and" else (joined | part)
            terms.append(joined)
            continue
        if key.startswith("$"):
            raise ValueError(f"unknown operator {key}")
        value = filter_value(value)
        if isinstance(value, Mapping):
            unknown = [k for k in value if _op(k) not in _OPERATORS]
            if unknown or not value:
                raise ValueError(f"unsupported comparison for {key}: {dict(value)}")
            terms.extend(_compare(resolve(key), _op(k), filter_value(v)) for k, v in value.items())
        else:
            terms.append(_compare(resolve(key), "eq", value))
    if not terms:
        return F.lit(True)
    out = terms[0]
    for term in terms[1:]:
        out = out & term
    return out


def as_predicate(pre_filter: Column | Mapping[str, Any] | None) -> Column | None:
    if pre_filter is None or isinstance(pre_filter, Column):
        return pre_filter
    return filter_to_column(pre_filter)


def _variant_equals(value: Column, path: str, expected: Any) -> Column:
    at = F.try_variant_get(value, path, "variant")
    kind = F.schema_of_variant(at)
    if expected is None:
        return at.isNull() | F.is_variant_null(at)
    if isinstance(expected, (Mapping, list)):
        return F.to_json(at) == F.to_json(F.parse_json(F.lit(json.dumps(expected))))
    if isinstance(expected, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(value, path, "boolean") == F.lit(expected))
    if isinstance(expected, str):
        return (kind == "STRING") & (F.try_variant_get(value, path, "string") == F.lit(expected))
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return numeric & (F.try_variant_get(value, path, "double") == F.lit(float(expected)))


def value_equals(value: Column | str, spec: Mapping[str, Any]) -> Column:
    """All dotted paths of a VARIANT equal the given values; nested dicts compare whole."""
    v = F.col(value) if isinstance(value, str) else value
    out = F.lit(True)
    for key, expected in spec.items():
        if any(part.startswith("$") for part in key.split(".")):
            raise ValueError(f"filter keys must not hold operators: {key}")
        if key == "value" or key.startswith("value."):
            raise ValueError(f"filter keys are relative to the value: {key}")
        if isinstance(expected, Mapping) and any(str(k).startswith("$") for k in expected):
            raise ValueError(f"filter values must not hold operators: {key}")
        path = "$" + "".join(f"['{p}']" if not p.isdigit() else f"[{p}]" for p in key.split("."))
        out = out & F.coalesce(_variant_equals(v, path, expected), F.lit(False))
    return out
