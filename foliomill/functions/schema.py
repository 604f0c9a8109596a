"""Checks JSON against a schema of types, required fields, enumerations and nested objects and lists, and says where it fails."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

ERRORS = ArrayType(StructType([StructField("path", StringType()), StructField("rule", StringType())]))
_KINDS: dict[str, Callable[[Any], bool]] = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
}


def failures(value: Any, schema: dict) -> list[tuple[str, str]]:
    """(path, rule) of everything in ``value`` that breaks ``schema``, in the order of the document, whatever its depth."""
    out: list[tuple[str, str]] = []
    waiting = [("$", value, schema)]
    while waiting:
        path, v, s = waiting.pop()
        kinds = s.get("type", [])
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if kinds and not any(_KINDS[k](v) for k in kinds):
            out.append((path, "type"))
            continue
        if "enum" in s and v not in s["enum"]:
            out.append((path, "enum"))
        below: list[tuple[str, Any, dict]] = []
        if isinstance(v, dict):
            known = s.get("properties", {})
            out += [(f"{path}.{name}", "required") for name in s.get("required", []) if name not in v]
            if s.get("additionalProperties", True) is False:
                out += [(f"{path}.{name}", "unknown") for name in v if name not in known]
            below = [(f"{path}.{name}", v[name], known[name]) for name in v if name in known]
        elif isinstance(v, list):
            if len(v) > s.get("maxItems", len(v)) or len(v) < s.get("minItems", 0):
                out.append((path, "items"))
            below = [(f"{path}[{i}]", x, s["items"]) for i, x in enumerate(v)] if "items" in s else []
        elif isinstance(v, str) and len(v) < s.get("minLength", 0):
            out.append((path, "length"))
        elif isinstance(v, (int, float)) and not isinstance(v, bool) and not s.get("minimum", v) <= v <= s.get("maximum", v):
            out.append((path, "range"))
        waiting += reversed(below)
    return out


def json_failures(text: Column, schema: dict) -> Column:
    """What of a JSON text breaks the schema; text that is no JSON breaks it at its root, null stays null."""

    def check(line: str | None) -> list[dict] | None:
        if line is None:
            return None
        try:
            found = failures(json.loads(line), schema)
        except (ValueError, RecursionError):
            found = [("$", "json")]
        return [{"path": p, "rule": r} for p, r in found]

    @F.pandas_udf(ERRORS)
    def run(lines: pd.Series) -> pd.Series:
        return pd.Series([check(x) for x in lines], dtype="object")

    return run(text)
