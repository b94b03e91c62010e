"""JSON Schema compiled to column expressions: every error of every record with its path, without Python on the rows.

Records are parsed once to variants. A schema becomes one expression that gives an array of errors; objects are walked
as maps of variants and arrays with transform(), so nested records keep their shape and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioforge.functions.text import json_value

ERROR = "struct<path:string,keyword:string,message:string>"
#: Keywords that assert nothing here; formats are annotations, as validators have it by default.
NOTES = {"$schema", "$id", "$comment", "title", "description", "default", "examples", "format", "deprecated"}
_NONE = f"CAST(array() AS array<{ERROR}>)"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, for a body that gives an array."""
    return F.flatten(F.transform(F.array(value), body))


def _all(found: list[Column]) -> Column:
    """Arrays of errors as one. flatten() walks them once, where concat() builds a lazy list for each row."""
    return found[0] if len(found) == 1 else F.flatten(F.array(*found)) if found else F.expr(_NONE)


def _error(when: Column, path: Column, keyword: str, message: Column) -> Column:
    one = F.array(F.struct(path.alias("path"), F.lit(keyword).alias("keyword"), message.alias("message")))
    return F.when(F.coalesce(when, F.lit(False)), one).otherwise(F.expr(_NONE))


def _map(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _kind(v: Column, deep: bool = False) -> Column:
    """Name of a value's kind. deep: a value that should hold others, of which schema_of_variant would walk all, at each level again."""
    told = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    return F.when(_map(v).isNotNull(), "OBJECT").when(_list(v).isNotNull(), "ARRAY").otherwise(told) if deep else told


def _number(v: Column, kind: Column) -> Column:
    return F.when(kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), F.try_variant_get(v, "$", "double"))


def _text(v: Column, kind: Column) -> Column:
    return F.when(kind == "STRING", F.try_variant_get(v, "$", "string"))


def _is(name: str, v: Column, kind: Column) -> Column:
    n = _number(v, kind)
    return {
        "object": kind == "OBJECT", "array": kind == "ARRAY", "string": kind == "STRING", "boolean": kind == "BOOLEAN", "null": kind == "VOID",
        "number": n.isNotNull(), "integer": (kind == "BIGINT") | F.coalesce(n % 1 == 0, F.lit(False)),
    }[name]


def _scalar(s: dict, v: Column, path: Column) -> list[Column]:
    """Errors by the keywords that need a value's kind."""
    shown = F.to_json(v)

    def told(kind: Column) -> Column:
        found = []
        if "type" in s:
            names = s["type"] if isinstance(s["type"], list) else [s["type"]]
            fine = F.lit(False)
            for n in names:
                fine = fine | _is(n, v, kind)
            found.append(_error(~fine, path, "type", F.concat(shown, F.lit(f" is not of type {', '.join(repr(n) for n in names)}"))))
        n, t = _number(v, kind), _text(v, kind)
        for key, bad, words in (
            ("minimum", lambda x: n < x, "is less than the minimum of"), ("maximum", lambda x: n > x, "is greater than the maximum of"),
            ("exclusiveMinimum", lambda x: n <= x, "is less than or equal to the minimum of"), ("exclusiveMaximum", lambda x: n >= x, "is greater than or equal to the maximum of"),
            ("minLength", lambda x: F.length(t) < x, "is shorter than"), ("maxLength", lambda x: F.length(t) > x, "is longer than"),
            ("pattern", lambda x: ~t.rlike(x), "does not match"),
        ):
            if key in s:
                found.append(_error(bad(s[key]), path, key, F.concat(shown, F.lit(f" {words} {s[key]!r}"))))
        for key in ("enum", "const"):
            if key in s:
                values = s["enum"] if key == "enum" else [s["const"]]
                if any(isinstance(x, (dict, list)) for x in values):
                    raise ValueError(f"{key} takes scalars")
                fine = F.lit(False)
                for x in values:
                    same = _is("null", v, kind) if x is None else (kind == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == x) if isinstance(x, bool) else t == x if isinstance(x, str) else n == x
                    fine = fine | F.coalesce(same, F.lit(False))
                found.append(_error(~fine, path, key, F.concat(shown, F.lit(f" is not one of {values!r}" if key == "enum" else f" is not {values[0]!r}"))))
        return _all(found)

    used = {"type", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "pattern", "enum", "const"} & set(s)
    deep = {"properties", "required", "additionalProperties", "items", "minItems", "maxItems"} & set(s)
    return [_let(_kind(v, bool(deep)), told)] if used else []


def _object(s: dict, v: Column, path: Column) -> list[Column]:
    properties, extra = s.get("properties", {}), s.get("additionalProperties", True)
    if not ({"properties", "required", "additionalProperties"} & set(s)):
        return []

    names = list(dict.fromkeys([*properties, *s.get("required", [])]))

    def told(m: Column) -> Column:
        """Each name is looked up once; the names that are left over are made only where there are some."""
        own = F.struct(*[F.try_element_at(m, F.lit(name)).alias(f"c{k}") for k, name in enumerate(names)]) if names else F.struct(F.lit(0).alias("c0"))
        return F.when(m.isNull(), F.expr(_NONE)).otherwise(_let(own, lambda x: judged(m, {name: x[f"c{k}"] for k, name in enumerate(names)})))

    def judged(m: Column, own: dict[str, Column]) -> Column:
        found = [_error(own[name].isNull(), path, "required", F.lit(f"{name!r} is a required property")) for name in s.get("required", [])]
        for name, sub in properties.items():
            found.append(F.when(own[name].isNotNull(), errors(sub, own[name], F.concat(path, F.lit(f".{name}")))).otherwise(F.expr(_NONE)))
        others = F.array_sort(F.array_except(F.map_keys(m), F.array(*[F.lit(p) for p in properties]) if properties else F.array().cast("array<string>")))
        more = F.size(m) > sum([own[p].isNotNull().cast("int") for p in properties], F.lit(0))
        if extra is False:
            quoted = F.array_join(F.transform(others, lambda k: F.concat(F.lit("'"), k, F.lit("'"))), ", ")
            were = F.when(F.size(others) == 1, " was unexpected)").otherwise(" were unexpected)")
            found.append(_error(more, path, "additionalProperties", F.concat(F.lit("Additional properties are not allowed ("), quoted, were)))
        elif isinstance(extra, dict):
            each = F.flatten(F.transform(others, lambda k: errors(extra, F.try_element_at(m, k), F.concat(path, F.lit("."), k))))
            found.append(F.when(more, each).otherwise(F.expr(_NONE)))
        return _all(found)

    return [_let(_map(v), told)]


def _array(s: dict, v: Column, path: Column) -> list[Column]:
    if not ({"items", "minItems", "maxItems"} & set(s)):
        return []

    def told(items: Column) -> Column:
        found, n = [], F.size(items)
        if "minItems" in s:
            message = F.concat(F.to_json(v), F.lit(" should be non-empty" if s["minItems"] == 1 else " is too short"))
            found.append(_error(n < s["minItems"], path, "minItems", message))
        if "maxItems" in s:
            found.append(_error(n > s["maxItems"], path, "maxItems", F.concat(F.to_json(v), F.lit(" is too long"))))
        if "items" in s:
            found.append(F.flatten(F.transform(items, lambda x, i: errors(s["items"], x, F.concat(path, F.lit("["), i, F.lit("]"))))))
        return F.when(items.isNull(), F.expr(_NONE)).otherwise(_all(found))

    return [_let(_list(v), told)]


HANDLED = {
    "type", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "pattern", "enum", "const",
    "properties", "required", "additionalProperties", "items", "minItems", "maxItems",
}


def errors(schema: dict, v: Column, path: Column) -> Column:
    """Array of errors (path, keyword, message) of a variant. A keyword that isn't known is refused, not passed over."""
    unknown = set(schema) - HANDLED - NOTES
    if unknown:
        raise ValueError(f"unknown keywords: {sorted(unknown)}")
    found = _scalar(schema, v, path) + _object(schema, v, path) + _array(schema, v, path)
    return _all(found)


def validate_json(lines: DataFrame, schema: dict, value: str = "value") -> DataFrame:
    """The other columns of lines with path, keyword and message: a row for each error of each record.

    value: a JSON record. Blank lines and nulls have none. Text that is no JSON, or repeats a name in an object, has one
    error of the keyword 'parse' at '$'. Keywords of values of another kind than theirs assert nothing (a pattern of a
    number), nulls that are written are values, and a missing name is no value.
    """
    rest = [c for c in lines.columns if c != value]
    parsed = lines.where(F.trim(value) != "").select(*rest, json_value(value).alias("_v"))
    whole = F.when(F.col("_v").isNull(), F.array(F.struct(F.lit("$").alias("path"), F.lit("parse").alias("keyword"), F.lit("no JSON").alias("message")))).otherwise(errors(schema, F.col("_v"), F.lit("$")))
    return parsed.select(*rest, F.inline(whole))
