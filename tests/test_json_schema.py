"""The compiled schema against a plain validator in Python."""

import copy
import json
import random
import re

import pytest

from biblioforge import schemas
from biblioforge.operators.json_schema import errors, validate_json


def plain(s, v, path="$"):
    """(path, keyword) of each error."""
    number = isinstance(v, (int, float)) and not isinstance(v, bool)
    kinds = {"object": isinstance(v, dict), "array": isinstance(v, list), "string": isinstance(v, str), "boolean": isinstance(v, bool), "null": v is None, "number": number, "integer": number and float(v).is_integer()}
    out = []
    add = lambda bad, k: out.append((path, k)) if bad else None
    if "type" in s:
        add(not any(kinds[t] for t in ([s["type"]] if isinstance(s["type"], str) else s["type"])), "type")
    if "enum" in s:
        add(not any(type(x) is type(v) and x == v or (number and not isinstance(x, (bool, str, type(None))) and x == v) for x in s["enum"]), "enum")
    if isinstance(v, str):
        add("pattern" in s and not re.search(s["pattern"], v), "pattern")
        add("minLength" in s and len(v) < s["minLength"], "minLength")
    if number:
        add("minimum" in s and v < s["minimum"], "minimum")
        add("maximum" in s and v > s["maximum"], "maximum")
        add("exclusiveMinimum" in s and v <= s["exclusiveMinimum"], "exclusiveMinimum")
    if isinstance(v, dict):
        for name in s.get("required", []):
            add(name not in v, "required")
        extra = [k for k in v if k not in s.get("properties", {})]
        if s.get("additionalProperties") is False:
            add(extra, "additionalProperties")
        for name, sub in s.get("properties", {}).items():
            if name in v:
                out += plain(sub, v[name], f"{path}.{name}")
        if isinstance(s.get("additionalProperties"), dict):
            for name in extra:
                out += plain(s["additionalProperties"], v[name], f"{path}.{name}")
    if isinstance(v, list):
        add("minItems" in s and len(v) < s["minItems"], "minItems")
        add("maxItems" in s and len(v) > s["maxItems"], "maxItems")
        for i, x in enumerate(v if "items" in s else []):
            out += plain(s["items"], x, f"{path}[{i}]")
    return out


GOOD = {
    "work_id": "wiley_0a", "title": "Bonds", "language": "en", "publisher": "W", "segment": "S", "subsegment": "T", "perspective": "theory", "dataset_status": "draft", "authors": ["A", "B"], "importance_score": 5.5,
    "editions": [
        {"edition_number": 1, "publication_year": 1999, "is_latest": False, "formats": [{"format_type": "pdf", "isbn": "9781234567890", "price": {"amount": 1.5, "currency": "USD"}}, {"format_type": "kindle", "asin": "B000000001"}]},
        {"edition_number": 2.0, "publication_year": 2005, "is_latest": True, "pages": 10, "table_of_contents": ["x"], "formats": [{"format_type": "ebook"}]},
    ],
}
ODD = [None, True, 0, -1, 1.5, 10**20, "", "x", "UPPER", [], {}, [1, "a", None], {"a": 1}, 1e3, 2500]


def places(v, at=()):
    yield at
    for k, x in v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ():
        yield from places(x, (*at, k))


def spoiled(r):
    v = copy.deepcopy(GOOD)
    for _ in range(r.randint(1, 3)):
        at = r.choice([p for p in places(v) if p])
        up = v
        for k in at[:-1]:
            up = up[k]
        what = r.random()
        if what < 0.5:
            up[at[-1]] = r.choice(ODD)
        elif what < 0.75 and isinstance(up, dict):
            del up[at[-1]]
        elif isinstance(up, dict):
            up[r.choice(["extra", "more"])] = r.choice(ODD)
    return v


def found(spark, records, schema):
    lines = spark.createDataFrame([(i, r if isinstance(r, str) or r is None else json.dumps(r)) for i, r in enumerate(records)], "line long, value string")
    out = {i: [] for i in range(len(records))}
    for e in validate_json(lines, schema).collect():
        assert e.message
        out[e.line].append((e.path, e.keyword))
    return out


def test_works(spark):
    r = random.Random(6)
    records = [GOOD, {}, [], 3, "3", 'null', {**GOOD, "editions": []}, *[spoiled(r) for _ in range(300)]]
    values = [json.loads(x) if isinstance(x, str) else x for x in records]
    got = found(spark, records, schemas.WORK_SCHEMA)
    assert got[0] == []
    assert {i: sorted(e) for i, e in got.items()} == {i: sorted(plain(schemas.WORK_SCHEMA, v)) for i, v in enumerate(values)}
    assert len({k for e in got.values() for _, k in e}) == 8


def test_other_keywords(spark):
    s = {"type": ["object", "null"], "properties": {"a": {"enum": [1, "1", None, True]}, "b": {"exclusiveMinimum": 2, "minLength": 2}, "c": {"maxItems": 1, "items": {"type": ["integer", "null"]}}}, "additionalProperties": {"type": "string"}}
    records = [{"a": x} for x in (1, 1.0, "1", None, True, False, 0, "x", [])] + [{"b": x} for x in (2, 2.5, "x", "xy", None)] + [{"c": x} for x in ([1], [1, None], ["x", 2.5], {"x": 1})] + [{"d": 1, "e": "x", "f f": None}, "null", "7"]
    values = [json.loads(x) if isinstance(x, str) else x for x in records]
    assert {i: sorted(e) for i, e in found(spark, records, s).items()} == {i: sorted(plain(s, v)) for i, v in enumerate(values)}


def test_odd_lines_and_messages(spark):
    bad = ["{", '{"a": 1, "a": 2}', "{} x", "[1], [2]", "1],[2", "1] , [2", '{}},{"a": {}', "1, 2", "]", '{"a": [1], "b": [2]} {']
    fine = ["[1]", ' [[1],[2]] ', '["],["]']
    assert found(spark, ["", "  ", None, *bad, *fine], {"type": "array"}) == {i: [("$", "parse")] if 3 <= i < 3 + len(bad) else [] for i in range(6 + len(bad))}
    lines = spark.createDataFrame([('{"language": "xx", "zz": 1, "yy": 2}',)], "value string")
    told = {e.message for e in validate_json(lines, {**schemas.WORK_SCHEMA, "required": ["title"]}).collect()}
    assert told == {"'title' is a required property", "\"xx\" is not one of ['ja', 'en', 'other']", "Additional properties are not allowed ('yy', 'zz' were unexpected)"}
    with pytest.raises(ValueError, match="unknown keywords"):
        errors({"anyOf": []}, None, None)
