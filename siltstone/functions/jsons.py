"""JSON text, maps and arrays."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: An author profile's labels and the columns that they fill.
PROFILE = {"Name": "author_name_meta", "Who do you know with myeloma?": "author_who", "When were you/they diagnosed?": "author_dx_when_raw", "Age at diagnosis": "author_age_at_dx_raw"}


def json_map(text: Column) -> Column:
    """An object as a map of strings; null for invalid text and other values."""
    return F.from_json(F.when(F.trim(text).startswith("{"), text), "map<string,string>")


def profile_field(text: Column, label: str) -> Column:
    return F.nullif(F.try_element_at(json_map(text), F.lit(label)), F.lit(""))


def json_cell(value: Column) -> Column:
    """A nested value as JSON text, null as ''."""
    return F.coalesce(F.to_json(value), F.lit(""))


def scalar_text(value: Column, depth: int = 2) -> Column:
    """A cell's text from JSON text: strings as they are, of objects the first filled display key, else the JSON itself."""
    inner = value
    for _ in range(depth):
        picked = F.coalesce(*[F.nullif(F.get_json_object(inner, f"$.{k}"), F.lit("")) for k in ("displayText", "display_text", "text", "label", "value", "date")])
        inner = F.when(F.trim(inner).startswith("{") & picked.isNotNull(), picked).otherwise(inner)
    return F.trim(F.coalesce(inner, F.lit("")))


def first_display_text(blocks: Column) -> Column:
    """Of a JSON list of blocks the first text; tags stripped elsewhere."""
    listed = F.from_json(blocks, "array<struct<display_text: string, displayText: string>>")
    filled = F.filter(F.transform(listed, lambda b: F.coalesce(F.nullif(b.display_text, F.lit("")), b.displayText)), lambda t: F.coalesce(t, F.lit("")) != "")
    return F.coalesce(F.get(filled, F.lit(0)), F.lit(""))


def author_with_role(authored: Column, role: str) -> Column:
    """name and qualifications of the first author in a role."""
    listed = F.from_json(F.get_json_object(authored, "$.authors"), "array<struct<role: string, name: string, qualifications: string>>")
    found = F.get(F.filter(listed, lambda a: F.trim(a.role) == role), F.lit(0))
    return F.struct(*[F.trim(F.coalesce(found[c], F.lit(""))).alias(c) for c in ("name", "qualifications")])


def without_nulls(value):
    """A JSON value without null, '', [] and {} at any depth; 0 and false stay."""
    if isinstance(value, dict):
        kept = {k: without_nulls(v) for k, v in value.items()}
        return {k: v for k, v in kept.items() if v not in (None, "", [], {}) or v is False or (v == 0 and not isinstance(v, (str, list, dict)) and v is not None)}
    if isinstance(value, list):
        return [v for v in map(without_nulls, value) if not (v is None or v == "" or v == [] or v == {})]
    return value


@F.pandas_udf(StringType())
def strip_nulls(texts):
    """``without_nulls`` on JSON text; depth is unbounded, which no built-in function allows. Invalid text gives null."""

    def strip(text):
        try:
            return json.dumps(without_nulls(json.loads(text)), ensure_ascii=False, separators=(",", ":"))
        except (TypeError, ValueError):
            return None

    return texts.map(strip)


@F.pandas_udf(ArrayType(StringType()))
def json_strings(texts):
    """All strings within a JSON text, in order."""

    def walk(value):
        if isinstance(value, str):
            yield value
        for inner in value.values() if isinstance(value, dict) else value if isinstance(value, list) else ():
            yield from walk(inner)

    def strings(text):
        try:
            return list(walk(json.loads(text)))
        except (TypeError, ValueError, RecursionError):
            return []

    return texts.map(strings)


def balanced(text: str, begin: int) -> str | None:
    """The bracketed value that starts at ``begin``, strings and escapes within heeded; null if it never closes."""
    depth, quote, at = 0, "", begin
    while at < len(text):
        c = text[at]
        if quote:
            if c == "\\":
                at += 1
            elif c == quote:
                quote = ""
        elif c in "\"'":
            quote = c
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
            if not depth:
                return text[begin : at + 1]
        at += 1
    return None


def string_literal(text: str, begin: int) -> str | None:
    """The value of a JavaScript string literal at ``begin``. Text beyond ASCII stays as it is."""
    quote = text[begin : begin + 1]
    if quote not in ("'", '"'):
        return None
    m = re.compile(rf"(?:[^\\{quote}]|\\.)*+{quote}", re.S).match(text, begin + 1)
    if not m:
        return None
    plain = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "0": "\0"}
    return re.sub(r"\\(?:u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|(.))", lambda e: chr(int(e[1] or e[2], 16)) if e[1] or e[2] else plain.get(e[3], e[3]), m[0][:-1], flags=re.S)


def assigned(text: str, name: str):
    """The JSON value that a page assigns to ``name``: an object or list, JSON.parse("...") or a string of JSON; null if there is none."""
    for m in re.finditer(rf"{re.escape(name)}\w*\s*=\s*(JSON\.parse\(\s*)?", text):
        at = m.end()
        raw = string_literal(text, at) if text[at : at + 1] in ("'", '"') else balanced(text, at) if text[at : at + 1] in ("{", "[") else None
        try:
            if raw is not None:
                return json.loads(raw)
        except ValueError:
            continue
    return None


@F.pandas_udf(StringType())
def preloaded_state(pages):
    """The state that a page carries in PRELOADED_STATE, as JSON text; a list's first item, itself JSON text or not, stands for it."""

    def state(page):
        value = assigned(page or "", "PRELOADED_STATE")
        try:
            if isinstance(value, list):
                value = json.loads(value[0]) if value and isinstance(value[0], str) else value[0] if value else None
            return json.dumps(value, ensure_ascii=False) if value is not None else None
        except ValueError:
            return None

    return pages.map(state)
