"""Extracted documents: aliases, legal paths, enum domains, warnings.

A document is JSON text. The schema is a parameter: a table of legal (path, value) pairs, so that one source gives the legal
fields and the enum domains.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siltstone.functions.classify import failure_mode

#: Aliases of enum values, by path; '[]' is each item of a list.
ALIASES = {
    "entertainment.live_music": {"live_dj": "dj", "live_band": "band", "live_acoustic": "acoustic", "variable": "none", "background": "none"},
    "service.staff_friendliness": {"friendly": "warm", "courteous": "polite", "professional": "polite"},
    "atmosphere.decor_character": {"minimalist": "minimal"},
    "atmosphere.seating_comfort": {"comfortable": "acceptable"},
    "atmosphere.music_type": {"live_tabla": "live_acoustic", "live_dj": "live_dj"},
    "value.portion_size": {"moderate": "adequate", "sufficient": "adequate"},
    "dishes[].portion": {"sufficient": "adequate", "moderate": "adequate"},
    "dishes[].presentation": {"classic": "standard"},
    "reviewer_signal.reviewer_type": {"business_traveler": "casual_diner", "food_blogger": "influencer_style"},
    "cross_dish_consistency_signal": {"consistent_good": "consistent_across_dishes", "consistent": "consistent_across_dishes", "inconsistent": "mixed_performance"},
}
#: Atmosphere fields that no schema has.
JUNK = ("ambience", "ambiance", "ambience_quality", "ambience_signal", "ambience_comment", "ambiance_score", "ambience_score", "seating_score")


def targets(doc: dict, path: str) -> list[tuple[dict, str]]:
    """The objects that hold a path's last name."""
    *steps, name = path.split(".")
    found: list = [doc]
    for step in steps:
        many = step.endswith("[]")
        inner = [f.get(step.removesuffix("[]")) for f in found]
        found = [x for value in inner for x in (value if many and isinstance(value, list) else [] if many else [value]) if isinstance(x, dict)]
    return [(f, name) for f in found]


def moves(doc: dict) -> None:
    """Values that stand under a wrong name go to the right one."""
    section = lambda name: doc.get(name) if isinstance(doc.get(name), dict) else {}
    context, cuisine, bar = section("context"), section("cuisine"), section("bar")
    if context.get("visit_type") == "one_time_visitor":
        reviewer = doc.setdefault("reviewer_signal", {})
        if isinstance(reviewer, dict):
            reviewer["reviewer_type"] = reviewer.get("reviewer_type") or "one_time_visitor"
        del context["visit_type"]
    if cuisine.get("menu_breadth") == "extensive_but_coherent":
        cuisine["cuisine_specialization_clarity"] = cuisine.pop("menu_breadth")
    if bar.get("alcohol_identity_signal") == "none":
        del bar["alcohol_identity_signal"]
        if not bar:
            del doc["bar"]
    for dish in doc["dishes"] if isinstance(doc.get("dishes"), list) else ():
        if isinstance(dish, dict) and "portion_size" in dish and "portion" not in dish:
            dish["portion"] = dish.pop("portion_size")
        if isinstance(dish, dict) and not dish.get("dish_function", True):
            del dish["dish_function"]
    for junk in JUNK:
        section("atmosphere").pop(junk, None)


def normalised(doc: object, fired: list[str]) -> object:
    """A document with values moved and aliases replaced; the cross-dish signal goes unless its trigger fired."""
    if not isinstance(doc, dict):
        return doc
    if "cross_dish_consistency_signal" not in fired:
        doc.pop("cross_dish_consistency_signal", None)
    moves(doc)
    for path, names in ALIASES.items():
        for holder, name in targets(doc, path):
            if isinstance(holder.get(name), str):
                holder[name] = names.get(holder[name], holder[name])
    return doc


@F.pandas_udf(StringType())
def normalise(documents, fired):
    """``normalised`` on JSON text; text that is none stays as it is."""

    def run(text, names):
        try:
            return json.dumps(normalised(json.loads(text), list(names) if names is not None else []), ensure_ascii=False)
        except (TypeError, ValueError):
            return text

    return documents.combine(fired, run)


def leaves(value: object, path: str = "") -> list[tuple[str, str]]:
    """(path, value) of the scalars of a document; '[]' stands for a list's items."""
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in leaves(v, f"{path}.{k}" if path else k)]
    if isinstance(value, list):
        return [x for v in value for x in leaves(v, f"{path}[]")]
    return [] if value is None else [(path, value if isinstance(value, str) else json.dumps(value))]


def on_json(f: Callable[[object], list], schema: str):
    @F.pandas_udf(schema)
    def run(documents):
        def one(text):
            try:
                return f(json.loads(text))
            except (TypeError, ValueError):
                return []

        return documents.map(one)

    return run


def path_values(document: Column) -> Column:
    return on_json(lambda d: [{"path": p, "value": v} for p, v in leaves(d)], "array<struct<path: string, value: string>>")(document)


def unknown_fields(document: Column, legal: dict[str, list[str]], items: str = "[]") -> Column:
    """Names that ``legal`` (fields by section) has not: whole sections, and fields of sections and of their lists' items ('sec[].f'; ``items`` '' gives 'sec.f')."""

    def find(doc: object) -> list[str]:
        out = []
        for section, value in doc.items() if isinstance(doc, dict) else ():
            if section not in legal:
                out.append(section)
                continue
            holders = [(value, "")] if isinstance(value, dict) else [(v, items) for v in value if isinstance(v, dict)] if isinstance(value, list) else []
            out += [f"{section}{mark}.{k}" for holder, mark in holders for k in holder if k not in legal[section] and k != "span"]
        return out

    return on_json(find, "array<string>")(document)


def legal_names(schema) -> set[str]:
    """All field names of a struct type, at any depth."""
    out: set[str] = set()
    waiting = [schema]
    while waiting:
        kind = waiting.pop()
        kind = getattr(kind, "elementType", kind)
        for f in getattr(kind, "fields", ()):
            out.add(f.name)
            waiting.append(f.dataType)
    return out


def schema_rules(schema: dict, legal_scalars: bool = False) -> list[tuple[str, str, str | None]]:
    """(path, rule, value) of a JSON schema: a 'field' of each object ('[]' for a list's items), its 'type's, 'enum' values, and whether it is 'required'.

    References and unions are followed; a definition within itself is followed once. ``legal_scalars``: top-level fields that hold no object
    count as sections, too (variant B); else only those that do (variant A).
    """
    out: list[tuple[str, str, str | None]] = []

    def options(node: dict, seen: tuple[str, ...]) -> list[tuple[dict, tuple[str, ...]]]:
        ref = node.get("$ref")
        if ref:
            name = ref.rsplit("/", 1)[-1]
            found = schema.get("$defs", schema.get("definitions", {})).get(name)
            return [] if found is None or name in seen else options(found, (*seen, name))
        listed = [x for key in ("anyOf", "oneOf", "allOf") for x in node.get(key, ())]
        return [y for x in listed for y in options(x, seen)] if listed else [(node, seen)]

    def walk(node: dict, path: str, seen: tuple[str, ...]) -> bool:
        """Whether the node holds an object somewhere."""
        holds = False
        for part, known in options(node, seen):
            kind = part.get("type") or ("object" if "properties" in part else None)
            if path and kind:
                out.extend((path, "type", k) for k in ([kind] if isinstance(kind, str) else kind))
            values = part["enum"] if "enum" in part else [part["const"]] if "const" in part else []
            out.extend((path, "enum", v if isinstance(v, str) else json.dumps(v)) for v in values)
            for name, inner in part.get("properties", {}).items():
                below = f"{path}.{name}" if path else name
                if walk(inner, below, known) or path or legal_scalars:
                    out.append((below, "field", None))
                if name in part.get("required", ()):
                    out.append((below, "required", None))
            holds = holds or "properties" in part or isinstance(part.get("items"), dict) and walk(part["items"], f"{path}[]", known)
        return holds

    walk(schema, "", ())
    return sorted(set(out), key=str)


def legal_fields(rules: list[tuple[str, str, str | None]]) -> dict[str, list[str]]:
    """Fields by section, for ``unknown_fields``."""
    paths = [p.replace("[]", "") for p, rule, _ in rules if rule == "field"]
    return {section: sorted({p.split(".")[1] for p in paths if p.count(".") == 1 and p.split(".")[0] == section}) for section in sorted({p.split(".")[0] for p in paths})}


def validated(df: DataFrame, key: str, document: str, rules: DataFrame) -> DataFrame:
    """key, path, kind, value and allowed of what breaks ``rules`` (path, rule, value, as ``schema_rules`` gives): values outside their 'enum', of a wrong
    type ('type'), and 'missing' fields of objects that are there. Unknown fields break none, nulls neither but for required ones."""
    found = df.select(key, F.explode(on_json(lambda d: [{"path": p, "value": v, "type": t} for p, v, t in typed_values(d)], "array<struct<path: string, value: string, type: string>>")(F.col(document))).alias("pv")).select(key, "pv.*")
    of = lambda rule: rules.filter(F.col("rule") == rule)
    listed = lambda rule, name: of(rule).groupBy("path").agg(F.array_sort(F.collect_set("value")).alias(name))
    own = found.join(F.broadcast(listed("enum", "allowed")), "path", "left").join(F.broadcast(listed("type", "types")), "path", "left")
    wrong = F.col("types").isNotNull() & ~F.exists("types", lambda t: (t == F.col("type")) | (t == "number") & (F.col("type") == "integer"))
    outside = F.col("allowed").isNotNull() & ~F.array_contains("allowed", F.col("value"))
    kind = F.when(F.col("type") == "null", F.lit(None)).when(wrong, "type").when(outside, "enum")
    bad = own.withColumn("kind", kind).filter("kind is not null").select(key, "path", "kind", "value", F.when(F.col("kind") == "enum", F.col("allowed")).otherwise(F.col("types")).alias("allowed"))
    parent = lambda p: F.when(p.contains("."), F.regexp_replace(p, r"\.[^.]*$", "")).otherwise("")
    wanted = of("required").select(F.col("path").alias("wanted"), parent(F.col("path")).alias("path"))
    holders = df.select(key, F.explode(on_json(lambda d: [{"path": p, "names": n} for p, n in objects(d)], "array<struct<path: string, names: array<string>>>")(F.col(document))).alias("o")).select(key, "o.*")
    lacking = holders.join(F.broadcast(wanted), "path").filter(~F.array_contains("names", F.substring_index("wanted", ".", -1)))
    none = F.array().cast("array<string>")
    return bad.unionByName(lacking.select(key, F.col("wanted").alias("path"), F.lit("missing").alias("kind"), F.lit(None).cast("string").alias("value"), none.alias("allowed")))


def typed_values(value: object, path: str = "") -> list[tuple[str, str, str]]:
    """(path, value, JSON type) of everything below a document's root."""
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", float: "number"}.get(type(value), "null")
    own = [(path, value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), kind)] if path else []
    if isinstance(value, dict):
        return own + [x for k, v in value.items() for x in typed_values(v, f"{path}.{k}" if path else k)]
    if isinstance(value, list):
        return own + [x for v in value for x in typed_values(v, f"{path}[]")]
    return own


def objects(value: object, path: str = "") -> list[tuple[str, list[str]]]:
    """(path, names that aren't null) of a document's objects."""
    if isinstance(value, dict):
        return [(path, [k for k, v in value.items() if v is not None]), *(x for k, v in value.items() for x in objects(v, f"{path}.{k}" if path else k))]
    return [x for v in value for x in objects(v, f"{path}[]")] if isinstance(value, list) else []


def enum_violations(df: DataFrame, key: str, document: str, domain: DataFrame) -> DataFrame:
    """key, path, value of the values that ``domain`` (path, value) names the path of, but not the value."""
    found = df.select(key, F.explode(path_values(F.col(document))).alias("pv")).select(key, "pv.path", "pv.value")
    return found.join(domain.select("path").distinct(), "path", "left_semi").join(domain, ["path", "value"], "left_anti").select(key, "path", "value")


def missing_required(df: DataFrame, key: str, document: str, required: dict[str, list[str]]) -> DataFrame:
    """key and path of the fields that a section's objects must have and lack."""

    def find(doc: object) -> list[str]:
        out = []
        for section, names in required.items():
            value = doc.get(section) if isinstance(doc, dict) else None
            holders = [value] if isinstance(value, dict) else [v for v in value if isinstance(v, dict)] if isinstance(value, list) else []
            out += [f"{section}.{n}" for h in holders for n in names if h.get(n) is None]
        return out

    return df.select(key, F.explode(on_json(find, "array<string>")(F.col(document))).alias("path"))


def warnings(text: Column) -> Column:
    """A validation message's blocks as path, kind, value, allowed values and the path's head."""
    blocks = F.filter(F.split(text, r"\n(?=[a-zA-Z_][\w\.]*\n)"), lambda b: F.trim(F.substring_index(b, "\n", 1)) != "")

    def read(block: Column) -> Column:
        path = F.trim(F.substring_index(block, "\n", 1))
        rest = F.regexp_replace(F.substr(block, F.length(F.substring_index(block, "\n", 1)) + 1), r"\s*\n\s*", " ")
        detail = r"\[type=([a-z_]+),\s+input_value=(.*?),\s+input_type="
        should = F.regexp_extract(rest, r"Input should be\s+(.*?)\s+\[type=", 1)
        kind = F.coalesce(F.nullif(F.regexp_extract(rest, detail, 1), F.lit("")), F.lit("unknown"))
        return F.struct(path.alias("path"), kind.alias("kind"), F.nullif(F.regexp_extract(rest, detail, 2), F.lit("")).alias("value"), F.regexp_extract_all(should, F.lit("'([^']+)'"), F.lit(1)).alias("allowed"), F.regexp_replace(path, r"[.\[].*$", "").alias("section"), failure_mode(kind).alias("mode"))

    return F.filter(F.transform(blocks, read), lambda w: ~w.path.startswith("pydantic_validation"))


def record_class(document: Column) -> Column:
    """api_error, parse_error, empty or extracted."""
    has = lambda name: F.coalesce(F.array_contains(F.json_object_keys(document), name), F.lit(False))
    return F.when(has("_error"), "api_error").when(has("_parse_error"), "parse_error").when(F.coalesce(F.size(F.json_object_keys(document)), F.lit(0)) <= 0, "empty").otherwise("extracted")


def with_authority(document: Column, version: str, fired: Column, effort: Column) -> Column:
    """The document with what is known without a model: schema version (if it names none), fired triggers and effort."""
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    known = F.create_map(F.lit("t2_triggers_fired"), F.to_json(fired), F.lit("review_effort_signal"), quoted(effort))
    return merge_known(document, known, F.lit(version))


@F.pandas_udf(StringType())
def merge_known(documents, known, versions):
    def run(text, values, version):
        try:
            doc = json.loads(text)
        except (TypeError, ValueError):
            return text
        if isinstance(doc, dict):
            doc.setdefault("schema_version", version)
            doc["t2_triggers_fired"] = json.loads(values["t2_triggers_fired"])
            signal = doc.setdefault("reviewer_signal", {})
            if isinstance(signal, dict):
                signal["review_effort_signal"] = json.loads(values["review_effort_signal"])
        return json.dumps(doc, ensure_ascii=False)

    import pandas as pd

    return pd.Series([run(*row) for row in zip(documents, map(dict, known), versions, strict=True)], dtype=object)


def section_coverage(df: DataFrame, document: str) -> DataFrame:
    """How many extracted documents fill each section."""
    good = df.filter(record_class(F.col(document)) == "extracted")
    return good.select(F.explode(F.json_object_keys(document)).alias("section")).groupBy("section").agg(F.count(F.lit(1)).alias("n"))


def run_summary(df: DataFrame, document: str, warned: Column, tokens_in: Column, tokens_out: Column) -> DataFrame:
    """One row on a run: classes of records, warnings, tokens and cost."""
    from siltstone.operators.aggregate import token_cost

    kind = record_class(F.col(document))
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in (tokens_in, tokens_out)]
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(kind == k).alias(f"n_{k}") for k in ("api_error", "parse_error", "empty", "extracted")], F.count_if(warned).alias("n_warned"), sums[0].alias("tokens_in"), sums[1].alias("tokens_out"), F.round(token_cost(*sums), 6).alias("cost"))


def compact(df: DataFrame, document: str, keep: list[str]) -> DataFrame:
    """Few columns for browsing; empty values drop out of documents, failed ones become their error."""
    from siltstone.functions.jsons import strip_nulls

    error = F.get_json_object(document, "$._error")
    short = F.when(error.isNotNull(), F.to_json(F.struct(error.alias("_error")))).otherwise(strip_nulls(F.col(document)))
    return df.select(*keep, short.alias("extracted"))


def describe_schema(schema, indent: int = 0) -> str:
    """A struct type as indented text, for prompts."""
    pad, out = "  " * indent, []
    for f in schema.fields:
        inner = f.dataType
        many = hasattr(inner, "elementType")
        inner = inner.elementType if many else inner
        mark = "[]" if many else ""
        out += [f"{pad}{f.name}{mark}:", describe_schema(inner, indent + 1)] if hasattr(inner, "fields") else [f"{pad}{f.name}{mark}: {inner.simpleString()}"]
    return "\n".join(out)


def field_specification(rules: list[tuple[str, str, str | None]], sections: tuple[str, ...] = ()) -> str:
    """What a prompt says of the fields of some sections (all, if none is named): types, legal values, and which are required; a line a field."""
    paths = [p for p, rule, _ in rules if rule == "type"]
    tops = sections or tuple(sorted({re.split(r"[.\[]", p)[0] for p in paths}))
    out = []
    for top in tops:
        for path in sorted({p for p in paths if re.split(r"[.\[]", p)[0] == top}):
            of = lambda wanted: [v for p, rule, v in rules if p == path and rule == wanted]  # noqa: B023, E731
            kinds = [k for k in of("type") if k not in ("null", "array")]
            if kinds:
                values = " | ".join(of("enum"))
                name = path if "." not in path else "  " * path.count(".") + path.rsplit(".", 1)[1]
                out.append(f"{name}: {' or '.join(kinds)}{f' ({values})' if values else ''}{', required' if of('required') and '.' in path else ''}")
    return "\n".join(out)


def prompt(rating: Column, fired: Column, text: Column) -> Column:
    """What a model is asked about one review."""
    shown = F.regexp_replace(F.format_string("%.2f", rating.cast("double")), r"\.?0+$", "")
    shown = F.when(rating.isNotNull(), shown)
    names = F.when(F.size(fired) > 0, F.array_join(fired, ", ")).otherwise("none")
    return F.concat_ws("\n", F.concat(F.lit("Rating: "), F.coalesce(shown, F.lit("none"))), F.concat(F.lit("Triggers: "), names), F.lit("Review:"), F.coalesce(text, F.lit("")))
