"""Envelope and payload checks, compiled to one array-of-messages column."""

from __future__ import annotations

import re

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions import jsontext as J
from eventlens.functions.once import with_once
from eventlens.registry import Registry
from eventlens.sources.bus import to_dlq

_KEYWORDS = {"$schema", "title", "description", "type", "required", "properties", "items",
             "additionalProperties"}
_TYPES = {"string", "number", "integer", "boolean", "object", "array", "null"}


class _Facts:
    """The JSON type of every path a check looks at, each worked out once per row.

    The columns go into a projection of their own, so the checks above it compare short
    texts and do not walk the value again.
    """

    def __init__(self, text: Column, v: Column) -> None:
        self.text = text
        self.v = v
        self.columns: dict[str, Column] = {}
        self._names: dict[str, str] = {}

    def kind(self, path: str) -> Column:
        if path not in self._names:
            self._names[path] = f"_kind{len(self._names)}"
            self.columns[self._names[path]] = J.kind(J.field(self.v, path))
        return F.col(self._names[path])

    def string(self, path: str) -> Column:
        """The text at a path if it is a JSON string."""
        name = f"_text_{path.strip('$.')}"
        self.columns[name] = J.string_or_null(J.field(self.v, path))
        return F.col(name)


def _envelope_problems(facts: _Facts) -> Column:
    entities = F.try_variant_get(facts.v, "$.entities", "array<variant>")
    texts_only = ~F.exists(entities, lambda e: J.kind(e) != "STRING")
    ts_kind = facts.kind("$.ts_ms")
    # Whole numbers beyond 64 bits are decimals, and so is 1.0: the text decides.
    whole = F.when(ts_kind == "BIGINT", True).when(
        F.startswith(ts_kind, F.lit("DECIMAL")),
        F.get_json_object(facts.text, "$.ts_ms").rlike(r"^-?\d+$"),
    )
    shape = _messages([
        (~_sure(facts.string("$.event_id") != ""), F.lit("event_id missing or not a string")),
        (~_sure(facts.string("$.source") != ""), F.lit("source missing or not a string")),
        (~_sure(texts_only), F.lit("entities not a list of strings")),
        (~_sure(whole), F.lit("ts_ms not an integer")),
        (~_is(facts.kind("$.payload"), "OBJECT"), F.lit("payload not an object")),
    ])
    return F.when(_is(facts.kind("$"), "OBJECT"), shape).otherwise(
        F.array(F.lit("envelope is not an object"))
    )


def _inside(at: str, name: str) -> str:
    """The JSON path of a property, whatever characters are in its name."""
    if re.fullmatch(r"[A-Za-z_]\w*", name):
        return f"{at}.{name}"
    if "'" in name and '"' in name:
        raise ValueError(f"a property name with both quotes: {name}")
    quote = '"' if "'" in name else "'"
    return f"{at}[{quote}{name}{quote}]"


def _payload_problems(facts: _Facts, schema: dict, at: str) -> list[Column]:
    """Message lists of the JSON-Schema subset ``type, required, properties, items``, for
    the value at the JSON path ``at``. Any other keyword raises while the plan is built.
    """
    unknown = set(schema) - _KEYWORDS
    if unknown or schema.get("additionalProperties", True) is not True:
        raise ValueError(f"unsupported schema keywords at {at}: {sorted(unknown) or schema}")
    kind, value = facts.kind(at), J.field(facts.v, at)
    out: list[Column] = []
    # Messages come in the order the schema lists its keywords.
    for keyword, rule in schema.items():
        if keyword == "type":
            names = [rule] if isinstance(rule, str) else list(rule)
            shown = _shown(kind, value, F.get_json_object(facts.text, at))
            out.append(_messages([
                (kind.isNotNull() & ~_has_type(kind, value, names), _wrong_type(shown, names))
            ]))
        elif keyword == "required":
            out.append(_messages([
                (_is(kind, "OBJECT") & facts.kind(_inside(at, name)).isNull(),
                 F.lit(f"{name!r} is a required property"))
                for name in rule
            ]))
        elif keyword == "properties":
            for name, sub in rule.items():
                out.extend(_payload_problems(facts, sub, _inside(at, name)))
        elif keyword == "items":
            if set(rule) != {"type"}:
                raise ValueError(f"unsupported items schema at {at}: {rule}")
            names = [rule["type"]] if isinstance(rule["type"], str) else list(rule["type"])
            bad = F.filter(F.try_variant_get(facts.v, at, "array<variant>"),
                           lambda e: ~_has_type(J.kind(e), e, names))
            out.append(F.coalesce(F.transform(
                bad, lambda e: _wrong_type(_shown(J.kind(e), e, F.to_json(e)), names)
            ), _empty()))
    return out


def _has_type(kind: Column, value: Column, names: list[str]) -> Column:
    if not set(names) <= _TYPES:
        raise ValueError(f"unknown types: {sorted(set(names) - _TYPES)}")
    exact = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}
    prefixes = {"object": "OBJECT", "array": "ARRAY"}
    hit = kind.isin(*[exact[n] for n in names if n in exact], "")
    for name in names:
        if name in prefixes:
            hit = hit | F.startswith(kind, F.lit(prefixes[name]))
        elif name == "number":
            hit = hit | kind.isin("BIGINT", "DOUBLE") | F.startswith(kind, F.lit("DECIMAL"))
        elif name == "integer":
            # A decimal is shown without trailing zeros, so 1.0 has scale 0.
            number = value.try_cast("double")
            hit = hit | kind.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$") | F.when(
                kind == "DOUBLE", number == F.floor(number)).otherwise(False)
    return hit


def _wrong_type(shown: Column, names: list[str]) -> Column:
    return F.concat(shown, F.lit(" is not of type " + ", ".join(map(repr, names))))


def _shown(kind: Column, value: Column, number_text: Column) -> Column:
    """The offending value the way the messages print it: quoted text, True, None, 2.5."""
    single, double = F.lit("'"), F.lit('"')
    text = F.replace(value.try_cast("string"), F.lit("\\"), F.lit("\\\\"))
    for char, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(char), F.lit(escape))
    # The one-element array gives the escaped text a name.
    quoted = F.transform(F.array(text), lambda t: F.when(
        F.contains(t, single) & ~F.contains(t, double), F.concat(double, t, double)
    ).otherwise(F.concat(single, F.replace(t, single, F.lit("\\'")), single)))
    return (
        F.when(kind == "STRING", F.element_at(quoted, 1))
        .when(kind == "BOOLEAN", F.initcap(value.try_cast("string")))
        .when(kind == "VOID", F.lit("None"))
        .otherwise(F.coalesce(number_text, F.to_json(value)))
    )


def payload_problems(frame: DataFrame, schema: dict | None, payload: str = "payload") -> DataFrame:
    """Adds ``problems`` of the JSON text in ``payload`` against one schema."""
    if schema is None:
        return frame.withColumn("problems", _empty())
    facts = _Facts(F.col(payload), F.col("_v"))
    found = F.concat(_empty(), *_payload_problems(facts, schema, "$"))
    return _with_problems(frame, payload, facts, found)


def check(frame: DataFrame, registry: Registry, value: str = "value") -> DataFrame:
    """Adds ``problems``: envelope messages, or payload messages if the envelope is clean."""
    facts = _Facts(F.col(value), F.col("_v"))
    shape = _envelope_problems(facts)
    source = facts.string("$.source")
    # Sources with the same contract share one branch.
    contracts: dict[str, tuple[dict, list[str]]] = {}
    for src in registry:
        if src.payload_schema is not None:
            key = json.dumps(src.payload_schema)
            contracts.setdefault(key, (src.payload_schema, []))[1].append(src.name)
    found = _empty()
    for schema, names in contracts.values():
        messages = F.concat(_empty(), *_payload_problems(facts, schema, "$.payload"))
        found = F.when(source.isin(*names), messages).otherwise(found)
    problems = F.when(F.size("_shape") > 0, F.col("_shape")).otherwise(found)
    return _with_problems(frame, value, facts, problems, shape)


def _with_problems(frame: DataFrame, text: str, facts: _Facts, problems: Column,
                   shape: Column | None = None) -> DataFrame:
    rows = frame.withColumn("_v", F.try_parse_json(text)).withColumns(facts.columns)
    if shape is not None:
        rows = rows.withColumn("_shape", shape)
    return with_once(rows, "problems", problems).select(*frame.columns, "problems")


def reason(problems: Column) -> Column:
    return F.concat(F.lit("schema: "), F.array_join(problems, "; "))


def route(frame: DataFrame, registry: Registry) -> tuple[DataFrame, DataFrame]:
    """Splits rows by their ``value`` text into (valid, dead-letter records)."""
    checked = check(frame, registry)
    good = checked.filter(F.size("problems") == 0).drop("problems")
    bad = checked.filter(F.size("problems") > 0).withColumn("reason", reason(F.col("problems")))
    return good, to_dlq(bad)


def _messages(rules: list[tuple[Column, Column]]) -> Column:
    return F.filter(F.array(*[F.when(bad, text) for bad, text in rules]),
                    lambda m: m.isNotNull())


def _is(kind: Column, prefix: str) -> Column:
    return _sure(F.startswith(kind, F.lit(prefix)))


def _sure(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _empty() -> Column:
    return F.array().cast("array<string>")
