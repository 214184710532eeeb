"""Helpers over JSON text and VARIANT values of unknown shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def kind(value: Column) -> Column:
    """VARIANT type name: STRING, BIGINT, DECIMAL(p,s), OBJECT<..>, VOID; null when missing."""
    return F.schema_of_variant(value)


def field(value: Column, path: str) -> Column:
    return F.variant_get(value, path, "variant")


def is_object(value: Column) -> Column:
    return F.coalesce(F.startswith(kind(value), F.lit("OBJECT")), F.lit(False))


def string_or_null(value: Column) -> Column:
    """The text of a JSON string; null for any other JSON value."""
    return F.when(kind(value) == "STRING", value.cast("string"))


def serialize(envelope_id: Column, source: Column, entities: Column, ts_ms: Column,
              payload: Column) -> Column:
    """Envelope as JSON text with sorted keys at every level.

    A payload that is no JSON is carried as ``{"raw": text}``, so it is never lost.
    """
    # Object keys of a VARIANT are kept sorted, so only this struct's order matters.
    return F.to_json(
        F.struct(
            entities.alias("entities"),
            envelope_id.alias("event_id"),
            F.coalesce(F.try_parse_json(payload), F.parse_json(F.to_json(
                F.when(payload.isNotNull(), F.struct(payload.alias("raw")))))).alias("payload"),
            source.alias("source"),
            ts_ms.alias("ts_ms"),
        ),
        {"ignoreNullFields": "false"},
    )


def _cut(text: Column, limit: int | None) -> Column:
    return text if limit is None else F.substring(text, 1, limit)


def spaced_json(text: Column, limit: int | None = None) -> Column:
    """Compact JSON text written with a space after each comma and colon and with non-ASCII
    characters escaped; its first ``limit`` characters if a limit is given."""
    # The result never gets shorter, so only the first `limit` characters matter.
    head = _cut(text, limit)
    # Whole strings (an unfinished last one included) are skipped over, and \G
    # makes every match start where the previous one ended.
    spaced = F.regexp_replace(
        head, r'\G((?:"(?:[^"\\]++|\\.)*+(?:"|\\?$)|[^",:]++)*+)([,:])', "$1$2 "
    )

    def escape(ch: Column) -> Column:
        point = F.ascii(ch)
        unit = lambda n: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n), 4, "0")))
        over = point - 0x10000
        return (
            F.when(point < 0x80, ch)
            .when(point < 0x10000, unit(point))
            .otherwise(F.concat(unit(F.shiftright(over, 10) + 0xD800),
                                unit(over.bitwiseAND(0x3FF) + 0xDC00)))
        )

    escaped = F.array_join(F.transform(F.split(spaced, ""), escape), "")
    return _cut(F.when(spaced.rlike(r"[^\x00-\x7F]"), escaped).otherwise(spaced), limit)


def object_text(text: Column, value: Column) -> Column:
    """Whether JSON text holds an object; ``value`` is its parsed form."""
    # Parsed text is valid JSON, so its first character tells, and no type has to be built.
    return value.isNotNull() & F.startswith(F.ltrim(text), F.lit("{"))


def summary(payload: Column, value: Column | None = None, limit: int | None = None) -> Column:
    """One line a person can scan: a quote, a headline, or the payload itself.

    ``limit`` bounds how much of a payload is shown; without it the payload is whole.
    ``value`` is the parsed payload where the caller already has it in a column.
    """
    if value is None:
        value = F.try_parse_json(payload)

    def has(name: str) -> Column:
        return field(value, f"$.{name}").isNotNull()

    def text(name: str) -> Column:
        return F.get_json_object(payload, f"$.{name}")

    def truthy(name: str) -> Column:
        # JSON null already is SQL null here.
        return ~F.coalesce(text(name), F.lit("")).isin("", "0", "0.0", "false", "[]", "{}")

    none = F.lit("None")
    quote = F.trim(F.concat_ws(
        " ", F.coalesce(text("symbol"), none), F.coalesce(text("price"), none),
        F.when(truthy("currency"), text("currency")).otherwise(""),
    ))
    titled = F.when(
        truthy("symbol"), F.concat(text("symbol"), F.lit(" · "), text("title"))
    ).otherwise(text("title"))
    plain = _cut(F.coalesce(value.cast("string"), payload), limit)
    return (
        F.when(payload.isNull() | (F.trim(payload) == "null"), F.lit(""))
        .when(~object_text(payload, value), plain)
        .when(has("price") & has("symbol"), quote)
        .when(has("title") & truthy("title"), titled)
        .otherwise(spaced_json(F.to_json(value), limit))
    )


def human_bytes(n: Column) -> Column:
    """``512 B``, ``1.5 KiB`` ... ``TiB``."""
    def scaled(power: int, unit: str) -> Column:
        # bround ties to even; format_string alone would round ties up.
        return F.format_string(f"%.1f {unit}", F.bround(n / float(1024 ** power), 1))

    return (
        F.when(n < 1024, F.concat(n.cast("bigint").cast("string"), F.lit(" B")))
        .when(n < 1024 ** 2, scaled(1, "KiB"))
        .when(n < 1024 ** 3, scaled(2, "MiB"))
        .when(n < 1024 ** 4, scaled(3, "GiB"))
        .otherwise(scaled(4, "TiB"))
    )


def pair_label(a_id: Column, b_id: Column) -> Column:
    """``hn × rss`` from ids of the form ``source:...``."""
    def src(c: Column) -> Column:
        return F.split_part(F.coalesce(c, F.lit("")), F.lit(":"), F.lit(1))

    return F.concat(src(a_id), F.lit(" × "), src(b_id))


def error_class(error: Column) -> Column:
    """Text before the first colon; ``-`` when there is no error text."""
    text = F.when(error != "", error)
    return F.split_part(F.coalesce(text, F.lit("-")), F.lit(":"), F.lit(1))
