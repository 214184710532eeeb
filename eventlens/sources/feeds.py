"""Landed source documents -> envelopes, one transform per kind of document.

A document is one row with a ``document`` text column. Rows are judged one by one: a
malformed part yields no envelope, or one the envelope check turns away, and never
stops the others. Entities stay empty until ``fill_entities``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions import jsontext as J
from eventlens.functions.entities import entity_text, normalize_entities
from eventlens.functions.once import with_once
from eventlens.functions.times import rfc2822_ms
from eventlens.registry import Registry

# Cursors of so many sources at most are looked up in a map.
MAX_SOURCES = 1000


def hn_envelopes(items: DataFrame) -> DataFrame:
    """One story item per document; other item types are left out."""
    v = F.col("_v")
    # The filter must not be pushed below the parsing, which would then be done twice.
    parsed = with_once(items.select("document"), "_v", F.try_parse_json("document"))
    stories = parsed.filter(F.try_variant_get(v, "$.type", "string") == "story")
    return _envelopes(
        stories,
        "hn",
        F.concat(F.lit("hn:"), F.try_variant_get(v, "$.id", "string")),
        F.try_multiply(F.try_variant_get(v, "$.time", "bigint"), F.lit(1000)),
        {name: J.field(v, f"$.{name}") for name in ("title", "url", "score")},
    )


def lobsters_envelopes(docs: DataFrame) -> DataFrame:
    """A JSON list of stories per document; anything but a list holds no stories."""
    v = F.col("_v")
    stories = docs.select(
        F.explode(F.try_variant_get(F.try_parse_json("document"), "$", "array<variant>"))
        .alias("_v")
    )
    created = J.string_or_null(J.field(v, "$.created_at"))
    ts_ms = F.when(
        created.rlike(r"^\d{4}-\d{2}-\d{2}"), F.unix_millis(F.try_to_timestamp(created))
    )
    short_id = F.try_variant_get(v, "$.short_id", "string")
    url, tags = J.field(v, "$.url"), J.field(v, "$.tags")
    complete = J.is_object(v) & short_id.isNotNull() & J.field(v, "$.title").isNotNull()
    return _envelopes(
        stories.filter(complete & ts_ms.isNotNull()),
        "lobsters",
        F.concat(F.lit("lobsters:"), short_id),
        ts_ms,
        {
            "title": J.field(v, "$.title"),
            "url": F.when(F.to_json(url) != '""', url),
            "score": J.field(v, "$.score"),
            "tags": F.coalesce(F.when(J.kind(tags) != "VOID", tags), F.parse_json(F.lit("[]"))),
        },
    )


# An item list stands below the channel, or below the root in RDF-style feeds.
_FEED_XML = (
    "channel struct<item:array<struct<title:string,link:string,guid:string,pubDate:string>>>,"
    "item array<struct<title:string,link:string,guid:string,pubDate:string>>"
)


def _feed_items(docs: DataFrame, *keep: str) -> DataFrame:
    parsed = docs.withColumn("_x", F.from_xml(
        "document", _FEED_XML, {"ignoreSurroundingSpaces": "false"}))
    items = F.concat(*[
        F.coalesce(c, F.array()) for c in (F.col("_x.channel.item"), F.col("_x.item"))
    ])
    return parsed.select(*keep, F.explode(items).alias("item")).select(*keep, "item.*")


def _nonempty(c: Column) -> Column:
    return F.when(c != "", c)


def rss_envelopes(docs: DataFrame, ingest_ms: str = "ingest_ms") -> DataFrame:
    """Every item of an RSS document; the guid, else the link, names the event."""
    c = F.col
    name = F.coalesce(_nonempty(c("guid")), c("link"), F.lit("None"))
    return _envelopes(
        _feed_items(docs, ingest_ms),
        "rss",
        F.concat(F.lit("rss:"), name),
        F.coalesce(rfc2822_ms(c("pubDate")), c(ingest_ms)),
        {"title": c("title"), "link": c("link")},
    )


def news_envelopes(docs: DataFrame, ingest_ms: str = "ingest_ms") -> DataFrame:
    """Titled items of a per-symbol headline feed: one event per symbol and article."""
    c = F.col
    items = _feed_items(docs, "symbol", ingest_ms).filter(c("title") != "")
    name = F.coalesce(_nonempty(c("guid")), _nonempty(c("link")), c("title"))
    return _envelopes(
        items,
        "news",
        F.concat_ws(":", F.lit("news"), "symbol", name),
        F.coalesce(rfc2822_ms(c("pubDate")), c(ingest_ms)),
        {"symbol": c("symbol"), "title": c("title"), "link": c("link")},
    )


def stocks_envelopes(docs: DataFrame, ingest_ms: str = "ingest_ms") -> DataFrame:
    """The first quote of a chart document; without a price there is no event."""
    meta = F.col("_meta")
    quotes = with_once(
        docs, "_meta",
        F.try_variant_get(F.try_parse_json("document"), "$.chart.result[0].meta", "variant")
    ).withColumn("_price", F.try_variant_get(meta, "$.regularMarketPrice", "double"))
    seconds = F.try_variant_get(meta, "$.regularMarketTime", "double")
    ts_ms = F.coalesce((seconds * 1000).try_cast("bigint"), F.col(ingest_ms))
    symbol = F.to_json(F.struct(F.col("symbol").alias("s")))
    return _envelopes(
        quotes.filter(F.col("_price").isNotNull()),
        "stocks",
        F.concat_ws(":", F.lit("stocks"), "symbol", ts_ms.cast("string")),
        ts_ms,
        {
            # A field the quote lacks has a default; one it sets to null stays null.
            "symbol": F.coalesce(J.field(meta, "$.symbol"), J.field(F.parse_json(symbol), "$.s")),
            "price": F.col("_price"),
            "currency": F.coalesce(J.field(meta, "$.currency"), F.parse_json(F.lit('"USD"'))),
        },
    )


def _envelopes(rows: DataFrame, source: str, event_id: Column, ts_ms: Column,
               payload: dict[str, Column]) -> DataFrame:
    body = F.struct(*[c.alias(name) for name, c in payload.items()])
    return rows.select(
        event_id.alias("event_id"),
        F.lit(source).alias("source"),
        F.array().cast("array<string>").alias("entities"),
        ts_ms.alias("ts_ms"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"),
    )


def newer_than(envelopes: DataFrame, cursors: DataFrame) -> DataFrame:
    """Rows past their source's cursor; a source without a cursor keeps all its rows.

    ``cursors`` has one row per source. Up to ``MAX_SOURCES`` they are looked up in a map, so the
    envelopes stay where they are; beyond that both are joined.
    """
    known = cursors.select("source", "cursor_ms").filter("source IS NOT NULL")
    rows = known.limit(MAX_SOURCES + 1).collect()
    if len(rows) <= MAX_SOURCES:
        furthest: dict[str, int | None] = {}
        for r in rows:
            if r.cursor_ms is not None:
                furthest[r.source] = max(r.cursor_ms, furthest.get(r.source, r.cursor_ms))
        pairs = [F.lit(x) for source, at in furthest.items() for x in (source, at)]
        found = F.try_element_at(F.create_map(*pairs), F.col("source")) if pairs else F.lit(None)
        return envelopes.filter(found.isNull() | (F.col("ts_ms") > found) | F.col("ts_ms").isNull())
    seen = known.groupBy(F.col("source").alias("_source")).agg(F.max("cursor_ms").alias("_cursor_ms"))
    return (
        envelopes.join(seen, F.col("source") == F.col("_source"), "left")
        .filter(F.col("_cursor_ms").isNull() | (F.col("ts_ms") > F.col("_cursor_ms"))
                | F.col("ts_ms").isNull())
        .drop("_source", "_cursor_ms")
    )


def fill_entities(envelopes: DataFrame, registry: Registry) -> DataFrame:
    """Entities recomputed from the payload by each source's own extractor.

    A source the registry does not know has no text to extract from, so it ends up with
    none. Whatever the envelope carried before is overwritten.
    """
    found = F.array().cast("array<string>")
    for src in registry:
        text = entity_text(F.col("payload"), src.text_fields)
        found = F.when(F.col("source") == src.name, src.extractor(text)).otherwise(found)
    return envelopes.withColumn("entities", normalize_entities(found))


