"""The sources a deployment knows about, as plain configuration."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from eventlens.functions.entities import cashtags, symbol_tokens, tickers


@dataclass(frozen=True)
class Source:
    name: str
    topic: str
    interval: str
    text_fields: tuple[str, ...] = ()
    # Column -> Column; a pandas_udf returning array<string> fits as well.
    extractor: Callable[[Column], Column] = cashtags
    payload_schema: dict | None = None

    @property
    def dlq_topic(self) -> str:
        return f"{self.topic}.dlq"


@dataclass(frozen=True)
class Registry:
    sources: tuple[Source, ...]

    def __iter__(self):
        return iter(sorted(self.sources, key=lambda s: s.name))

    def frame(self, spark: SparkSession) -> DataFrame:
        """name, topic, interval: one row per configured source."""
        rows = [(s.name, s.topic, s.interval) for s in self]
        return spark.createDataFrame(rows, "name string, topic string, interval string")


# Payload contracts of the five built-in sources.
_STRING = {"type": "string"}
_STRING_OR_NULL = {"type": ["string", "null"]}
PAYLOAD_SCHEMAS: dict[str, dict] = {
    "hn": {
        "type": "object",
        "required": ["title"],
        "properties": {"title": _STRING, "url": _STRING, "score": {"type": "integer"}},
    },
    "lobsters": {
        "type": "object",
        "required": ["title"],
        "properties": {
            "title": _STRING,
            "url": _STRING_OR_NULL,
            "score": {"type": ["integer", "null"]},
            "tags": {"type": "array", "items": _STRING},
        },
        "additionalProperties": True,
    },
    "news": {
        "type": "object",
        "required": ["symbol", "title"],
        "properties": {"symbol": _STRING, "title": _STRING, "link": _STRING_OR_NULL},
        "additionalProperties": True,
    },
    "rss": {"type": "object", "properties": {"title": _STRING, "link": _STRING}},
    "stocks": {
        "type": "object",
        "required": ["symbol", "price"],
        "properties": {
            "symbol": _STRING,
            "price": {"type": "number"},
            "currency": _STRING,
            "change": {"type": "number"},
            "volume": {"type": "integer"},
        },
        "additionalProperties": True,
    },
}


def default_registry() -> Registry:
    """Stories, feeds, headlines and quotes, with their poll intervals."""
    def source(name, interval, fields, extractor):
        return Source(name, f"events.{name}", interval, fields, extractor, PAYLOAD_SCHEMAS[name])

    return Registry((
        source("hn", "60s", ("title", "url"), cashtags),
        source("lobsters", "5m", ("title", "url"), cashtags),
        source("news", "2m", ("symbol",), symbol_tokens),
        source("rss", "5m", ("title", "link"), cashtags),
        source("stocks", "60s", ("symbol",), tickers),
    ))
