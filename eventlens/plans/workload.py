"""The given tables seen as envelopes, bus rows and landed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions import jsontext as J
from eventlens.registry import Registry, Source
from eventlens.sources.bus import bus_topic, dlq_topic, error_headers, record_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per event: source = event type, entity = user, every fifth without."""
    c = F.col
    return table(spark, sf_dir, "events").select(
        F.concat_ws(":", "event_type", c("event_id").cast("string")).alias("event_id"),
        c("event_type").alias("source"),
        F.when(c("event_id") % 5 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("U"), c("user_id").cast("string"))))
        .alias("entities"),
        F.unix_millis(c("ts").cast("timestamp")).alias("ts_ms"),
        c("props").alias("payload"),
    )


def bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bus_rows(table(spark, sf_dir, "events"))


def bus_rows(events: DataFrame) -> DataFrame:
    """The same events as bus rows, every 97th broken and dead-lettered."""
    c = F.col
    broken = c("event_id") % 97 == 0
    ts_ms = F.unix_millis(c("ts").cast("timestamp"))
    own_id = F.concat_ws(":", "event_type", c("event_id").cast("string"))
    entities = F.when(
        c("event_id") % 5 == 0, F.array().cast("array<string>")
    ).otherwise(F.array(F.concat(F.lit("U"), c("user_id").cast("string"))))
    value = J.serialize(own_id, c("event_type"), entities,
                        F.when(~broken, ts_ms), c("props"))
    return events.select(
        F.when(broken, dlq_topic(c("event_type"))).otherwise(bus_topic(c("event_type")))
        .alias("topic"),
        (c("event_id") % 6).cast("int").alias("partition"),
        F.floor(c("event_id") / 6).alias("offset"),
        record_key(entities, own_id).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.when(broken, error_headers(F.lit("schema: ts_ms not an integer"))).alias("headers"),
        c("ts").cast("timestamp").alias("timestamp"),
    )


def registry() -> Registry:
    """The event types as configured sources, plus one that never sent anything."""
    schema = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer"}}}
    names = ("click", "error", "ghost", "purchase", "signup", "view")
    return Registry(tuple(
        Source(n, f"events.{n}", "60s" if n < "m" else "5m", ("k",), payload_schema=schema)
        for n in names
    ))
