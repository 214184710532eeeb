"""The message bus: reading topics, parsing envelopes, writing records."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.functions import jsontext as J
from eventlens.functions.once import with_once
from eventlens.functions.times import MAX_TS_MS, MIN_TS_MS, bounded
from eventlens.settings import EVENT_TOPICS, Settings

ERROR_HEADER = "eventlens.error"
ALL_TOPICS = r"events\..+"

ENVELOPE = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("entities", T.ArrayType(T.StringType())),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("payload", T.StringType()),
])

BUS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
    T.StructField("timestamp", T.TimestampType()),
])


def kafka_options(cfg: Settings, pattern: str | None = None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": cfg.bus.servers,
        "subscribePattern": pattern or cfg.bus.topics,
        "startingOffsets": cfg.bus.start,
        "includeHeaders": "true",
    }


def stream_options(cfg: Settings, pattern: str | None = None) -> dict[str, str]:
    """Reading options with a bound on a batch, and on how few tasks read it."""
    options = kafka_options(cfg, pattern) | {"maxOffsetsPerTrigger": str(cfg.bus.batch_rows)}
    return options | ({"minPartitions": str(cfg.bus.tasks)} if cfg.bus.tasks else {})


def read_bus_stream(spark: SparkSession, cfg: Settings, pattern: str | None = None) -> DataFrame:
    return spark.readStream.format("kafka").options(**stream_options(cfg, pattern)).load()


def read_bus(spark: SparkSession, cfg: Settings, pattern: str | None = None) -> DataFrame:
    """Everything the topics hold now, as a batch frame (status, views, backfill)."""
    options = kafka_options(cfg, pattern) | {"startingOffsets": "earliest"}
    return spark.read.format("kafka").options(**options).load()


def tail_ranges(ends: DataFrame, n: int) -> DataFrame:
    """``ends`` (topic, partition, begin_offset, end_offset) cut to the last ``n`` records of each partition."""
    return ends.withColumn("begin_offset", F.greatest("begin_offset", F.col("end_offset") - n))


def range_options(ranges: DataFrame) -> dict[str, str]:
    """The options of a bounded read that opens just these offsets; a row per partition comes here."""
    rows = ranges.select("topic", "partition", "begin_offset", "end_offset").collect()

    def offsets(column: str) -> str:
        out: dict[str, dict[str, int]] = {}
        for r in sorted(rows):
            out.setdefault(r.topic, {})[str(r.partition)] = r[column]
        return json.dumps(out)

    return {"assign": json.dumps({t: sorted(r.partition for r in rows if r.topic == t)
                                  for t in sorted({r.topic for r in rows})}),
            "startingOffsets": offsets("begin_offset"), "endingOffsets": offsets("end_offset")}


def read_ranges(spark: SparkSession, cfg: Settings, ranges: DataFrame) -> DataFrame:
    """The records of these offset ranges, and no others."""
    options = {k: v for k, v in kafka_options(cfg).items() if k != "subscribePattern"} | range_options(ranges)
    return spark.read.format("kafka").options(**options).load()


def within(bus: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows of a bus frame that lie in the ranges."""
    return (bus.join(ranges.select("topic", "partition", "begin_offset", "end_offset"), ["topic", "partition"])
            .filter((F.col("offset") >= F.col("begin_offset")) & (F.col("offset") < F.col("end_offset")))
            .select(*bus.columns))


def topic_filter(bus: DataFrame, pattern: str = EVENT_TOPICS) -> DataFrame:
    """Rows whose whole topic name matches; the default leaves dead-letter topics out."""
    return bus.filter(F.col("topic").rlike(f"^(?:{pattern})$"))


def parse_envelopes(bus: DataFrame, position: bool = False, ahead_ms: int | None = None) -> DataFrame:
    """Envelopes of a bus frame; rows without an id or a usable time are left out.

    A time outside the years 1 to 9999 would overflow timestamp arithmetic and stop a
    stream, so it counts as unusable; ``unparsed`` returns those rows. So does a time that is more
    than ``ahead_ms`` after the record reached the bus: it would move a stream's watermark
    past all other events. ``position`` adds
    a hash of the row's place on the bus, which tells copies of an envelope apart.
    """
    e = F.from_json(F.col("value").cast("string"), ENVELOPE)
    extra = [F.xxhash64("topic", "partition", "offset").alias("position")] if position else []
    arrived = [] if ahead_ms is None else ["timestamp"]
    rows = with_once(bus.select("value", *arrived, *extra), "e", e)
    return rows.filter(_usable("e.", ahead_ms)).select("e.*", *(["position"] if position else []))


def unparsed(bus: DataFrame, ahead_ms: int | None = None) -> DataFrame:
    """Bus rows that ``parse_envelopes`` drops, unchanged."""
    e = F.from_json(F.col("value").cast("string"), ENVELOPE)
    rows = with_once(bus, "_e", e)
    return rows.filter(~F.coalesce(_usable("_e.", ahead_ms), F.lit(False))).drop("_e")


def judged(bus: DataFrame, ahead_ms: int | None = None) -> DataFrame:
    """Every bus row with its envelope ``e`` and whether it is ``usable``, from one parse.

    ``parse_envelopes`` and ``unparsed`` are the two halves of this frame.
    """
    e = F.from_json(F.col("value").cast("string"), ENVELOPE)
    rows = with_once(bus, "e", e)
    return rows.withColumn("usable", F.coalesce(_usable("e.", ahead_ms), F.lit(False)))


def _usable(prefix: str, ahead_ms: int | None) -> Column:
    ts_ms = F.col(f"{prefix}ts_ms")
    usable = F.col(f"{prefix}event_id").isNotNull() & ts_ms.between(MIN_TS_MS, MAX_TS_MS)
    if ahead_ms is not None:
        usable &= F.coalesce(ts_ms <= F.unix_millis("timestamp") + ahead_ms, F.lit(True))
    return usable


def bus_topic(source: Column) -> Column:
    return F.concat(F.lit("events."), source)


def dlq_topic(source: Column) -> Column:
    known = F.when(source != "", source)
    return F.concat(F.lit("events."), F.coalesce(known, F.lit("unknown")), F.lit(".dlq"))


def record_key(entities: Column, event_id: Column) -> Column:
    """First entity, so one entity's events share a partition; else the event id."""
    return F.coalesce(F.try_element_at(entities, F.lit(1)), event_id)


def to_bus(envelopes: DataFrame) -> DataFrame:
    """topic, key, value records ready for the bus."""
    c = F.col
    value = J.serialize(c("event_id"), c("source"), c("entities"), c("ts_ms"), c("payload"))
    return envelopes.select(
        bus_topic(c("source")).alias("topic"),
        record_key(c("entities"), c("event_id")).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
    )


def error_headers(reason: Column) -> Column:
    return F.array(F.struct(F.lit(ERROR_HEADER).alias("key"),
                            reason.cast("binary").alias("value")))


def to_dlq(rejects: DataFrame) -> DataFrame:
    """Dead-letter records of ``value`` (JSON text) and ``reason``; any value is carried."""
    v = F.col("_v")
    entities = J.field(v, "$.entities")
    first = F.try_variant_get(v, "$.entities[0]", "variant")
    own_id = J.string_or_null(J.field(v, "$.event_id"))
    # An absent or empty entities value falls back to the id; a present one that
    # does not start with text has no usable key.
    empty = F.coalesce(
        J.kind(entities).isin("VOID", "OBJECT<>")
        | F.to_json(entities).isin("[]", '""', "0", "false"),
        F.lit(True),
    )
    key = (
        F.when(empty, own_id)
        .when(J.kind(entities) == "STRING", F.substring(entities.cast("string"), 1, 1))
        .otherwise(J.string_or_null(first))
    )
    parsed = rejects.withColumn("_v", F.try_parse_json("value"))
    raw = F.to_json(F.struct(F.col("value").alias("raw")))
    return parsed.select(
        dlq_topic(J.string_or_null(J.field(v, "$.source"))).alias("topic"),
        F.coalesce(key, F.lit("unknown")).cast("binary").alias("key"),
        F.coalesce(F.to_json(v), raw).cast("binary").alias("value"),
        error_headers(F.col("reason")).alias("headers"),
    )


def header(headers: Column, name: str, last: bool = False) -> Column:
    """Text of the first (or last) header of that name."""
    found = F.filter(headers, lambda h: h["key"] == name)
    hit = F.try_element_at(found, F.lit(-1 if last else 1))
    # A header that is there but holds no bytes reads as the text None.
    return F.when(F.size(found) > 0, F.coalesce(hit["value"].cast("string"), F.lit("None")))


def write_bus(records: DataFrame, cfg: Settings) -> None:
    records.write.format("kafka").option("kafka.bootstrap.servers", cfg.bus.servers).save()


def write_spool(rejects: DataFrame, path: str, dlq_error: str) -> None:
    """JSON lines {error, dlq_error, envelope} for rejects the bus could not take."""
    rejects.select(
        F.col("reason").alias("error"),
        F.lit(dlq_error).alias("dlq_error"),
        F.coalesce(
            F.try_parse_json("value"),
            F.parse_json(F.to_json(F.struct(F.col("value").alias("raw")))),
        ).alias("envelope"),
    ).select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)


def decode_feed(bus: DataFrame, summary_chars: int | None = None) -> DataFrame:
    """Every bus row as something showable, broken values included.

    Texts are whole unless a display bounds its summaries by ``summary_chars``; a time that no
    timestamp can hold is null.

    ``error`` is filled for dead-letter rows only. ``seq`` orders rows by arrival.
    """
    text, v = F.col("value").cast("string"), F.col("_v")
    raw = F.struct(text.alias("raw"))
    body = F.when(J.object_text(text, v), J.field(v, "$.payload")).otherwise(
        F.parse_json(F.to_json(raw)))
    own_source = J.string_or_null(J.field(v, "$.source"))
    shown = with_once(bus, "_v", F.try_parse_json(text)).select(
        "topic", "partition", "offset", "timestamp",
        F.try_variant_get(v, "$.event_id", "string").alias("event_id"),
        F.coalesce(F.when(own_source != "", own_source),
                   F.split_part(F.col("topic"), F.lit("."), F.lit(2))).alias("source"),
        F.coalesce(F.try_variant_get(v, "$.entities", "array<string>"),
                   F.array().cast("array<string>")).alias("entities"),
        bounded(F.try_variant_get(v, "$.ts_ms", "bigint")).alias("ts_ms"),
        F.when(is_dead_letter(), header(F.col("headers"), ERROR_HEADER)).alias("error"),
        body.alias("_body"),
    )
    # One step at a time: each column is worked out once and then only read.
    payload = F.to_json("_body")
    shown = shown.withColumn("payload", F.when(payload != "null", payload))
    return shown.select(
        "topic", "partition", "offset", "timestamp", "event_id", "source", "entities", "ts_ms",
        "payload", "error", J.summary(F.col("payload"), F.col("_body"), summary_chars).alias("summary"),
    )


def is_dead_letter() -> Column:
    return F.endswith(F.col("topic"), F.lit(".dlq"))
