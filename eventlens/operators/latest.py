"""Newest-first reads: top-N, last row per key, tail of a topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions import jsontext as J
from eventlens.sources.bus import ERROR_HEADER, header, is_dead_letter

# Arrival order of bus rows: produce time, then position.
ARRIVAL = ("timestamp", "topic", "partition", "offset")


def latest_raw(raw: DataFrame, n: int = 10) -> DataFrame:
    return raw.orderBy(F.desc("ts_ms"), "event_id").limit(n)


def latest_pairs(pairs: DataFrame, n: int = 10) -> DataFrame:
    return pairs.orderBy(F.desc("ts_ms"), "entity", "a_id", "b_id").limit(n)


def stored(df: DataFrame) -> DataFrame:
    """All rows of a sink with ``dt`` as text, and a summary if there is a payload."""
    text_dt = F.col("dt").cast("string").alias("dt")
    if "payload" in df.columns:
        return df.select("event_id", "source", "ts_ms", "payload", text_dt,
                         J.summary(F.col("payload")).alias("summary"))
    return df.select("entity", "a_id", "b_id", "ts_ms", text_dt)


def store_view(df: DataFrame, n: int = 2000) -> DataFrame:
    """The newest ``n`` rows of a sink, as a display lists them."""
    return stored(latest_raw(df, n) if "payload" in df.columns else latest_pairs(df, n))


def last_by_id(feed: DataFrame) -> DataFrame:
    """The last arrived row of every event id.

    A maximum over (arrival, row) combines on the map side, so a crowd of copies of one
    id shrinks to one row per task before the shuffle.
    """
    rest = [c for c in feed.columns if c not in ARRIVAL]
    last = F.max_by(F.struct(*ARRIVAL, *[c for c in rest if c != "event_id"]),
                    F.struct(*ARRIVAL))
    return (
        feed.filter(F.col("event_id") != "")
        .groupBy("event_id").agg(last.alias("_last"))
        .select("event_id", "_last.*")
        .select(*feed.columns)
    )


def newest(feed: DataFrame, cap: int) -> DataFrame:
    return feed.orderBy(*[F.desc(c) for c in ARRIVAL]).limit(cap)


def ring(feed: DataFrame, cap: int = 5000, dlq_cap: int = 500) -> tuple[DataFrame, DataFrame]:
    """The newest events and the newest dead letters of a decoded feed."""
    return (newest(feed.filter(~is_dead_letter()), cap),
            newest(feed.filter(is_dead_letter()), dlq_cap))


def since(feed: DataFrame, after: dict) -> DataFrame:
    """Rows that arrived after the row at this position (keys of ``ARRIVAL``)."""
    here = F.struct(*[F.col(c).alias(c) for c in ARRIVAL])
    there = F.struct(*[F.lit(after[c]).cast(feed.schema[c].dataType).alias(c) for c in ARRIVAL])
    # The time alone is implied, and unlike the struct it can reach the scan.
    return feed.filter(F.col("timestamp") >= F.lit(after["timestamp"])).filter(here > there)


def peek(bus: DataFrame, topics: Sequence[str], n: int = 5) -> DataFrame:
    """The last ``n`` records of each topic, oldest first, with their error and value.

    Per partition only offsets within ``n`` of the end count, as after a seek there.
    """
    by_partition = Window.partitionBy("topic", "partition")
    by_topic = Window.partitionBy("topic").orderBy(F.desc("offset"), F.desc("partition"))
    # Both rank limits are applied per task before their shuffle, so neither a partition
    # nor a topic ever gathers more than n rows per task; the end is read off those.
    tail = (
        bus.filter(F.col("topic").isin(*topics))
        .withColumn("_rank", F.row_number().over(by_partition.orderBy(F.desc("offset"))))
        .filter(F.col("_rank") <= n)
        .withColumn("_end", F.max("offset").over(by_partition))
        .filter(F.col("offset") > F.col("_end") - n)
        .withColumn("_rank", F.row_number().over(by_topic))
        .filter(F.col("_rank") <= n)
    )
    text = F.col("value").cast("string")
    raw = F.to_json(F.struct(text.alias("raw")))
    return tail.select(
        "topic", "partition", "offset",
        header(F.col("headers"), ERROR_HEADER, last=True).alias("error"),
        F.coalesce(F.to_json(F.try_parse_json(text)), raw).alias("value"),
    ).orderBy("topic", "offset", "partition")
