"""Counts, rates, depths, freshness and sizes of a running pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions.times import interval_seconds, bounded

STALE_MS = 24 * 3_600_000


def topic_counts(bus: DataFrame) -> DataFrame:
    return bus.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def rate(bus: DataFrame, now_s: int, n: int = 60) -> DataFrame:
    """Messages per second over the last ``n`` whole seconds, oldest first, gaps as 0."""
    second = F.unix_seconds("timestamp")
    counts = (
        # Stated on the bare column, the bounds reach the scan.
        bus.filter((F.col("timestamp") >= F.timestamp_seconds(F.lit(now_s - n)))
                   & (F.col("timestamp") < F.timestamp_seconds(F.lit(now_s))))
        .groupBy(second.alias("second")).agg(F.count(F.lit(1)).alias("n"))
    )
    seconds = bus.sparkSession.range(now_s - n, now_s).withColumnRenamed("id", "second")
    return (
        seconds.join(counts, "second", "left")
        .select("second", F.coalesce("n", F.lit(0)).alias("n")).orderBy("second")
    )


def mean_rate(rates: DataFrame, now_s: int, last: int = 10) -> DataFrame:
    """Messages per second averaged over the last seconds of ``rate``."""
    recent = rates.filter(F.col("second") >= now_s - last)
    return recent.agg((F.sum("n") / last).alias("per_second"))


def topic_depths(bus: DataFrame) -> DataFrame:
    """Messages between the first and the end offset of every topic.

    Offsets a broker has compacted away count as well.
    """
    return depths_of(ends_of(bus))


def ends_of(bus: DataFrame) -> DataFrame:
    """topic, partition, first offset and the offset behind the last, of the rows of a bus frame."""
    return bus.groupBy("topic", "partition").agg(
        F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset"))


def depths_of(ends: DataFrame) -> DataFrame:
    """topic, depth from the ends of partitions, however they were learnt."""
    return ends.groupBy("topic").agg(F.sum(F.col("end_offset") - F.col("begin_offset")).alias("depth"))


def dlq_depths(registry: DataFrame, bus: DataFrame) -> DataFrame:
    """Depth of every configured source's dead-letter topic, 0 if there is none."""
    topics = registry.select(F.concat("topic", F.lit(".dlq")).alias("topic"))
    return named_depths(topics, bus.filter(F.endswith(F.col("topic"), F.lit(".dlq"))))


def named_depths(topics: DataFrame, bus: DataFrame) -> DataFrame:
    """Depth of each of these topics, whether or not a source is configured for it."""
    return topics.join(topic_depths(bus), "topic", "left").select(
        "topic", F.coalesce("depth", F.lit(0)).alias("depth")
    )


def cursor_state(cursor_ms: Column, now_ms: int, stale_ms: int = STALE_MS) -> Column:
    return (
        F.when(cursor_ms.isNull(), F.lit("never"))
        .when(F.lit(now_ms) - cursor_ms > stale_ms, F.lit("stale"))
        .otherwise(F.lit("ok"))
    )


def source_status(registry: DataFrame, cursors: DataFrame, bus: DataFrame, now_ms: int,
                  stale_ms: int = STALE_MS) -> DataFrame:
    """One row per configured source: traffic, dead letters, cursor and its state.

    The bus is counted per topic first; everything joined afterwards is configuration
    sized.
    """
    counts = topic_counts(bus)
    live = counts.select("topic", F.col("n").alias("_live"))
    dead = counts.select(F.col("topic").alias("_dlq_topic"), F.col("n").alias("_dead"))
    seen = cursors.select(F.col("source").alias("name"), "cursor_ms")
    return (
        registry.withColumn("_dlq_topic", F.concat("topic", F.lit(".dlq")))
        .join(live, "topic", "left")
        .join(dead, "_dlq_topic", "left")
        .join(seen, "name", "left")
        .select(
            "name", "topic", "interval",
            interval_seconds(F.col("interval")).alias("interval_s"),
            F.coalesce("_live", F.lit(0)).alias("n"),
            F.coalesce("_dead", F.lit(0)).alias("dlq"),
            "cursor_ms",
            cursor_state(F.col("cursor_ms"), now_ms, stale_ms).alias("state"),
        )
    )


def advance_cursors(cursors: DataFrame, valid: DataFrame) -> DataFrame:
    """Per source the largest time seen so far; a cursor never moves back.

    A time that no timestamp can hold does not count: it would stop its source for good.
    """
    new = valid.select("source", bounded(F.col("ts_ms")).alias("cursor_ms"))
    return (
        cursors.select("source", "cursor_ms").unionByName(new)
        .groupBy("source").agg(F.max("cursor_ms").alias("cursor_ms"))
    )


def with_share(df: DataFrame, amount: str) -> DataFrame:
    """Adds each row's part of the total; all parts are 0 when the total is.

    For frames that already are one row per source or sink: the window spans them all.
    """
    total = F.sum(amount).over(Window.partitionBy())
    return df.withColumn("share", F.col(amount) / F.greatest(total, F.lit(1)))


def sink_totals(pairs: DataFrame, raw: DataFrame) -> DataFrame:
    """sink, n, last_ts_ms of both sinks: totals, and the signature that tells a change."""
    def total(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"), F.max("ts_ms").alias("last_ts_ms")).select(
            F.lit(name).alias("sink"), "n", "last_ts_ms"
        )

    return total(pairs, "correlated").unionByName(total(raw, "events_raw"))


def sink_signature(pairs: DataFrame, raw: DataFrame) -> DataFrame:
    """One row; it differs from an earlier one whenever a sink has gained rows."""
    return signature(sink_totals(pairs, raw))


def signature(totals: DataFrame) -> DataFrame:
    """The same from totals, such as ``sources.sinks.totals`` has them without reading rows."""
    def of(sink: str, c: str) -> Column:
        return F.max(F.when(F.col("sink") == sink, F.col(c)))

    return totals.agg(
        of("correlated", "n").alias("n_pairs"),
        of("events_raw", "n").alias("n_raw"),
        of("correlated", "last_ts_ms").alias("last_pair_ms"),
        of("events_raw", "last_ts_ms").alias("last_raw_ms"),
    )


def sink_overview(pairs: DataFrame, raw: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows, newest time, bytes and share of bytes per sink."""
    return with_share(sink_totals(pairs, raw).join(sizes, "sink", "left"), "bytes")
