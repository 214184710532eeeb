"""The jobs users run, put together from the operators."""

from __future__ import annotations

import os
import sys
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions import jsontext as J
from eventlens.functions import times
from eventlens.operators import latest, status, validate, views
from eventlens.operators.correlate import pairs
from eventlens.registry import Registry, default_registry
from eventlens.settings import Settings, session
from eventlens.sources import bus as B
from eventlens.sources import feeds, sinks
from eventlens.streaming import repair
from eventlens.streaming.fanout import start_fanout
from eventlens.streaming.pairs import stream_pairs
from eventlens.streaming.sinks import (
    merge_batch,
    raw_rows,
    start_pairs,
    start_quarantine,
    start_raw,
    unusable_rows,
)

# How far an event's time may lie after the record's arrival on the bus.
AHEAD_MS = 24 * 3_600_000
# Rows of a sink that the overview lists.
SHOWN = 2000
COMMANDS = ("ingest", "correlate", "fanout", "backfill", "query", "status", "overview", "dlq", "sources")
FEEDS = {"hn": feeds.hn_envelopes, "lobsters": feeds.lobsters_envelopes, "rss": feeds.rss_envelopes,
         "news": feeds.news_envelopes, "stocks": feeds.stocks_envelopes}


@dataclass(frozen=True)
class Ingested:
    records: DataFrame
    rejects: DataFrame
    cursors: DataFrame


def ingest(envelopes: DataFrame, cursors: DataFrame, registry: Registry,
           once: bool = False) -> Ingested:
    """New envelopes with entities filled in, checked and routed, and the moved cursors.

    The checked rows feed three outputs. A caller who uses more than one of them sets ``once``:
    they are then computed once, into the session's checkpoint folder, which also
    survives a lost executor.
    """
    fresh = feeds.fill_entities(feeds.newer_than(envelopes, cursors), registry)
    valued = fresh.withColumn("value", J.serialize(*[
        F.col(c) for c in ("event_id", "source", "entities", "ts_ms", "payload")
    ]))
    broken = F.col("payload").isNotNull() & F.try_parse_json("payload").isNull()
    checked = validate.check(valued, registry).withColumn("problems", F.when(
        broken, F.concat(F.array(F.lit("payload is not JSON")), "problems")).otherwise(F.col("problems")))
    if once:
        checked = checked.checkpoint()
    good = checked.filter(F.size("problems") == 0)
    bad = checked.filter(F.size("problems") > 0).withColumn(
        "reason", validate.reason(F.col("problems"))
    )
    return Ingested(B.to_bus(good), B.to_dlq(bad), status.advance_cursors(cursors, good))


def publish(ingested: Ingested, cfg: Settings, spool_path: str | None = None) -> None:
    """Writes records and rejects to the bus; the rejects go to a spool if that fails."""
    B.write_bus(ingested.records, cfg)
    try:
        B.write_bus(ingested.rejects, cfg)
    except Exception as err:
        if spool_path is None:
            raise
        spooled = ingested.rejects.select(
            F.col("value").cast("string").alias("value"),
            B.header(F.col("headers"), B.ERROR_HEADER).alias("reason"),
        )
        B.write_spool(spooled, spool_path, str(err))


def correlate(spark: SparkSession, bus: DataFrame, cfg: Settings, available_now: bool = False):
    """Starts the streaming sinks over a bus stream; returns (pairs, raw, quarantine) queries.

    Rows that are no usable envelopes go to the quarantine with their text.
    """
    if cfg.tables.hive:
        repair.bootstrap_tables(spark, cfg)
        spark.streams.addListener(repair.RepairListener(
            lambda: repair.repair_partitions(spark, cfg), cfg.tables.repair_seconds
        ))
    rows = B.topic_filter(bus, cfg.bus.topics)
    envelopes = B.parse_envelopes(rows, position=True, ahead_ms=AHEAD_MS)
    paired = stream_pairs(envelopes, cfg.join.window, cfg.join.hot_grid, cfg.join.hot_entities)
    return (start_pairs(paired, cfg, available_now), start_raw(envelopes, cfg, available_now),
            start_quarantine(rows, cfg, AHEAD_MS, available_now))


def fan_out(spark: SparkSession, bus: DataFrame, cfg: Settings, available_now: bool = False):
    """Starts the one query that reads a bus stream once and feeds every sink; see ``streaming.fanout``."""
    return start_fanout(spark, bus, cfg, AHEAD_MS, available_now)


def backfill(bus: DataFrame, cfg: Settings) -> None:
    """The same sinks from all the bus holds, with the batch pair join.

    Rows that the sinks lack are appended, so a second run changes nothing, and rows that the bus has
    dropped meanwhile stay. The bus is read and parsed once where the session has a checkpoint folder.
    """
    rows = B.judged(B.topic_filter(bus, cfg.bus.topics), AHEAD_MS)
    if bus.sparkSession.sparkContext.getCheckpointDir() is not None:
        rows = rows.checkpoint()
    envelopes = rows.filter("usable").select("e.*")
    merge_batch(raw_rows(envelopes), cfg.sinks.raw, sinks.RAW_SCHEMA, ["dt", "source"])
    merge_batch(pairs(envelopes, cfg.join.window), cfg.sinks.pairs, sinks.PAIRS_SCHEMA, ["dt"])
    merge_batch(unusable_rows(rows), cfg.sinks.place(sinks.QUARANTINE), sinks.QUARANTINE_SCHEMA, ["dt"])
    if cfg.tables.hive:
        repair.bootstrap_tables(bus.sparkSession, cfg)


def query(spark: SparkSession, cfg: Settings, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """The newest raw rows and the newest pairs, from tables or straight from Parquet."""
    if cfg.tables.hive:
        repair.bootstrap_tables(spark, cfg)
        raw = spark.table(repair.table_name(cfg, sinks.RAW_TABLE)).select("event_id", "source", "ts_ms", "dt")
        found = spark.table(repair.table_name(cfg, sinks.PAIRS_TABLE))
    else:
        raw = sinks.newest_days(spark, cfg.sinks.raw, sinks.RAW_SCHEMA, n)
        found = sinks.newest_days(spark, cfg.sinks.pairs, sinks.PAIRS_SCHEMA, n)
    return latest.latest_raw(raw, n), latest.latest_pairs(found, n)


def status_report(spark: SparkSession, registry: Registry, cursors: DataFrame, bus: DataFrame,
                  cfg: Settings, now_ms: int) -> dict[str, DataFrame]:
    """Sources with readable times, dead-letter depths, sink sizes."""
    configured = registry.frame(spark)
    rows = status.source_status(configured, cursors, bus, now_ms)
    none = F.lit("-")
    return {
        "sources": rows.select(
            "name",
            F.coalesce(times.isotime(F.col("cursor_ms")), none).alias("cursor"),
            F.coalesce(times.age(F.lit(now_ms) - F.col("cursor_ms")), none).alias("age"),
            "interval", "state",
        ).orderBy("name"),
        "dlq": status.dlq_depths(configured, bus).orderBy("topic"),
        "sinks": sinks.sink_bytes(spark, cfg).select(
            "sink", J.human_bytes(F.col("bytes")).alias("size")
        ).orderBy("sink"),
    }


def dlq_report(spark: SparkSession, registry: Registry, bus: DataFrame, topic: str | None = None,
               n: int = 5) -> tuple[DataFrame, DataFrame]:
    """Dead-letter depths and the last records of each topic with their reason."""
    topics = [topic] if topic else [s.dlq_topic for s in registry]
    named = spark.createDataFrame([(t,) for t in topics], "topic string")
    depths = status.named_depths(named, bus.filter(F.col("topic").isin(topics)))
    return depths.orderBy("topic"), latest.peek(bus, topics, n)


def overview(spark: SparkSession, registry: Registry, cursors: DataFrame, bus: DataFrame,
             cfg: Settings, now_ms: int, cap: int = 5000) -> dict[str, DataFrame]:
    """Every frame the operations views show."""
    feed = B.decode_feed(B.topic_filter(bus, B.ALL_TOPICS))
    events, dead = latest.ring(feed, cap)
    raw = sinks.newest_days(spark, cfg.sinks.raw, sinks.RAW_SCHEMA, SHOWN)
    shown = latest.store_view(sinks.newest_days(spark, cfg.sinks.pairs, sinks.PAIRS_SCHEMA, SHOWN), SHOWN)
    # Any event on the bus may be in a pair that is shown; only those are looked up.
    ids = shown.select(F.explode(F.array("a_id", "b_id")).alias("event_id")).distinct()
    known = latest.last_by_id(
        feed.filter(~B.is_dead_letter()).join(ids, "event_id", "left_semi")
        .select(*latest.ARRIVAL, "event_id", "ts_ms", "summary"))
    sources = status.source_status(registry.frame(spark), cursors, bus, now_ms)
    rates = status.rate(bus, now_ms // 1000)
    return {
        "sources": status.with_share(sources, "n").orderBy("name"),
        "topics": status.topic_counts(bus),
        "rate": rates,
        "mean_rate": status.mean_rate(rates, now_ms // 1000),
        "queries": sinks.query_progress(spark, cfg.sinks.checkpoint_root, now_ms),
        "sinks": status.with_share(sinks.totals(spark, cfg), "bytes"),
        "stream": events,
        "dlq": dead,
        "stored": latest.store_view(raw, SHOWN),
        "correlated": views.resolve_pairs(shown, known),
    }


def list_sources(spark: SparkSession, registry: Registry) -> DataFrame:
    return registry.frame(spark).orderBy("name")


def main(argv: list[str] | None = None) -> int:
    """``ingest FEED FOLDER``, ``correlate``, ``fanout``, ``backfill``, ``query``, ``status``, ``overview``,
    ``dlq [topic]`` or ``sources``.

    ``ingest`` takes landed documents (Parquet with ``document``, for some feeds ``symbol`` and
    ``ingest_ms``), sends what is newer than the stored cursors and stores the moved ones.
    """
    args = sys.argv[1:] if argv is None else argv
    command = args[0] if args else "sources"
    if command not in COMMANDS or command == "ingest" and (len(args) != 3 or args[1] not in FEEDS):
        print(main.__doc__, file=sys.stderr)
        return 2
    settings = Settings.read(os.environ)
    spark = session(SparkSession.builder.appName(f"eventlens-{command}"), settings)
    cfg = settings.on(spark.sparkContext.master)
    registry = default_registry()
    if command == "correlate":
        correlate(spark, B.read_bus_stream(spark, cfg), cfg)
        spark.streams.awaitAnyTermination()
    elif command == "fanout":
        fan_out(spark, B.read_bus_stream(spark, cfg), cfg).awaitTermination()
    elif command == "backfill":
        backfill(B.read_bus(spark, cfg), cfg)
    elif command == "query":
        for df in query(spark, cfg):
            df.show(truncate=False)
    elif command == "ingest":
        sent = ingest(FEEDS[args[1]](spark.read.parquet(args[2])), sinks.read_cursors(spark, cfg),
                      registry, once=spark.sparkContext.getCheckpointDir() is not None)
        publish(sent, cfg, cfg.sinks.place("spool"))
        sinks.append_cursors(sent.cursors, cfg)
    elif command in ("status", "dlq", "overview"):
        bus = B.read_bus(spark, cfg, B.ALL_TOPICS)
        if command == "dlq":
            for df in dlq_report(spark, registry, bus, *args[1:2]):
                df.show(truncate=False)
        else:
            report = overview if command == "overview" else status_report
            frames = report(spark, registry, sinks.read_cursors(spark, cfg), bus, cfg,
                            int(time.time() * 1000))
            for name, df in frames.items():
                print(name)
                df.show(truncate=False)
    else:
        list_sources(spark, registry).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
