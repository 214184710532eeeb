"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from eventlens.plans.queries import QUERIES

HEADLINE = (
    "pairs", "latest_pairs", "pairs_of_copies", "resolve_pairs", "parse_envelopes", "to_bus",
    "check", "route_valid", "route_dead_letters", "fill_entities", "ingest_cursors",
    "cashtags", "symbol_tokens", "tickers", "normalize_entities", "hn_envelopes",
    "lobsters_envelopes", "rss_envelopes", "stocks_envelopes", "newer_than", "per_entity",
    "entityless", "decode_feed", "last_by_id", "ring_events", "peek", "where_text",
    "group_stream_by_entity", "group_pairs_by_pair", "source_status", "rate", "topic_depths",
    "advance_cursors", "summary", "stream_pairs_to_sink", "backfill",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        # The noop sink computes every row and column and keeps none.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # The first run of each query pays for code generation; the second one counts.
    runs = {name: (seconds(name), seconds(name))[1] for name in HEADLINE}
    times = {name: round(t, 3) for name, t in runs.items()}
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total seconds of the headline queries, warm",
        "value": round(sum(runs.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
