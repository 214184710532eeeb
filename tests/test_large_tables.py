"""Figures and shapes that only larger tables ask for."""

import json

import pytest

from eventlens.operators import views
from eventlens.plans import queries
from eventlens.plans.queries import QUERIES
from eventlens.settings import Settings
from eventlens.sources import sinks
from eventlens.streaming import fanout


def test_sizes_beyond_64_bits(spark, tmp_path):
    ids = [0, 5, 1_048_575, 1_048_576, 1_100_000, 6_000_000, 36_000_000]
    spark.createDataFrame([(i,) for i in ids], "event_id bigint").write.parquet(str(tmp_path / "events.parquet"))
    rows = {r.event_id: r for r in QUERIES["readable_texts"](spark, str(tmp_path)).collect()}
    assert sorted(rows) == ids
    assert (rows[0].size, rows[5].size) == ("0 B", "1000 B")
    for i in ids[2:]:
        assert rows[i].size == f"{i ** 3 * 8 / 1024 ** 4:.1f} TiB"


def test_pairs_are_made_of_one_scan_and_land_where_they_are_made(spark, bus, tmp_path, monkeypatch):
    cfg, landed, real = Settings.at(str(tmp_path / "sinks")), {}, fanout.land

    def seeing(df, path, partitions, batch):
        landed[path.rsplit("/", 1)[-1]] = df
        return real(df, path, partitions, batch)

    monkeypatch.setattr(fanout, "land", seeing)
    values = [json.dumps({"event_id": f"e{k}", "source": "ab"[k % 2], "entities": ["X"], "ts_ms": 1_700_000_000_000 + k})
              for k in range(20)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for batch in range(2):
            half = values[batch * 10:][:10]
            fanout.write_fanout(bus(*[("events.x", 0, k, v, None, 1_700_000_000) for k, v in enumerate(half)]), batch, cfg)
        pairs = landed[sinks.PAIRS_TABLE]
        assert pairs.count() == 10 * 10 - 5 * 5
        pairs.collect()
        plan = pairs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("FileScan") == 1 and "InMemoryTableScan" not in plan
    assert "REBALANCE" not in plan
    assert sinks.read_pairs(spark, cfg).count() == 10 * 10
    assert spark.conf.get(fanout.WRITERS) == "0"


@pytest.mark.parametrize("name", ["fanout_pairs", "stream_state_rows"])
def test_streams_land_by_as_many_tasks_as_the_table_has(spark, tmp_path, monkeypatch, name):
    cfg = Settings.at(str(tmp_path / "sinks"))
    monkeypatch.setattr(queries, "_scratch", lambda *_: cfg)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "in" / "events.parquet"))
    try:
        QUERIES[name](spark, str(tmp_path / "in")).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    landed = spark.read.schema(events.schema).parquet(cfg.sinks.place("land"))
    assert landed.select("_metadata.file_path").distinct().count() > 3
    assert landed.count() == events.count()


def test_events_are_never_broadcast_to_pairs(spark):
    pairs = spark.createDataFrame([("X", "a", "b", 7, None)], sinks.PAIRS_SCHEMA)
    events = spark.createDataFrame([("a", 5, "first")], "event_id string, ts_ms bigint, summary string")
    df = views.resolve_pairs(pairs, events)
    assert [tuple(r) for r in df.select("a", "b", "gap_ms").collect()] == [("first", "b", None)]
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan


def test_pairs_land_by_runs_of_days(spark, bus, tmp_path, monkeypatch):
    """A join of many rows opens files of few days only, and no pair over a midnight or of two batches is lost."""
    cfg, days, real = Settings.at(str(tmp_path / "sinks")), [], fanout.land

    def seeing(df, path, partitions, batch):
        touched = real(df, path, partitions, batch)
        if path.endswith(sinks.PAIRS_TABLE):
            days.append(touched)
        return touched

    monkeypatch.setattr(fanout, "land", seeing)
    monkeypatch.setattr(fanout, "WAVE", 100, raising=False)
    start, minute = 1_700_006_400_000, 60_000  # a midnight
    values = [(f"e{k}", "abc"[k % 3], start + k * 9 * minute) for k in range(5 * 160)]
    for batch in range(2):
        fanout.write_fanout(bus(*[
            ("events.x", 0, k, json.dumps({"event_id": i, "source": s, "entities": ["X"], "ts_ms": t}), None, 1_700_000_000)
            for k, (i, s, t) in enumerate(values) if k % 2 == batch]), batch, cfg)
    wanted = sorted((a[0], b[0]) if a[1] < b[1] else (b[0], a[0]) for a, b in zip(values, values[1:]))
    assert sorted((r.a_id, r.b_id) for r in sinks.read_pairs(spark, cfg).collect()) == wanted
    assert len(set(map(str, days))) > 2 and max(map(len, days)) == 1
    # The same batch again replaces its own files only.
    files = len(sinks.read_pairs(spark, cfg).inputFiles())
    fanout.write_fanout(bus(*[
        ("events.x", 0, k, json.dumps({"event_id": i, "source": s, "entities": ["X"], "ts_ms": t}), None, 1_700_000_000)
        for k, (i, s, t) in enumerate(values) if k % 2 == 1]), 1, cfg)
    assert sinks.read_pairs(spark, cfg).count() == len(wanted) and len(sinks.read_pairs(spark, cfg).inputFiles()) == files


def test_runs_of_days_are_as_long_as_windows(spark):
    known = spark.sql("SELECT date_from_unix_date(id DIV 10) AS dt FROM range(100)")
    assert fanout._waves(known, 1000, 25) == [(0, 1), (2, 3), (4, 5), (6, 7), (8, 9)]
    assert fanout._waves(known, 1000, 5) == [(d, d) for d in range(10)]
    assert fanout._waves(known, 86_400_000 // 2, 5) == [(0, 3), (4, 7), (8, 9)]
    assert fanout._waves(known.limit(0), 1000, 5) == []


def test_nothing_is_generated_of_a_pair(spark, envelopes):
    from eventlens.operators.correlate import pairs as pairs_of
    df = pairs_of(envelopes(*[("a", "s1", ["X"], 0)] * 3, *[("b", "s2", ["X"], 1)] * 2, ("c", "s3", ["X"], 2)))
    assert sorted((r.a_id, r.b_id) for r in df.collect()) == [("a", "b")] * 6 + [("a", "c")] * 3 + [("b", "c")] * 2
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan[:plan.index("Join ")] and "Generate" in plan
