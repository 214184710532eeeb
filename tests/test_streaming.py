import json
from dataclasses import replace

import pytest

from eventlens.settings import Settings, Tables
from eventlens.operators.correlate import pairs
from eventlens.plans import jobs
from eventlens.sources import bus as B
from eventlens.sources import sinks
from eventlens.streaming import repair
from eventlens.streaming.pairs import stream_pairs
from eventlens.streaming.sinks import PAIRS_QUERY, QUARANTINE_QUERY, RAW_QUERY, start_pairs, start_raw

T0 = 1_700_000_000_000
MINUTE = 60_000


def value(event_id, source, entities, after_ms):
    return json.dumps({"event_id": event_id, "source": source, "entities": entities,
                       "ts_ms": T0 + after_ms, "payload": {"title": event_id}})


@pytest.fixture
def pipeline(spark, bus, tmp_path):
    """A bus kept as Parquet files, and both sinks run over whatever is new in it."""
    class Pipeline:
        cfg = Settings.at(str(tmp_path / "sinks"))
        land = str(tmp_path / "bus")
        sent = 0

        def send(self, *values, topic="events.hn"):
            rows = [(topic, 0, self.sent + i, v, None, T0 // 1000) for i, v in enumerate(values)]
            self.sent += len(rows)
            bus(*rows).coalesce(1).write.mode("append").parquet(self.land)

        def stream(self):
            return spark.readStream.schema(B.BUS).parquet(self.land)

        def run(self):
            queries = jobs.correlate(spark, self.stream(), self.cfg, available_now=True)
            for q in queries:
                q.awaitTermination()
            return queries

        def pairs(self):
            return sorted((r.entity, r.a_id, r.b_id, r.ts_ms - T0)
                          for r in sinks.read_pairs(spark, self.cfg).collect())

        def raw(self):
            return sorted(r.event_id for r in sinks.read_raw(spark, self.cfg).collect())

    return Pipeline()


def test_end_to_end(spark, pipeline):
    """Two pairs with the quote, one headline pair, one raw row."""
    pipeline.send(
        value("s:hn", "hn", ["AAPL"], 0), value("s:rss", "rss", ["AAPL"], 30_000),
        value("s:stocks", "stocks", ["AAPL"], 60_000), value("s:raw", "rss", [], 0),
        "not json")
    pipeline.send(value("s:dead", "rss", [], 0), topic="events.rss.dlq")
    pipeline.run()
    assert pipeline.raw() == ["s:raw"]
    assert pipeline.pairs() == [
        ("AAPL", "s:hn", "s:rss", 30_000), ("AAPL", "s:hn", "s:stocks", 60_000),
        ("AAPL", "s:rss", "s:stocks", 60_000)]
    raw = sinks.read_raw(spark, pipeline.cfg)
    [row] = raw.collect()
    assert (str(row.dt), row.source, json.loads(row.payload)) == (
        "2023-11-14", "rss", {"title": "s:raw"})
    plan = raw.filter("dt = '2023-11-14' and source = 'rss'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_restart_joins_against_kept_state(pipeline):
    pipeline.send(value("h", "hn", ["X"], 0))
    pipeline.run()
    assert pipeline.pairs() == []
    pipeline.send(value("r", "rss", ["X"], 10 * MINUTE), value("s", "rss", ["X"], 10 * MINUTE + 1))
    pipeline.run()
    assert pipeline.pairs() == [("X", "h", "r", 10 * MINUTE)]


def test_late_rows_are_dropped(pipeline):
    pipeline.send(value("h", "hn", ["X"], 0))
    pipeline.run()
    pipeline.send(value("jump", "hn", ["Y"], 600 * MINUTE))
    pipeline.run()
    # A batch filters by the watermark of the batch before it.
    pipeline.send(value("next", "hn", ["Y"], 601 * MINUTE))
    pipeline.run()
    pipeline.send(value("late", "rss", ["X"], MINUTE), value("fresh", "rss", ["Y"], 601 * MINUTE))
    paired, *_ = pipeline.run()
    assert pipeline.pairs() == [("Y", "jump", "fresh", 601 * MINUTE),
                                ("Y", "next", "fresh", 601 * MINUTE)]
    dropped = sum(s["numRowsDroppedByWatermark"]
                  for p in paired.recentProgress for s in p["stateOperators"])
    assert dropped > 0


def test_state_behind_the_watermark_is_removed(pipeline):
    pipeline.send(*[value(f"h{i}", "hn", ["X"], i) for i in range(20)])
    pipeline.run()
    pipeline.send(value("jump", "hn", ["Y"], 600 * MINUTE))
    pipeline.run()
    pipeline.send(value("next", "hn", ["Y"], 601 * MINUTE))
    paired, *_ = pipeline.run()
    kept = paired.lastProgress["stateOperators"][0]["numRowsTotal"]
    # Two rows: once on the one side, in three bins on the other.
    assert kept == 2 * (1 + 3)


def test_stream_equals_batch(spark, pipeline):
    import random

    rng = random.Random(3)
    rows = [(f"e{n}", rng.choice("abc"), [rng.choice("XYZ")], rng.randrange(60 * MINUTE))
            for n in range(200)]
    for start in range(0, 200, 50):
        part = sorted(rows, key=lambda r: r[3])[start:start + 50]
        pipeline.send(*[value(*r) for r in part])
    pipeline.run()
    batch = pairs(B.parse_envelopes(spark.read.schema(B.BUS).parquet(pipeline.land)))
    assert pipeline.pairs() == sorted(
        (r.entity, r.a_id, r.b_id, r.ts_ms - T0) for r in batch.collect())
    assert len(pipeline.pairs()) > 100


def test_backfill_equals_stream(spark, pipeline):
    pipeline.send(value("h", "hn", ["X"], 0), value("r", "rss", ["X"], 5), value("n", "hn", [], 0))
    pipeline.run()
    other = pipeline.cfg.moved(pipeline.cfg.sinks.root + "-batch")
    jobs.backfill(spark.read.schema(B.BUS).parquet(pipeline.land), other)
    for read in (sinks.read_pairs, sinks.read_raw):
        assert sorted(map(str, read(spark, other).collect())) == sorted(
            map(str, read(spark, pipeline.cfg).collect()))


def test_backfill_twice_changes_nothing_and_accounts_for_all(spark, pipeline):
    late = 10**6 * MINUTE
    pipeline.send(value("h", "hn", ["X"], 0), value("r", "rss", ["X"], 5), value("n", "hn", [], 0),
                  "not json", '{"event_id": "x"}', value("far", "hn", ["X"], late))
    rows = spark.read.schema(B.BUS).parquet(pipeline.land)
    cfg = pipeline.cfg.moved(pipeline.cfg.sinks.root + "-batch")
    for _ in range(2):
        jobs.backfill(rows, cfg)
        assert sinks.read_raw(spark, cfg).count() == sinks.read_pairs(spark, cfg).count() == 1
        held = sinks.read_quarantine(spark, cfg).collect()
        assert sorted(r.value for r in held) == sorted(
            ["not json", '{"event_id": "x"}', value("far", "hn", ["X"], late)])
    pipeline.run()
    assert sorted(map(str, sinks.read_quarantine(spark, pipeline.cfg).collect())) == sorted(map(str, held))


def test_cursors_are_stored(spark, pipeline):
    cfg = pipeline.cfg
    assert sinks.read_cursors(spark, cfg).count() == 0
    for rows in ([("hn", 5), ("rss", 7)], [("hn", 9), ("rss", 1)]):
        sinks.append_cursors(spark.createDataFrame(rows, "source string, cursor_ms bigint"), cfg)
    assert {tuple(r) for r in sinks.read_cursors(spark, cfg).collect()} == {("hn", 9), ("rss", 7)}


def test_progress_and_sizes(spark, pipeline):
    assert sinks.query_progress(spark, pipeline.cfg.sinks.checkpoint_root, 0).collect() == []
    assert {r.bytes for r in sinks.sink_bytes(spark, pipeline.cfg).collect()} == {0}
    pipeline.send(value("h", "hn", ["X"], 0), value("n", "hn", [], 0))
    pipeline.run()
    now = 4_000_000_000_000
    rows = {r["query"]: r for r in sinks.query_progress(
        spark, pipeline.cfg.sinks.checkpoint_root, now).collect()}
    assert set(rows) == {PAIRS_QUERY, RAW_QUERY, QUARANTINE_QUERY}
    assert rows[RAW_QUERY].planned == rows[RAW_QUERY].committed == 0
    assert not rows[RAW_QUERY].running and 0 < rows[RAW_QUERY].committed_ago_ms < now
    sizes = {r.sink: r.bytes for r in sinks.sink_bytes(spark, pipeline.cfg).collect()}
    assert sizes["events_raw"] > 0


def test_progress_of_a_running_batch(spark, tmp_path):
    for kind, batches in (("offsets", 11), ("commits", 10)):
        (tmp_path / "raw" / kind).mkdir(parents=True)
        for n in range(batches):
            (tmp_path / "raw" / kind / str(n)).write_text("v1")
    (tmp_path / "raw" / "offsets" / ".10.crc").write_text("")
    [row] = sinks.query_progress(spark, str(tmp_path), 0).collect()
    assert (row["query"], row.planned, row.committed, row.running) == ("raw", 10, 9, True)


def test_unknown_files_are_counted_as_bytes(spark, tmp_path):
    (tmp_path / "correlated").mkdir()
    (tmp_path / "correlated" / "part-0.parquet").write_bytes(b"x" * 10)
    cfg = Settings.at(str(tmp_path))
    assert {r.sink: r.bytes for r in sinks.sink_bytes(spark, cfg).collect()} == {
        "correlated": 10, "events_raw": 0}


def test_watermark_is_set_once(spark, tmp_path):
    stream = spark.readStream.schema(
        "event_id string, source string, entities array<string>, ts_ms bigint").json(str(tmp_path))
    assert stream_pairs(stream).isStreaming
    with pytest.raises(ValueError):
        stream_pairs(stream, "10 minutes OR true")


def test_sinks_take_their_trigger(spark, pipeline):
    pipeline.send(value("n", "hn", [], 0))
    cfg = replace(pipeline.cfg, sinks=replace(pipeline.cfg.sinks, trigger="1 second"))
    envelopes = B.parse_envelopes(pipeline.stream())
    queries = [start_raw(envelopes, cfg), start_pairs(stream_pairs(envelopes), cfg)]
    try:
        for q in queries:
            q.processAllAvailable()
        assert [q.name for q in queries] == [RAW_QUERY, PAIRS_QUERY]
        assert pipeline.raw() == ["n"]
    finally:
        for q in queries:
            q.stop()


@pytest.mark.parametrize("first", ["tables", "stream"])
def test_tables_over_the_sinks(spark, pipeline, first):
    pipeline.send(value("h", "hn", ["X"], 0), value("r", "rss", ["X"], 5), value("n", "hn", [], 0))
    try:
        if first == "tables":
            repair.bootstrap_tables(spark, pipeline.cfg)
            assert spark.table("events_raw").count() == 0
            assert dict(spark.table("events_raw").dtypes)["dt"] == "string"
            pipeline.run()
            assert repair.repair_partitions(spark)
        else:
            pipeline.run()
            repair.bootstrap_tables(spark, pipeline.cfg)
        assert spark.table("events_raw").filter("source = 'hn'").count() == 1
        [row] = spark.sql("SELECT entity, a_id, b_id FROM correlated ORDER BY dt DESC").collect()
        assert tuple(row) == ("X", "h", "r")
        # A partition that lands later shows up with the next repair.
        pipeline.send(value("m", "web", [], 5))
        pipeline.run()
        assert repair.repair_partitions(spark)
        assert spark.table("events_raw").count() == 2
    finally:
        for table in ("events_raw", "correlated"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    assert not repair.repair_partitions(spark)


def test_query_without_tables(spark, pipeline):
    for df in jobs.query(spark, pipeline.cfg):
        assert df.count() == 0
    pipeline.send(value("h", "hn", ["X"], 0), value("r", "rss", ["X"], 5), value("n", "hn", [], 0))
    pipeline.run()
    raw, found = jobs.query(spark, pipeline.cfg)
    assert [r.event_id for r in raw.collect()] == ["n"] and found.count() == 1
    for view in ("events_raw", "correlated"):
        spark.catalog.dropTempView(view)


def test_ddl():
    cfg = Settings(tables=Tables(root="/data/o'brien"))
    raw, found = repair.table_ddl(cfg)
    assert "LOCATION '/data/o''brien/events_raw'" in raw
    assert "USING parquet PARTITIONED BY (dt, source)" in raw
    assert raw.startswith("CREATE TABLE IF NOT EXISTS events_raw (event_id STRING, "
                          "entities ARRAY<STRING>, ts_ms BIGINT, payload STRING")
    assert "PARTITIONED BY (dt)" in found and "correlated" in found
    hive = repair.table_ddl(replace(cfg, tables=replace(cfg.tables, hive=True)))
    assert all(s.startswith("CREATE EXTERNAL TABLE IF NOT EXISTS") for s in hive)
    assert "PARTITIONED BY (dt STRING, source STRING) STORED AS PARQUET" in hive[0]


class Clock:
    now = 0.0

    def __call__(self):
        return self.now


def test_repair_is_throttled():
    clock, calls = Clock(), []
    listener = repair.RepairListener(lambda: not calls.append(clock.now), 30, clock)
    for clock.now in (0, 10, 29.9, 30, 59, 61):
        listener.onQueryProgress(None)
    assert calls == [0, 30, 61]


def test_failed_repair_is_tried_again():
    clock, results = Clock(), [False, OSError("metastore away"), True]
    calls = []

    def fix():
        calls.append(clock.now)
        result = results.pop(0)
        if isinstance(result, Exception):
            raise result
        return result

    listener = repair.RepairListener(fix, 30, clock)
    for clock.now in (0, 1, 2, 3):
        listener.onQueryProgress(None)
    assert calls == [0, 1, 2]
