"""All sinks from one read: equal to the batch join, late rows accounted for, repeatable batches."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from eventlens.operators.correlate import FRESH, pairs
from eventlens.plans import jobs
from eventlens.settings import Settings
from eventlens.sources import bus as B
from eventlens.sources import sinks
from eventlens.streaming import repair
from eventlens.streaming.fanout import land, start_fanout, write_fanout
from eventlens.streaming.pairs import stream_pairs
from eventlens.streaming.sinks import start_pairs

T0 = 1_700_000_000_000
MINUTE = 60_000


def value(event_id, source, entities, after_ms):
    return json.dumps({"event_id": event_id, "source": source, "entities": entities,
                       "ts_ms": T0 + after_ms, "payload": {}})


@pytest.fixture
def cfg(tmp_path):
    return Settings.at(str(tmp_path / "sinks"))


@pytest.fixture
def rows(bus):
    """Bus rows of values, with places of their own in each call."""
    sent = [0]

    def make(*values):
        sent[0] += len(values)
        return bus(*[("events.x", 0, sent[0] - len(values) + k, v, None, T0 // 1000) for k, v in enumerate(values)])

    return make


def found(spark, cfg):
    return sorted((r.entity, r.a_id, r.b_id) for r in sinks.read_pairs(spark, cfg).collect())


def test_rows_pair_within_and_across_batches_once(spark, cfg, rows):
    write_fanout(rows(value("a1", "a", ["X"], 0), value("b1", "b", ["X"], MINUTE)), 0, cfg)
    write_fanout(rows(value("c1", "c", ["X"], 2 * MINUTE), value("d1", "d", ["X"], 40 * MINUTE)), 1, cfg)
    write_fanout(rows(value("e1", "e", ["X"], 41 * MINUTE)), 2, cfg)
    assert found(spark, cfg) == [("X", "a1", "b1"), ("X", "a1", "c1"), ("X", "b1", "c1"), ("X", "d1", "e1")]


def test_only_pairs_with_a_fresh_side(envelopes):
    frame = envelopes(("a", "s1", ["X"], 0), ("b", "s2", ["X"], 1), ("c", "s3", ["X"], 2)).withColumn(
        FRESH, F.col("event_id") == "c")
    assert sorted((r.a_id, r.b_id) for r in pairs(frame).collect()) == [("a", "c"), ("b", "c")]


def test_late_rows_are_kept_and_every_row_is_counted(spark, cfg, rows):
    write_fanout(rows(value("n", "hn", ["X"], 30 * MINUTE), value("r", "hn", [], 0), "no json"), 0, cfg)
    write_fanout(rows(value("early", "rss", ["Y"], 0)), 1, cfg)  # the watermark is a batch behind
    write_fanout(rows(value("late", "rss", ["X"], 20 * MINUTE), value("edge", "rss", ["X"], 20 * MINUTE + 1),
                      value("old raw", "rss", [], 0)), 2, cfg)
    [late] = sinks.read_late(spark, cfg).collect()
    assert (late.event_id, late.late_ms, late.batch) == ("late", 0, 2)
    assert found(spark, cfg) == [("X", "n", "edge")]
    counts = [tuple(r) for r in sinks.read_batches(spark, cfg).orderBy("batch").select(
        "n", "unusable", "raw", "entity_rows", "late").collect()]
    assert counts == [(3, 1, 1, 1, 0), (1, 0, 0, 1, 0), (3, 0, 1, 1, 1)]
    assert all(n == sum(parts) for n, *parts in counts)


def test_a_repeated_batch_replaces_its_own_rows(spark, cfg, rows):
    first = rows(value("a", "a", ["X"], 0), value("r", "hn", [], 0), "{")
    second = rows(value("b", "b", ["X"], 1), value("q", "hn", [], 1))
    write_fanout(first, 0, cfg)
    names = (sinks.RAW_TABLE, sinks.PAIRS_TABLE, sinks.QUARANTINE, sinks.ENTITY_ROWS, sinks.BATCHES)

    def held():
        return {n: sorted(map(str, spark.read.parquet(cfg.sinks.place(n)).collect())) for n in names
                if n != sinks.PAIRS_TABLE or sinks.read_pairs(spark, cfg).count()}

    for batch, frame in ((1, second), (0, first), (1, second)):
        write_fanout(frame, batch, cfg)
        if batch == 1:
            after = held()
            assert [len(after[n]) for n in names] == [2, 1, 1, 2, 2]
    assert held() == after


def test_a_batch_killed_between_sinks_is_made_whole(spark, cfg, rows, monkeypatch):
    from eventlens.streaming import fanout
    frame = rows(value("a", "a", ["X"], 0), value("b", "b", ["X"], 1), value("r", "hn", [], 0))
    real = fanout.land

    def failing(df, path, partitions, batch):
        if path.endswith(sinks.PAIRS_TABLE):
            raise OSError("lost")
        return real(df, path, partitions, batch)

    monkeypatch.setattr(fanout, "land", failing)
    with pytest.raises(OSError):
        write_fanout(frame, 0, cfg)
    assert sinks.read_raw(spark, cfg).count() == 1 and sinks.read_batches(spark, cfg).count() == 0
    monkeypatch.undo()
    write_fanout(frame, 0, cfg)
    assert sinks.read_raw(spark, cfg).count() == 1 and found(spark, cfg) == [("X", "a", "b")]


def send(rows, land_path, *values):
    rows(*values).coalesce(1).write.mode("append").parquet(land_path)


def test_a_stream_is_read_once_and_restarts(spark, cfg, rows, tmp_path):
    at = str(tmp_path / "bus")

    def run():
        stream = spark.readStream.schema(B.BUS).option("maxFilesPerTrigger", 1).parquet(at)
        query = start_fanout(spark, stream, cfg, available_now=True)
        query.awaitTermination()
        return sum(p.numInputRows for p in query.recentProgress)

    send(rows, at, value("a", "a", ["X"], 0), value("r", "hn", [], 0), "no json")
    assert run() == 3  # one scan feeds five sinks
    send(rows, at, value("b", "b", ["X"], 5))
    assert run() == 1
    assert found(spark, cfg) == [("X", "a", "b")]
    assert sinks.read_batches(spark, cfg).count() == 2


def test_late_rows_are_those_that_the_stream_join_drops(spark, cfg, rows, tmp_path):
    at = str(tmp_path / "bus")
    send(rows, at, value("a", "a", ["X"], 60 * MINUTE))
    send(rows, at, *[value(f"b{k}", "b", ["X"], k * 5 * MINUTE) for k in range(13)])
    send(rows, at, *[value(f"c{k}", "c", ["X"], k * 5 * MINUTE) for k in range(9, 13)])

    def stream():
        return spark.readStream.schema(B.BUS).option("maxFilesPerTrigger", 1).parquet(at)

    start_fanout(spark, stream(), cfg, available_now=True).awaitTermination()
    other = Settings.at(str(tmp_path / "joined"))
    query = start_pairs(stream_pairs(B.parse_envelopes(stream())), other, available_now=True)
    query.awaitTermination()
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    # The join keeps a row once on its left side and in three bins on its right.
    assert sinks.read_late(spark, cfg).count() * 4 == dropped > 0
    assert found(spark, cfg) == found(spark, other) != []


def test_a_hot_entity_nobody_named_spreads(spark, cfg, rows):
    """A third of the rows is about one entity; no join task gets twice the rows of a chunk pair."""
    values = [value(f"h{k}", f"s{k % 2}", ["HOT"], k) for k in range(600)]
    values += [value(f"u{k}", f"s{k % 2}", [f"E{k // 4}"], k) for k in range(1200)]
    write_fanout(rows(*values[::2]), 0, cfg)
    write_fanout(rows(*values[1::2]), 1, cfg)
    batch = pairs(B.parse_envelopes(rows(*values)), chunk=50)
    assert found(spark, cfg) == sorted((r.entity, r.a_id, r.b_id) for r in batch.collect())
    assert sum(e == "HOT" for e, _, _ in found(spark, cfg)) == 300 * 300


def test_landing_keeps_other_batches_and_hides_staged_files(spark, tmp_path):
    path = str(tmp_path / "sink")
    one = spark.createDataFrame([(1, "x"), (2, "y z")], "n int, k string")
    assert land(one, path, ["k"], 0) == ["k=x", "k=y z"]
    assert land(one.filter("n = 1"), path, ["k"], 1) == ["k=x"]
    assert land(one.withColumn("n", F.col("n") + 10), path, ["k"], 0) == ["k=x", "k=y z"]
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "x"), (11, "x"), (12, "y z")]
    assert land(one.limit(0), path, ["k"], 2) == []


# ---- tables ----------------------------------------------------------------------------

@pytest.fixture
def own(spark, cfg):
    name = "eventlens_test_fanout"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    yield replace(cfg, tables=replace(cfg.tables, database=name))
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_a_landed_partition_costs_one_statement(spark, own, rows, monkeypatch):
    repair.bootstrap_tables(spark, own)
    said = []
    real = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or real(self, text, *a, **k))
    write_fanout(rows(value("n", "it's", [], 0), value("m", "hn", [], 0)), 0, own, landed=lambda name, touched:
                 name in repair.TABLES and repair.register_partitions(spark, own, name, touched))
    monkeypatch.undo()
    assert [s.split(" ADD ")[0] for s in said] == ["ALTER TABLE eventlens_test_fanout.events_raw"]
    table = spark.table("eventlens_test_fanout.events_raw")
    assert sorted((r.event_id, r.source) for r in table.collect()) == [("m", "hn"), ("n", "it's")]


def test_nothing_foreign_is_dropped_or_used(spark, own, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS eventlens_test_fanout")
    spark.range(3).write.saveAsTable("eventlens_test_fanout.events_raw")
    with pytest.raises(ValueError, match="stands over"):
        repair.bootstrap_tables(spark, own)
    assert spark.table("eventlens_test_fanout.events_raw").count() == 3


def test_failed_registration_looks_through_the_folders(spark, own, rows):
    repair.bootstrap_tables(spark, own)
    write_fanout(rows(value("n", "hn", [], 0)), 0, own)
    assert repair.register_partitions(spark, own, sinks.RAW_TABLE, ["no_such_key=1"])
    assert spark.table("eventlens_test_fanout.events_raw").count() == 1


# ---- backfill --------------------------------------------------------------------------

def test_backfill_keeps_what_the_bus_has_dropped(spark, cfg, rows):
    values = [value(f"n{k}", "hn", [], k) for k in range(5)] + [value("n0", "hn", [], 0)]
    values += [value("a", "a", ["X"], 0), value("b", "b", ["X"], 1), "no json"]
    whole = rows(*values)
    jobs.backfill(whole, cfg)
    before = [sorted(map(str, f(spark, cfg).collect())) for f in
              (sinks.read_raw, sinks.read_pairs, sinks.read_quarantine)]
    assert list(map(len, before)) == [6, 1, 1]
    for frame in (whole.filter("offset >= 4"), whole, whole.limit(0)):
        jobs.backfill(frame, cfg)
        assert before == [sorted(map(str, f(spark, cfg).collect())) for f in
                          (sinks.read_raw, sinks.read_pairs, sinks.read_quarantine)]
