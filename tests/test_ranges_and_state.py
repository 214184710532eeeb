"""Offset ranges of bounded reads, cursors looked up in a map, and the stream's state read back."""

import json

import pytest

from eventlens.operators import latest, status
from eventlens.plans import jobs
from eventlens.registry import default_registry
from eventlens.settings import Settings
from eventlens.sources import bus as B
from eventlens.sources import feeds
from eventlens.streaming.pairs import state_rows, state_versions, stream_pairs
from eventlens.streaming.sinks import PAIRS_QUERY, start_pairs

T0 = 1_700_000_000_000
MINUTE = 60_000


@pytest.fixture
def rows(bus):
    return bus(*[(t, p, o, '{"n": 1}', None, 0) for t, p, offsets in
                 (("events.a", 0, range(3, 20)), ("events.a", 1, range(2)), ("events.b", 0, range(7))) for o in offsets])


def test_ranges_are_the_last_records_of_each_partition(rows):
    ranges = B.tail_ranges(status.ends_of(rows), 4)
    assert {tuple(r) for r in ranges.collect()} == {
        ("events.a", 0, 16, 20), ("events.a", 1, 0, 2), ("events.b", 0, 3, 7)}
    options = B.range_options(ranges)
    assert json.loads(options["assign"]) == {"events.a": [0, 1], "events.b": [0]}
    assert json.loads(options["startingOffsets"]) == {"events.a": {"0": 16, "1": 0}, "events.b": {"0": 3}}
    assert json.loads(options["endingOffsets"]) == {"events.a": {"0": 20, "1": 2}, "events.b": {"0": 7}}
    assert B.range_options(ranges.limit(0)) == {"assign": "{}", "startingOffsets": "{}", "endingOffsets": "{}"}


def test_a_tail_in_ranges_is_the_tail(rows):
    ranges = B.tail_ranges(status.ends_of(rows), 4)
    part = B.within(rows, ranges)
    assert part.count() == 10
    topics = ["events.a", "events.b"]
    assert latest.peek(part, topics, 4).collect() == latest.peek(rows, topics, 4).collect() != []
    assert {tuple(r) for r in status.depths_of(status.ends_of(rows)).collect()} == {("events.a", 19), ("events.b", 7)}


def test_a_topic_nobody_is_configured_for_has_a_depth(spark, bus):
    frame = bus(("events.unknown.dlq", 0, 0, "{}", "why", 0), ("events.unknown.dlq", 0, 1, "{}", "why", 0))
    depths, tail = jobs.dlq_report(spark, default_registry(), frame, "events.unknown.dlq")
    assert [tuple(r) for r in depths.collect()] == [("events.unknown.dlq", 2)]
    assert tail.count() == 2


@pytest.mark.parametrize("limit", [feeds.MAX_SOURCES, 1])
def test_cursors_by_map_and_by_join(spark, envelopes, monkeypatch, limit):
    monkeypatch.setattr(feeds, "MAX_SOURCES", limit)
    frame = envelopes(("old", "a", [], 5), ("new", "a", [], 6), ("b", "b", [], 0), ("c", "c", [], 0),
                      ("none", "a", [], None), ("no source", None, [], 0))
    cursors = spark.createDataFrame([("a", T0 + 5), ("a", T0), ("b", None), (None, T0)], "source string, cursor_ms bigint")
    assert {r.event_id for r in feeds.newer_than(frame, cursors).collect()} == {"new", "b", "c", "none", "no source"}
    plan = feeds.newer_than(frame, cursors)._jdf.queryExecution().executedPlan().toString()
    assert ("Join" in plan) == (limit == 1)


def test_state_after_a_restart(spark, bus, tmp_path):
    """The state holds what is within watermark and window, whatever was stopped in between."""
    cfg, at = Settings.at(str(tmp_path / "sinks")), str(tmp_path / "bus")

    def run(first, *after):
        values = [json.dumps({"event_id": f"e{first + k}", "source": ("hn", "rss")[k % 2], "entities": ["X"],
                              "ts_ms": T0 + m * MINUTE}) for k, m in enumerate(after)]
        bus(*[("events.x", 0, first + k, v, None, 0) for k, v in enumerate(values)]).coalesce(1).write.mode("append").parquet(at)
        stream = spark.readStream.schema(B.BUS).parquet(at)
        start_pairs(stream_pairs(B.parse_envelopes(stream)), cfg, available_now=True).awaitTermination()

    checkpoint = f"{cfg.sinks.checkpoint_root}/{PAIRS_QUERY}"
    run(0, 0, 30, 60)
    assert {r.event_id for r in state_rows(spark, checkpoint).collect()} == {"e2"}
    run(3, 62, 75)
    held = state_rows(spark, checkpoint).collect()
    assert {(r.side, r.event_id) for r in held} == {(s, e) for s in "ab" for e in ("e2", "e3", "e4")}
    versions = state_versions(spark, checkpoint).collect()
    assert versions and all(r.minBatchId <= r.maxBatchId and r.maxBatchId >= 1 for r in versions)
