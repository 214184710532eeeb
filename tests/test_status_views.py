import json
from dataclasses import replace
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from eventlens.settings import Settings
from eventlens.operators import latest as L
from eventlens.operators import status as S
from eventlens.operators import views as V
from eventlens.plans import jobs
from eventlens.registry import Registry, Source, default_registry
from eventlens.sources import bus as B

T0 = 1_700_000_000_000


def msg(event_id, **fields):
    return json.dumps({"event_id": event_id, "source": event_id.split(":")[0], "entities": [],
                       "ts_ms": T0, "payload": {"title": event_id}} | fields)


# ---- status -------------------------------------------------------------------------

def test_rate(bus):
    # The seconds before `now`, oldest first; the second that is still running does not count.
    df = bus(*[("t", 0, k, "x", None, s) for k, s in enumerate(
        (5000.0, 5001.5, 5001.999, 5001.75, 5004.25, 5005.0, 4999.9))])
    assert [r.n for r in S.rate(df, 5005, 5).collect()] == [1, 3, 0, 0, 1]
    assert [r.n for r in S.rate(df, 9000, 2).collect()] == [0, 0]
    assert S.mean_rate(S.rate(df, 5005, 5), 5005, 4).first().per_second == 1.0


def test_depths(spark, bus):
    registry = Registry((Source("hn", "events.hn", "60s"), Source("ghost", "events.ghost", "60s")))
    df = bus(*[("events.hn.dlq", p, o, "x", None, 0) for p in (0, 1) for o in (0, 1, 4)],
             ("events.hn", 0, 7, "x", None, 0))
    rows = {r.topic: r.depth for r in S.dlq_depths(registry.frame(spark), df).collect()}
    assert rows == {"events.hn.dlq": 10, "events.ghost.dlq": 0}


def test_cursor_states(spark, bus):
    registry = Registry(tuple(Source(n, f"events.{n}", "60s") for n in ("a", "b", "c", "d")))
    now = 1_800_000_000_000
    cursors = spark.createDataFrame(
        [("a", now - 1000), ("b", now - 24 * 3_600_000), ("c", now - 24 * 3_600_000 - 1)],
        "source string, cursor_ms bigint")
    df = bus(("events.a", 0, 0, "x", None, 0), ("events.a", 0, 1, "x", None, 0),
             ("events.a.dlq", 0, 0, "x", None, 0), ("events.other", 0, 0, "x", None, 0))
    rows = S.source_status(registry.frame(spark), cursors, df, now).orderBy("name").collect()
    assert [(r.name, r.state, r.n, r.dlq) for r in rows] == [
        ("a", "ok", 2, 1), ("b", "ok", 0, 0), ("c", "stale", 0, 0), ("d", "never", 0, 0)]


def test_cursors_never_move_back(spark, envelopes):
    cursors = spark.createDataFrame(
        [("a", T0 + 50), ("b", T0 - 50), ("old", 5)], "source string, cursor_ms bigint")
    seen = envelopes(("a1", "a", [], 0), ("b1", "b", [], 0), ("b2", "b", [], 9), ("n", "new", [], 1))
    rows = {r.source: r.cursor_ms for r in S.advance_cursors(cursors, seen).collect()}
    assert rows == {"a": T0 + 50, "b": T0 + 9, "old": 5, "new": T0 + 1}


def test_share_of_nothing(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "name string, n bigint")
    assert [r.share for r in S.with_share(df, "n").collect()] == [0.0, 0.0]
    df = spark.createDataFrame([("a", 1), ("b", 3)], "name string, n bigint")
    assert {r.name: r.share for r in S.with_share(df, "n").collect()} == {"a": 0.25, "b": 0.75}


def test_signature_changes_with_the_sinks(spark, envelopes):
    raw = envelopes(("a", "a", [], 0))
    none = spark.createDataFrame([], "ts_ms bigint")
    before = S.sink_signature(none, raw).collect()
    assert tuple(before[0]) == (0, 1, None, T0)
    assert S.sink_signature(none, raw).collect() == before
    assert S.sink_signature(none, raw.unionByName(raw)).collect() != before


# ---- newest first -------------------------------------------------------------------

def test_ring_and_index(bus):
    feed = B.decode_feed(bus(
        *[("events.hn", 0, i, msg(f"hn:{i}"), None, i) for i in range(3)],
        ("events.hn", 0, 3, msg("hn:1", payload={"title": "again"}), None, 9),
        ("events.hn.dlq", 0, 0, msg("hn:bad"), "schema: title missing", 5)))
    events, dead = L.ring(feed, cap=2)
    assert [r.offset for r in events.collect()] == [3, 2]
    assert [(r.event_id, r.error) for r in dead.collect()] == [("hn:bad", "schema: title missing")]
    known = {r.event_id: r.summary for r in L.last_by_id(feed.filter(~B.is_dead_letter())).collect()}
    assert known == {"hn:0": "hn:0", "hn:1": "again", "hn:2": "hn:2"}


def test_last_by_id_combines_before_the_shuffle(bus):
    feed = B.decode_feed(bus(("events.hn", 0, 0, msg("hn:1"), None, 0)))
    plan = L.last_by_id(feed)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_max_by")


def test_since(bus):
    feed = B.decode_feed(bus(
        ("events.a", 0, 0, "x", None, 10), ("events.a", 0, 1, "x", None, 10),
        ("events.a", 1, 0, "x", None, 10), ("events.a", 0, 2, "x", None, 11)))
    at = {"timestamp": datetime.fromtimestamp(10, UTC), "topic": "events.a", "partition": 0,
          "offset": 0}
    rows = sorted((r.partition, r.offset) for r in L.since(feed, at).collect())
    assert rows == [(0, 1), (0, 2), (1, 0)]


def test_peek(bus):
    df = bus(*[("events.a.dlq", p, o, msg(f"a:{p}-{o}"), "schema: x", 0)
               for p, ends in ((0, 10), (1, 4)) for o in range(ends)],
             ("events.b.dlq", 0, 100, "not json {{{", None, 0),
             ("events.b.dlq", 0, 2, "compacted away long ago", None, 0))
    rows = L.peek(df, ["events.a.dlq", "events.b.dlq"], 3).collect()
    assert [(r.topic, r.partition, r.offset) for r in rows] == [
        ("events.a.dlq", 0, 7), ("events.a.dlq", 0, 8), ("events.a.dlq", 0, 9),
        ("events.b.dlq", 0, 100)]
    assert rows[0].error == "schema: x" and json.loads(rows[0].value)["event_id"] == "a:0-7"
    assert rows[3].error is None and json.loads(rows[3].value) == {"raw": "not json {{{"}
    assert L.peek(df, ["events.none.dlq"], 3).collect() == []


def test_peek_limits_before_the_shuffle(bus):
    plan = L.peek(bus(("t", 0, 0, "x", None, 0)), ["t"])._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("WindowGroupLimit") == 4


def test_latest(envelopes):
    df = envelopes(*[(f"e{n:02d}", "a", [], n // 2) for n in range(30)])
    assert [r.event_id for r in L.latest_raw(df, 3).collect()] == ["e28", "e29", "e26"]
    assert "TakeOrderedAndProject" in L.latest_raw(df)._jdf.queryExecution().toString()


def test_store_view(envelopes):
    df = envelopes(("a", "s", [], 0)).withColumn("payload", F.lit('{"title":"hi"}')).withColumn(
        "dt", F.lit("2023-11-14").cast("date"))
    [row] = L.store_view(df).collect()
    assert (row.dt, row.summary) == ("2023-11-14", "hi")


# ---- views --------------------------------------------------------------------------

@pytest.fixture
def stream(bus):
    rows = [("hn:1", ["AAPL", "MSFT"], "Apple news", T0), ("rss:1", [], "Banana", T0 + 90_000),
            ("hn:2", ["AAPL"], "Cherry", None)]
    return B.decode_feed(bus(*[
        (f"events.{i.split(':')[0]}", 0, n, msg(i, entities=e, ts_ms=t, payload={"title": s}), None, n)
        for n, (i, e, s, t) in enumerate(rows)]))


@pytest.mark.parametrize(("query", "ids"), [
    ("", {"hn:1", "rss:1", "hn:2"}),
    ("apple", {"hn:1"}), ("APPLE  news", {"hn:1"}), ("aapl msft", {"hn:1"}),
    ("source:hn", {"hn:1", "hn:2"}), ("source:hn -cherry", {"hn:1"}),
    ("entity:aapl", {"hn:1", "hn:2"}), ("entities:msft", {"hn:1"}),
    ("topic@off:rss@1", {"rss:1"}), ("topic:rss", {"rss:1"}),
    ("day:11-14", {"hn:1", "rss:1"}), ("-day:11-14", {"hn:2"}),
    ("nosuch:x", set()), ("-nosuch:x", {"hn:1", "rss:1", "hn:2"}), ("nosuch:", {"hn:1", "rss:1", "hn:2"}),
    ("-", {"hn:1", "rss:1", "hn:2"}), ("time:22:14", {"rss:1"}), (":13", {"hn:1"}),
    ("aapl apple", {"hn:1"}), ("'quoted", set()),
])
def test_filter_language(stream, query, ids):
    found = V.where_text(stream, query, V.stream_view())
    assert {r.event_id for r in found.collect()} == ids


def test_sorting_puts_missing_values_at_the_far_end(stream):
    view = V.stream_view()
    assert [r.event_id for r in V.order_view(stream, view).collect()] == ["hn:2", "rss:1", "hn:1"]
    ascending = V.order_view(stream, view, "time", desc=False)
    assert [r.event_id for r in ascending.collect()] == ["hn:1", "rss:1", "hn:2"]
    assert [r.event_id for r in V.order_view(stream, view, "summary", False).collect()] == [
        "hn:1", "rss:1", "hn:2"]


@pytest.mark.parametrize(("key", "groups"), [
    ("source", [("hn", 2), ("rss", 1)]),
    ("entity", [("AAPL", 2), ("(none)", 1), ("MSFT", 1)]),
    ("day", [("11-14", 2), ("-", 1)]),
    ("topic", [("events.hn", 2), ("events.rss", 1)]),
])
def test_groups(stream, key, groups):
    rows = V.group_view(stream, V.stream_view(), key).collect()
    assert [(r.group_key, r.n) for r in rows] == groups


def test_resolved_pairs(spark, stream):
    pairs = spark.createDataFrame(
        [("AAPL", "hn:1", "rss:1", T0 + 90_000, "2023-11-14"), ("X", "gone:1", "hn:1", T0, "2023-11-14")],
        "entity string, a_id string, b_id string, ts_ms bigint, dt string")
    resolved = V.resolve_pairs(pairs, L.last_by_id(stream))
    rows = {r.entity: (r.a, r.b, r.gap_ms) for r in resolved.collect()}
    assert rows == {"AAPL": ("Apple news", "Banana", 90_000), "X": ("gone:1", "Apple news", None)}
    view = V.pairs_view()
    assert [(r.group_key, r.n) for r in V.group_view(resolved, view, "pair").collect()] == [
        ("gone × hn", 1), ("hn × rss", 1)]
    assert [r.entity for r in V.where_text(resolved, "gap:1m", view).collect()] == ["AAPL"]
    assert [r.entity for r in V.where_text(resolved, "gap:-", view).collect()] == ["X"]


def test_dead_letter_view(bus):
    feed = B.decode_feed(bus(("events.hn.dlq", 0, 0, msg("hn:1"), "schema: a: b", 0),
                             ("events.hn.dlq", 0, 1, msg("hn:2"), None, 0)))
    view = V.dlq_view()
    assert [(r.group_key, r.n) for r in V.group_view(feed, view, "error").collect()] == [
        ("-", 1), ("schema", 1)]
    assert V.where_text(feed, "error:schema", view).count() == 1


# ---- jobs ---------------------------------------------------------------------------

def test_ingest(spark):
    rows = spark.createDataFrame([
        ("hn:1", "hn", ["OLD"], 2000, '{"title":"buy $AAPL","url":"u"}'),
        ("hn:2", "hn", [], 1000, '{"title":"seen before","url":"u"}'),
        ("hn:3", "hn", [], 3000, '{"title":"text post","url":null}'),
        ("stocks:AAPL:1", "stocks", [], 5000, '{"symbol":"aapl","price":1.5}'),
        ("hn:4", "hn", [], None, '{"title":"no time","url":"u"}'),
    ], "event_id string, source string, entities array<string>, ts_ms bigint, payload string")
    cursors = spark.createDataFrame([("hn", 1000), ("rss", 9)], "source string, cursor_ms bigint")
    out = jobs.ingest(rows, cursors, default_registry())
    records = {r.topic: (r.key.decode(), json.loads(r.value)) for r in out.records.collect()}
    assert set(records) == {"events.hn", "events.stocks"}
    assert records["events.hn"][0] == "AAPL" and records["events.hn"][1]["entities"] == ["AAPL"]
    assert records["events.stocks"][0] == "AAPL"
    rejects = {json.loads(r.value)["event_id"]: (r.topic, r.headers[0].value.decode())
               for r in out.rejects.collect()}
    assert rejects == {
        "hn:3": ("events.hn.dlq", "schema: None is not of type 'string'"),
        "hn:4": ("events.hn.dlq", "schema: ts_ms not an integer")}
    assert {r.source: r.cursor_ms for r in out.cursors.collect()} == {
        "hn": 2000, "rss": 9, "stocks": 5000}


def test_reports(spark, bus, tmp_path):
    registry = Registry((Source("hn", "events.hn", "60s"), Source("rss", "events.rss", "5m")))
    now = 1_725_199_260_000
    cursors = spark.createDataFrame([("hn", now - 60_000)], "source string, cursor_ms bigint")
    df = bus(("events.hn", 0, 0, msg("hn:1"), None, 0),
             ("events.hn.dlq", 0, 0, msg("hn:2"), "schema: bad", 0))
    cfg = Settings.at(str(tmp_path))
    report = jobs.status_report(spark, registry, cursors, df, cfg, now)
    assert [tuple(r) for r in report["sources"].collect()] == [
        ("hn", "2024-09-01T14:00:00Z", "1m", "60s", "ok"), ("rss", "-", "-", "5m", "never")]
    assert [tuple(r) for r in report["dlq"].collect()] == [
        ("events.hn.dlq", 1), ("events.rss.dlq", 0)]
    assert [tuple(r) for r in report["sinks"].collect()] == [
        ("correlated", "0 B"), ("events_raw", "0 B")]
    depths, rows = jobs.dlq_report(spark, registry, df)
    assert depths.count() == 2 and [r.error for r in rows.collect()] == ["schema: bad"]
    frames = jobs.overview(spark, registry, cursors, df, cfg, now)
    assert {name: frame.count() for name, frame in frames.items()} == {
        "sources": 2, "topics": 2, "rate": 60, "mean_rate": 1, "queries": 0, "sinks": 2,
        "stream": 1, "dlq": 1, "stored": 0, "correlated": 0}
    assert [r.name for r in jobs.list_sources(spark, default_registry()).collect()] == [
        "hn", "lobsters", "news", "rss", "stocks"]


def test_unknown_command_is_an_error(monkeypatch, capsys):
    class Builder:
        def __getattr__(self, name):
            return lambda *args, **kwargs: self

    monkeypatch.setattr(jobs, "SparkSession", type("S", (), {"builder": Builder()}))
    assert jobs.main(["nonsense"]) == 2
    assert "correlate" in capsys.readouterr().err
