import json

from pyspark.sql import functions as F

from eventlens.settings import Bus, Settings
from eventlens.sources import bus as B


def test_kafka_options():
    options = B.kafka_options(Settings(bus=Bus(servers="b:1")))
    assert options == {
        "kafka.bootstrap.servers": "b:1",
        "subscribePattern": r"events\.(?!.*\.dlq$).*",
        "startingOffsets": "latest",
        "includeHeaders": "true",
    }
    assert B.kafka_options(Settings(), B.ALL_TOPICS)["subscribePattern"] == r"events\..+"


def test_topic_filter(bus):
    topics = ["events.hn", "events.hn.dlq", "events.a.dlq.b", "events.", "xevents.hn", "events"]
    df = bus(*[(t, 0, i, "{}", None, 0) for i, t in enumerate(topics)])
    kept = {r.topic for r in B.topic_filter(df).collect()}
    assert kept == {"events.hn", "events.a.dlq.b", "events."}
    every = {r.topic for r in B.topic_filter(df, B.ALL_TOPICS).collect()}
    assert every == {"events.hn", "events.hn.dlq", "events.a.dlq.b"}


def test_parse_envelopes(bus):
    values = [
        '{"event_id":"a","source":"hn","entities":["X",null],"ts_ms":5,"payload":{"k":{"z":1}}}',
        '{"event_id":7,"ts_ms":5}',
        '{"event_id":"a","ts_ms":"soon"}', '{"event_id":"a","ts_ms":1.5}', '{"ts_ms":5}',
        "[1]", "null", "junk", None,
        '{"event_id":"a","ts_ms":9223372036854775807}', '{"event_id":"a","ts_ms":-62135596800001}',
        '{"event_id":"late","entities":"X","ts_ms":253402300799999}',
    ]
    df = bus(*[("events.hn", 0, i, v, None, 0) for i, v in enumerate(values)])
    rows = {r.event_id: r for r in B.parse_envelopes(df).collect()}
    assert set(rows) == {"a", "7", "late"}
    assert rows["a"].entities == ["X", None]
    assert json.loads(rows["a"].payload) == {"k": {"z": 1}}
    assert rows["late"].entities is None
    dropped = sorted(r.offset for r in B.unparsed(df).collect())
    assert dropped == [2, 3, 4, 5, 6, 7, 8, 9, 10]


def test_records(envelopes):
    df = envelopes(("hn:1", "hn", ["B", "A"], 0), ("hn:2", "hn", [], 1), ("hn:3", "hn", None, 2))
    df = df.withColumn("payload", F.lit('{"z":1,"a":{"y":2,"b":"é"}}'))
    rows = B.to_bus(df).select("topic", F.col("key").cast("string"),
                               F.col("value").cast("string")).collect()
    assert [(r.topic, r.key) for r in rows] == [
        ("events.hn", "B"), ("events.hn", "hn:2"), ("events.hn", "hn:3")]
    assert rows[0].value == ('{"entities":["B","A"],"event_id":"hn:1",'
                             '"payload":{"a":{"b":"é","y":2},"z":1},"source":"hn",'
                             '"ts_ms":1700000000000}')
    assert json.loads(rows[2].value)["entities"] is None


def test_records_parse_back(bus, envelopes):
    sent = envelopes(("hn:1", "hn", ["B"], 0), ("hn:2", "hn", [], 1))
    back = B.parse_envelopes(B.to_bus(sent))
    assert sorted(back.collect()) == sorted(sent.collect())


def test_position_tells_copies_apart(bus):
    value = '{"event_id":"a","ts_ms":5}'
    df = bus(("t", 0, 0, value, None, 0), ("t", 0, 1, value, None, 0), ("t", 1, 0, value, None, 0))
    assert B.parse_envelopes(df, position=True).select("position").distinct().count() == 3


def test_header(spark):
    df = spark.createDataFrame(
        [([("x", b"1"), ("e", b"first"), ("e", b"last")],), ([("e", None)],), ([],), (None,)],
        "h array<struct<key:string,value:binary>>")
    rows = df.select(B.header(F.col("h"), "e").alias("a"),
                     B.header(F.col("h"), "e", last=True).alias("b")).collect()
    assert [tuple(r) for r in rows] == [
        ("first", "last"), ("None", "None"), (None, None), (None, None)]


def test_decode_feed(bus):
    whole = json.dumps({"event_id": "hn:1", "source": "web", "entities": ["X"], "ts_ms": 9,
                        "payload": {"title": "x"}})
    rows = B.decode_feed(bus(
        ("events.hn", 0, 0, whole, None, 0),
        ("events.rss", 0, 1, "not json", None, 0),
        ("events.rss", 0, 2, "[1]", None, 0),
        ("events.hn.dlq", 0, 3, '{"event_id":"hn:bad","payload":null}', "schema: title missing", 0),
        ("events.hn", 0, 4, '{"source":"","ts_ms":"soon"}', "ignored", 0),
    )).orderBy("offset").collect()
    first = rows[0]
    assert (first.event_id, first.source, first.entities, first.ts_ms, first.summary) == (
        "hn:1", "web", ["X"], 9, "x")
    assert json.loads(rows[1].payload) == {"raw": "not json"}
    assert (rows[1].source, rows[1].entities, rows[1].event_id) == ("rss", [], None)
    assert json.loads(rows[2].payload) == {"raw": "[1]"}
    assert (rows[3].error, rows[3].summary, rows[3].payload) == ("schema: title missing", "", None)
    assert (rows[4].source, rows[4].ts_ms, rows[4].error) == ("hn", None, None)


def test_spool(spark, tmp_path):
    df = spark.createDataFrame(
        [('{"a":1}', "schema: bad"), ("junk", "schema: worse")], "value string, reason string")
    B.write_spool(df, str(tmp_path / "spool"), "no broker")
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "spool")).collect())
    assert [json.loads(line) for line in lines] == [
        {"error": "schema: bad", "dlq_error": "no broker", "envelope": {"a": 1}},
        {"error": "schema: worse", "dlq_error": "no broker", "envelope": {"raw": "junk"}}]
