import json

import pytest
from pyspark.sql import functions as F

from eventlens.operators import validate as V
from eventlens.registry import PAYLOAD_SCHEMAS, Registry, Source, default_registry
from eventlens.sources.bus import ERROR_HEADER, header, to_dlq

CLEAN = {"event_id": "hn:1", "source": "hn", "entities": ["AAPL"], "ts_ms": 1_725_200_000_000,
         "payload": {"title": "thing"}}


def problems(spark, values, registry=None):
    texts = [v if isinstance(v, str) else json.dumps(v) for v in values]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    rows = V.check(df, registry or Registry(())).orderBy("i").collect()
    return [r.problems for r in rows]


def test_envelope_problems(spark):
    cases = [
        (CLEAN, []),
        ({**CLEAN, "event_id": ""}, ["event_id missing or not a string"]),
        ({**CLEAN, "event_id": 7}, ["event_id missing or not a string"]),
        ({**CLEAN, "source": None}, ["source missing or not a string"]),
        ({**CLEAN, "entities": "AAPL"}, ["entities not a list of strings"]),
        ({**CLEAN, "entities": [1]}, ["entities not a list of strings"]),
        ({**CLEAN, "entities": ["A", None]}, ["entities not a list of strings"]),
        ({**CLEAN, "entities": [None]}, ["entities not a list of strings"]),
        ({**CLEAN, "entities": []}, []),
        ({**CLEAN, "ts_ms": "soon"}, ["ts_ms not an integer"]),
        ({**CLEAN, "ts_ms": True}, ["ts_ms not an integer"]),
        ({**CLEAN, "ts_ms": 1.0}, ["ts_ms not an integer"]),
        ({**CLEAN, "ts_ms": 1.5}, ["ts_ms not an integer"]),
        ({**CLEAN, "ts_ms": 10 ** 20}, []),
        ({**CLEAN, "ts_ms": -5}, []),
        ({**CLEAN, "payload": None}, ["payload not an object"]),
        ({**CLEAN, "payload": [1]}, ["payload not an object"]),
        ({}, ["event_id missing or not a string", "source missing or not a string",
              "entities not a list of strings", "ts_ms not an integer", "payload not an object"]),
        ("null", ["envelope is not an object"]),
        ('"nope"', ["envelope is not an object"]),
        ("broken {", ["envelope is not an object"]),
    ]
    assert problems(spark, [c[0] for c in cases]) == [c[1] for c in cases]


def payload_problems(spark, schema, *payloads):
    df = spark.createDataFrame(
        [(i, json.dumps(p)) for i, p in enumerate(payloads)], "i int, payload string")
    return [r.problems for r in V.payload_problems(df, schema).orderBy("i").collect()]


def test_payload_problems(spark):
    schema = {"type": "object", "required": ["title"],
              "properties": {"score": {"type": "integer"}, "title": {"type": ["string", "null"]},
                             "price": {"type": "number"}, "flag": {"type": "boolean"},
                             "tags": {"type": "array", "items": {"type": "string"}},
                             "deep": {"type": "object", "required": ["x"]}}}
    got = payload_problems(
        spark, schema, {"title": "t"}, {"score": "high"}, {"title": None, "score": 1.0},
        {"title": "t", "score": 1e3}, {"title": "t", "score": 1.5}, {"title": 5},
        {"title": "t", "score": True}, {"title": "t", "score": None},
        {"title": "t", "tags": ["a", 1, None, "b"]}, {"title": "t", "tags": "a"},
        {"title": "t", "price": "it's"}, {"title": "t", "price": 'say "hi" to\nhim\\'},
        {"title": "t", "flag": 0}, {"title": "t", "deep": {}}, {"title": "t", "price": 2},
    )
    assert got == [
        [], ["'title' is a required property", "'high' is not of type 'integer'"], [],
        [], ["1.5 is not of type 'integer'"], ["5 is not of type 'string', 'null'"],
        ["True is not of type 'integer'"], ["None is not of type 'integer'"],
        ["1 is not of type 'string'", "None is not of type 'string'"],
        ["'a' is not of type 'array'"],
        ['"it\'s" is not of type \'number\''],
        ["'say \"hi\" to\\nhim\\\\' is not of type 'number'"],
        ["0 is not of type 'boolean'"], ["'x' is a required property"], [],
    ]


def test_no_schema_means_no_payload_check(spark):
    assert payload_problems(spark, None, {"anything": 1}) == [[]]


def test_messages_follow_the_order_of_the_schema(spark):
    schema = {"properties": {"score": {"type": "integer"}}, "required": ["title"]}
    assert payload_problems(spark, schema, {"score": "x"}) == [
        ["'x' is not of type 'integer'", "'title' is a required property"]]


@pytest.mark.parametrize("schema", [
    {"minimum": 3}, {"additionalProperties": False}, {"type": "date"},
    {"items": {"minLength": 1}}, {"properties": {"a": {"pattern": "x"}}},
])
def test_unsupported_schema_raises(spark, schema):
    with pytest.raises(ValueError):
        payload_problems(spark, schema, {})


def test_payload_is_checked_only_in_a_clean_envelope(spark):
    registry = Registry((Source("hn", "events.hn", "60s", payload_schema={
        "type": "object", "required": ["title"]}),))
    assert problems(spark, [{**CLEAN, "payload": {"score": 1}, "ts_ms": "bad"},
                            {**CLEAN, "payload": {}}, {**CLEAN, "source": "other", "payload": {}}],
                    registry) == [["ts_ms not an integer"], ["'title' is a required property"], []]


def test_built_in_contracts(spark):
    assert set(PAYLOAD_SCHEMAS) == {"hn", "lobsters", "news", "rss", "stocks"}
    assert problems(spark, [
        {**CLEAN, "payload": {"title": "t", "url": None, "score": 5}},
        {**CLEAN, "source": "lobsters", "payload": {"title": "t", "url": None, "score": None,
                                                   "tags": []}},
        {**CLEAN, "source": "stocks", "payload": {"symbol": "A", "price": "1"}},
        {**CLEAN, "source": "news", "payload": {}},
    ], default_registry()) == [
        ["None is not of type 'string'"], [], ["'1' is not of type 'number'"],
        ["'symbol' is a required property", "'title' is a required property"]]


def test_dead_letters_of_broken_values(spark):
    values = ["null", '"a string"', "{}", '{"source":"hn"}', '{"source":7}', "junk",
              '{"source":"hn","event_id":"hn:1","entities":["E","F"]}',
              '{"source":"hn","event_id":"hn:1","entities":[]}',
              '{"source":"hn","event_id":"hn:1","entities":[1]}',
              '{"source":"hn","event_id":7}']
    df = spark.createDataFrame(
        [(v, "schema: bad") for v in values], "value string, reason string")
    rows = to_dlq(df).select(
        "topic", F.col("key").cast("string"), F.col("value").cast("string"),
        header(F.col("headers"), ERROR_HEADER).alias("error")).collect()
    topics = [r.topic for r in rows]
    assert topics == ["events.unknown.dlq"] * 3 + ["events.hn.dlq"] + ["events.unknown.dlq"] * 2 + [
        "events.hn.dlq"] * 4
    assert [r.key for r in rows] == ["unknown"] * 6 + ["E", "hn:1", "unknown", "unknown"]
    assert rows[0].value == "null" and rows[5].value == '{"raw":"junk"}'
    assert {r.error for r in rows} == {"schema: bad"}


def test_route(spark):
    registry = Registry(())
    df = spark.createDataFrame(
        [(json.dumps({**CLEAN, "event_id": "hn:bad", "ts_ms": "soon"}),),
         (json.dumps({**CLEAN, "ts_ms": 1000}),)], "value string")
    good, bad = V.route(df, registry)
    assert [json.loads(r.value)["event_id"] for r in good.collect()] == ["hn:1"]
    [row] = bad.select("topic", header(F.col("headers"), ERROR_HEADER).alias("e")).collect()
    assert (row.topic, row.e) == ("events.hn.dlq", "schema: ts_ms not an integer")
