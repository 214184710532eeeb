"""Every operator as a query over the given tables, with the SQL that checks it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions import entities as E
from eventlens.functions import jsontext as J
from eventlens.functions import times as T
from eventlens.operators import correlate as C
from eventlens.operators import latest as L
from eventlens.operators import status as S
from eventlens.operators import validate as V
from eventlens.operators import views
from eventlens.plans import jobs
from eventlens.plans import workload as W
from eventlens.registry import Registry, Source
from eventlens.settings import Settings
from eventlens.sources import bus as B
from eventlens.sources import feeds, sinks
from eventlens.streaming import repair
from eventlens.streaming import sinks as K
from eventlens.streaming.fanout import write_fanout
from eventlens.streaming.index import read_index, update_index
from eventlens.streaming.pairs import state_rows, stream_pairs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

c = F.col


def query(sql: str | None = None):
    """Registers a query under its function name, and the SQL with the same result."""
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return add


# ---- shared SQL ---------------------------------------------------------------------

ENV = """
env AS (
  SELECT event_type || ':' || event_id AS event_id, event_type AS source,
         CASE WHEN event_id % 5 = 0 THEN []::VARCHAR[] ELSE ['U' || user_id] END AS entities,
         (epoch_us(ts) // 1000) AS ts_ms, props AS payload, event_id AS n, ts
  FROM events)"""

PER_ENTITY = ENV + """,
ent AS (SELECT event_id, source, ts_ms, unnest(entities) AS entity FROM env)"""

PAIRS = PER_ENTITY + """,
pairs AS (
  SELECT l.entity, l.event_id AS a_id, r.event_id AS b_id,
         greatest(l.ts_ms, r.ts_ms) AS ts_ms, l.ts_ms AS a_ms, r.ts_ms AS b_ms
  FROM ent l JOIN ent r ON l.entity = r.entity AND l.source < r.source
   AND abs(l.ts_ms - r.ts_ms) <= 600000)"""

BUS = """
bus AS (
  SELECT 'events.' || event_type || CASE WHEN event_id % 97 = 0 THEN '.dlq' ELSE '' END AS topic,
         event_id % 6 AS "partition", event_id // 6 AS "offset", ts AS "timestamp",
         event_type || ':' || event_id AS event_id, event_type AS source, event_id AS n,
         CASE WHEN event_id % 5 = 0 THEN []::VARCHAR[] ELSE ['U' || user_id] END AS entities,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE (epoch_us(ts) // 1000) END AS ts_ms,
         json(props)::VARCHAR AS payload
  FROM events)"""

# The payload is {"k": number}: shown as it is written.
FEED = BUS + """,
feed AS (
  SELECT *, replace(payload, ':', ': ') AS summary,
         CASE WHEN topic LIKE '%.dlq' THEN 'schema: ts_ms not an integer' END AS error
  FROM bus)"""

DAY = "strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d')"
SHORT = "coalesce(strftime(make_timestamp(ts_ms * 1000), '%m-%d %H:%M:%S'), '-')"


def _first_seen(items: str) -> str:
    """SQL for a list's distinct items in first-seen order, joined by spaces."""
    return (f"array_to_string(list_filter({items}, "
            f"lambda x, i: list_position({items}, x) = i), ' ')")


def _text_dt(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", c("dt").cast("string"))


def _joined(name: str) -> Column:
    return F.array_join(c(name), " ").alias(name)


# ---- sources, parsing ---------------------------------------------------------------

@query(f"""WITH {BUS} SELECT topic, "partition", "offset" FROM bus
WHERE topic LIKE 'events.%' AND topic NOT LIKE '%.dlq'""")
def topic_filter(spark, sf_dir):
    return B.topic_filter(W.bus(spark, sf_dir)).select(
        "topic", c("partition").cast("bigint").alias("partition"), "offset")


@query(f"WITH {BUS} SELECT topic, count(*) AS n FROM bus GROUP BY topic")
def topic_filter_with_dead_letters(spark, sf_dir):
    return S.topic_counts(B.topic_filter(W.bus(spark, sf_dir), B.ALL_TOPICS))


@query(f"""WITH {BUS} SELECT event_id, source, array_to_string(entities, ' ') AS entities,
ts_ms, payload FROM bus WHERE ts_ms IS NOT NULL""")
def parse_envelopes(spark, sf_dir):
    return B.parse_envelopes(W.bus(spark, sf_dir)).withColumn("entities", _joined("entities"))


@query(f'WITH {BUS} SELECT topic, "offset" FROM bus WHERE ts_ms IS NULL')
def unparsed(spark, sf_dir):
    return B.unparsed(W.bus(spark, sf_dir)).select("topic", "offset")


def _hn_documents(spark, sf_dir):
    return W.table(spark, sf_dir, "documents").select(F.to_json(F.struct(
        c("doc_id").alias("id"),
        F.when(c("doc_id") % 4 == 0, "job").otherwise("story").alias("type"),
        (c("doc_id") * 60 + 1_700_000_000).alias("time"),
        c("text").alias("title"),
        F.when(c("doc_id") % 3 != 0, c("source")).alias("url"),
        c("n_chars").alias("score"),
    )).alias("document"))


def _payload(name: str) -> Column:
    return F.get_json_object("payload", f"$.{name}")


@query("""SELECT 'hn:' || doc_id AS event_id, 'hn' AS source,
(doc_id * 60 + 1700000000) * 1000 AS ts_ms, md5(text) AS title,
CASE WHEN doc_id % 3 != 0 THEN source END AS url, n_chars::VARCHAR AS score
FROM documents WHERE doc_id % 4 != 0""")
def hn_envelopes(spark, sf_dir):
    return feeds.hn_envelopes(_hn_documents(spark, sf_dir)).select(
        "event_id", "source", "ts_ms", F.md5(_payload("title")).alias("title"),
        _payload("url").alias("url"), _payload("score").alias("score"))


def _lobsters_documents(spark, sf_dir):
    at = F.timestamp_seconds(c("doc_id") * 60 + 1_700_000_000)
    created = F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000-05:00"))
    story = F.to_json(F.struct(
        F.concat(F.lit("a"), c("doc_id")).alias("short_id"), c("text").alias("title"),
        created.alias("created_at"),
        F.when(c("doc_id") % 2 == 0, F.lit("")).otherwise(c("source")).alias("url"),
        F.array("lang").alias("tags")))
    late = F.to_json(F.struct(
        F.concat(F.lit("b"), c("doc_id")).alias("short_id"), c("lang").alias("title"),
        F.when(c("doc_id") % 3 == 0, F.lit("not a time")).otherwise(created).alias("created_at"),
        c("n_chars").alias("score")))
    stories = F.concat(F.lit("["), story, F.lit(',"not a story",null,'), late, F.lit("]"))
    other = F.lit('{"error": "rate limited"}')
    return W.table(spark, sf_dir, "documents").select(
        F.when(c("doc_id") % 10 == 0, other).otherwise(stories).alias("document"))


@query("""WITH docs AS (SELECT *, (doc_id * 60 + 1700000000 + 18000) * 1000 AS ts_ms
FROM documents WHERE doc_id % 10 != 0)
SELECT 'lobsters:a' || doc_id AS event_id, ts_ms, md5(text) AS title,
 CASE WHEN doc_id % 2 != 0 THEN source END AS url, NULL::VARCHAR AS score,
 '["' || lang || '"]' AS tags FROM docs
UNION ALL
SELECT 'lobsters:b' || doc_id, ts_ms, md5(lang), NULL, n_chars::VARCHAR, '[]' FROM docs
WHERE doc_id % 3 != 0""")
def lobsters_envelopes(spark, sf_dir):
    return feeds.lobsters_envelopes(_lobsters_documents(spark, sf_dir)).select(
        "event_id", "ts_ms", F.md5(_payload("title")).alias("title"),
        _payload("url").alias("url"), _payload("score").alias("score"),
        _payload("tags").alias("tags"))


def _escaped(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def _xml_documents(spark, sf_dir):
    at = F.timestamp_seconds(c("doc_id") * 60 + 1_700_000_000)
    link = F.concat(F.lit("https://example.com/"), c("doc_id"))
    return W.table(spark, sf_dir, "documents").select(
        F.upper("lang").alias("symbol"),
        (c("doc_id") * 1000 + 1_800_000_000_000).alias("ingest_ms"),
        F.when(c("doc_id") % 20 == 0, F.lit("<rss><channel><item>")).otherwise(F.concat(
            F.lit("<rss><channel><title>feed</title><item><title>"), _escaped(c("text")),
            F.lit("</title><link>"), link, F.lit("</link><guid isPermaLink='false'>g"),
            c("doc_id"), F.lit("</guid><pubDate>"),
            F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" EST</pubDate></item>"),
            F.lit("<item><title></title><link>"), link,
            F.lit("/2</link><pubDate>yesterday</pubDate></item></channel></rss>"),
        )).alias("document"))


_XML_DOCS = """docs AS (SELECT *, (doc_id * 60 + 1700000000 + 18000) * 1000 AS ts_ms,
 doc_id * 1000 + 1800000000000 AS ingest_ms, 'https://example.com/' || doc_id AS link,
 md5(text) AS title FROM documents WHERE doc_id % 20 != 0)"""


@query(f"""WITH {_XML_DOCS}
SELECT 'rss:g' || doc_id AS event_id, ts_ms, title, link FROM docs
UNION ALL SELECT 'rss:' || link || '/2', ingest_ms, md5(''), link || '/2' FROM docs""")
def rss_envelopes(spark, sf_dir):
    return feeds.rss_envelopes(_xml_documents(spark, sf_dir)).select(
        "event_id", "ts_ms", F.md5(_payload("title")).alias("title"),
        _payload("link").alias("link"))


@query(f"""WITH {_XML_DOCS}
SELECT 'news:' || upper(lang) || ':g' || doc_id AS event_id, ts_ms, title, link,
upper(lang) AS symbol FROM docs""")
def news_envelopes(spark, sf_dir):
    return feeds.news_envelopes(_xml_documents(spark, sf_dir)).select(
        "event_id", "ts_ms", F.md5(_payload("title")).alias("title"),
        _payload("link").alias("link"), _payload("symbol").alias("symbol"))


@query("""WITH q AS (SELECT *, CASE WHEN event_id % 7 = 3 THEN event_id + 1800000000000
 ELSE (epoch_us(ts) // 1000) // 1000 * 1000 END AS ts_ms FROM events WHERE event_id % 7 > 1)
SELECT 'stocks:U' || user_id || ':' || ts_ms AS event_id, ts_ms, upper(event_type) AS symbol,
CASE WHEN event_id % 7 = 2 THEN 'USD' ELSE 'EUR' END AS currency,
round(value * 100)::BIGINT AS cents FROM q""")
def stocks_envelopes(spark, sf_dir):
    kind = c("event_id") % 7
    meta = F.to_json(F.struct(
        F.when(kind != 2, "EUR").alias("currency"),
        F.upper("event_type").alias("symbol"),
        F.when(kind != 1, c("value")).alias("regularMarketPrice"),
        F.when(kind != 3, F.unix_seconds(c("ts").cast("timestamp"))).alias("regularMarketTime"),
    ))
    quote = F.concat(F.lit('{"chart":{"result":[{"meta":'), meta, F.lit("}]}}"))
    empty = F.lit('{"chart":{"result":[]}}')
    docs = W.table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), c("user_id")).alias("symbol"),
        F.when(kind == 0, empty).otherwise(quote).alias("document"),
        (c("event_id") + 1_800_000_000_000).alias("ingest_ms"))
    return feeds.stocks_envelopes(docs).select(
        "event_id", "ts_ms", _payload("symbol").alias("symbol"),
        _payload("currency").alias("currency"),
        F.round(_payload("price").cast("double") * 100).cast("bigint").alias("cents"))


# Three sources have a cursor: one a day past its last event, two halfway through.
_CURSORS = """cursors AS (SELECT source, CASE WHEN source = 'click' THEN max(ts_ms) + 86400000
ELSE (min(ts_ms) + max(ts_ms)) // 2 END AS cursor_ms FROM env WHERE source < 'q' GROUP BY source)"""


def _cursors(spark, sf_dir):
    some = W.envelopes(spark, sf_dir).filter(c("source") < "q").groupBy("source")
    return some.agg(F.min("ts_ms").alias("lo"), F.max("ts_ms").alias("hi")).select(
        "source",
        F.when(c("source") == "click", c("hi") + T.DAY_MS)
        .otherwise(F.floor((c("lo") + c("hi")) / 2)).alias("cursor_ms"))


@query(f"""WITH {ENV}, {_CURSORS}
SELECT event_id, source, ts_ms FROM env LEFT JOIN cursors USING (source)
WHERE cursor_ms IS NULL OR ts_ms > cursor_ms""")
def newer_than(spark, sf_dir):
    fresh = feeds.newer_than(W.envelopes(spark, sf_dir), _cursors(spark, sf_dir))
    return fresh.select("event_id", "source", "ts_ms")


# ---- scalar functions ---------------------------------------------------------------

@query(f"""WITH {ENV} SELECT event_id, epoch_us(make_timestamp(ts_ms * 1000)) AS event_us,
{DAY} AS dt, {SHORT} AS short,
strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%dT%H:%M:%SZ') AS iso FROM env""")
def event_times(spark, sf_dir):
    ts = c("ts_ms")
    return W.envelopes(spark, sf_dir).select(
        "event_id", F.unix_micros(T.event_time(ts)).alias("event_us"),
        T.event_date(ts).cast("string").alias("dt"), T.short_time(ts).alias("short"),
        T.isotime(ts).alias("iso"))


@query(f"WITH {ENV} SELECT event_id, source FROM env WHERE len(entities) = 0")
def entityless(spark, sf_dir):
    return C.entityless(W.envelopes(spark, sf_dir)).select("event_id", "source")


@query(f"WITH {PER_ENTITY} SELECT event_id, source, ts_ms, entity FROM ent")
def per_entity(spark, sf_dir):
    return C.per_entity(W.envelopes(spark, sf_dir))


@query("""SELECT doc_id, md5(text || ' ' || source) AS digest FROM documents""")
def entity_text(spark, sf_dir):
    docs = W.table(spark, sf_dir, "documents")
    payload = F.to_json(F.struct(c("text").alias("title"), c("source").alias("url"), "lang"))
    return docs.select(
        "doc_id", F.md5(E.entity_text(payload, ["title", "absent", "url"])).alias("digest"))


_CASHTAGS = r"list_transform(regexp_extract_all({}, '\$([A-Za-z]{{1,5}})\b', 1), lambda t: upper(t))"
_TITLE = "'$' || event_type || ' buy $U' || user_id || ' and $view $View now'"


def _title() -> Column:
    return F.concat(F.lit("$"), "event_type", F.lit(" buy $U"), c("user_id").cast("string"),
                    F.lit(" and $view $View now"))


@query(f"SELECT event_id, {_first_seen(_CASHTAGS.format(_TITLE))} AS tags FROM events")
def cashtags(spark, sf_dir):
    events = W.table(spark, sf_dir, "events")
    return events.select("event_id", F.array_join(E.cashtags(_title()), " ").alias("tags"))


# DuckDB leaves sharp s alone where upper case is SS.
_UPPER = "upper(replace({}, 'ß', 'SS'))"
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"


@query(f"""WITH t AS (SELECT doc_id, list_filter(list_transform(
 regexp_split_to_array(text, '{_WS}+'), lambda t: {_UPPER.format('t')}),
 lambda t: regexp_matches(t, '^[A-Z][A-Z.\\-]{{0,9}}$')) AS tokens FROM documents)
SELECT doc_id, md5({_first_seen('tokens')}) AS digest FROM t""")
def symbol_tokens(spark, sf_dir):
    found = F.array_join(E.symbol_tokens(c("text")), " ")
    return W.table(spark, sf_dir, "documents").select("doc_id", F.md5(found).alias("digest"))


_STOP = ", ".join(f"'{w}'" for w in E.STOP_WORDS)
_EDGE = """[$.,;()\\[\\]"'']+"""


@query(f"""WITH t AS (SELECT doc_id, {_CASHTAGS.format('text')} AS tags,
 list_filter(list_transform(regexp_split_to_array(text, '({_WS}|[,;])+'),
 lambda t: {_UPPER.format(f"regexp_replace(t, '^{_EDGE}|{_EDGE}$', '', 'g')")}),
 lambda t: regexp_matches(t, '^[A-Z]{{1,5}}$') AND t NOT IN ({_STOP})) AS bare FROM documents)
SELECT doc_id, md5(CASE WHEN len(tags) > 0 THEN {_first_seen('tags')}
 ELSE {_first_seen('bare')} END) AS digest FROM t""")
def tickers(spark, sf_dir):
    found = F.array_join(E.tickers(c("text")), " ")
    return W.table(spark, sf_dir, "documents").select("doc_id", F.md5(found).alias("digest"))


@query(f"""WITH t AS (SELECT doc_id, list_filter(list_transform(string_split(text, '.'),
 lambda s: regexp_replace(s, '^{_WS}+|{_WS}+$', '', 'g')), lambda s: s != '') AS parts
FROM documents)
SELECT doc_id, md5({_first_seen('parts')}) AS digest FROM t""")
def normalize_entities(spark, sf_dir):
    parts = E.normalize_entities(F.split("text", r"\."))
    return W.table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(F.array_join(parts, " ")).alias("digest"))


def _titled(spark, sf_dir):
    return W.table(spark, sf_dir, "events").select(
        F.concat_ws(":", "event_type", c("event_id").cast("string")).alias("event_id"),
        c("event_type").alias("source"),
        F.array(F.lit("PREFILLED")).alias("entities"),
        F.unix_millis(c("ts").cast("timestamp")).alias("ts_ms"),
        F.to_json(F.struct(_title().alias("title"), c("user_id").alias("k"))).alias("payload"))


def _extractors() -> Registry:
    return Registry((
        Source("click", "events.click", "60s", ("title",)),
        Source("view", "events.view", "60s", ("title", "k"), E.symbol_tokens),
        Source("error", "events.error", "5m", ("k", "title"), E.tickers),
        Source("signup", "events.signup", "5m"),
    ))


@query(f"""SELECT event_type || ':' || event_id AS event_id, CASE
WHEN event_type IN ('click', 'error') THEN {_first_seen(_CASHTAGS.format(_TITLE))}
WHEN event_type = 'view' THEN 'BUY AND NOW' ELSE '' END AS entities FROM events""")
def fill_entities(spark, sf_dir):
    filled = feeds.fill_entities(_titled(spark, sf_dir), _extractors())
    return filled.select("event_id", _joined("entities"))


_SUMMARY_KIND = "event_id % 6"


@query(f"""SELECT event_id, CASE {_SUMMARY_KIND}
WHEN 0 THEN 'U' || user_id || ' ' || event_id || '.5 EUR'
WHEN 1 THEN 'U' || user_id || ' · ' || event_type
WHEN 2 THEN event_type || ' happened'
WHEN 3 THEN '{{"a": [' || event_id || ', 2], "b": "x,y:z"}}'
WHEN 4 THEN '' ELSE 'U' || user_id || ' 7' END AS summary FROM events""")
def summary(spark, sf_dir):
    kind, user = c("event_id") % 6, F.concat(F.lit("U"), c("user_id").cast("string"))
    payload = (
        F.when(kind == 0, F.to_json(F.struct(
            user.alias("symbol"), (c("event_id") + F.lit(0.5)).alias("price"),
            F.lit("EUR").alias("currency"))))
        .when(kind == 1, F.to_json(F.struct(user.alias("symbol"), c("event_type").alias("title"))))
        .when(kind == 2, F.to_json(F.struct(
            F.concat("event_type", F.lit(" happened")).alias("title"))))
        .when(kind == 3, F.concat(F.lit('{"b":"x,y:z","a":['), c("event_id").cast("string"),
                                  F.lit(",2]}")))
        .when(kind == 5, F.concat(F.lit('{"price":7,"currency":null,"symbol":"'), user,
                                  F.lit('"}')))
    )
    return W.table(spark, sf_dir, "events").select("event_id", J.summary(payload).alias("summary"))


@query("""SELECT event_id, CASE
WHEN event_id * 4567 < 1000 THEN 'now' WHEN event_id * 4567 >= 86400000
THEN event_id * 4567 // 86400000 || 'd' WHEN event_id * 4567 >= 3600000
THEN event_id * 4567 // 3600000 || 'h' WHEN event_id * 4567 >= 60000
THEN event_id * 4567 // 60000 || 'm' ELSE event_id * 4567 // 1000 || 's' END AS age,
event_id % 100 * CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 60 ELSE 3600 END AS interval_s,
CASE WHEN b < 1024 THEN b || ' B' WHEN b < 1048576 THEN printf('%.1f KiB', b / 1024)
WHEN b < 1073741824 THEN printf('%.1f MiB', b / 1048576)
WHEN b < 1099511627776 THEN printf('%.1f GiB', b / 1073741824)
ELSE printf('%.1f TiB', b / 1099511627776) END AS size
FROM (SELECT event_id, event_id * event_id * event_id * 8 AS b FROM events)""")
def readable_texts(spark, sf_dir):
    n = c("event_id")
    unit = F.element_at(F.array(F.lit("s"), F.lit("m"), F.lit("h")), (n % 3 + 1).cast("int"))
    # From about a million on the cube of an id no longer fits 64 bits.
    wide = n.cast("decimal(20,0)")
    return W.table(spark, sf_dir, "events").select(
        "event_id", T.age(n * 4567).alias("age"),
        T.interval_seconds(F.concat((n % 100).cast("string"), unit)).alias("interval_s"),
        J.human_bytes(wide * wide * wide * 8).alias("size"))


@query("""SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS first_error,
CASE event_id % 3 WHEN 1 THEN event_type WHEN 2 THEN 'U' || user_id END AS last_error
FROM events""")
def headers(spark, sf_dir):
    def one(key: str, text: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), text.cast("binary").alias("value"))

    user = F.concat(F.lit("U"), c("user_id").cast("string"))
    made = (
        F.when(c("event_id") % 3 == 0, F.array(one("other", user)))
        .when(c("event_id") % 3 == 1, F.array(one(B.ERROR_HEADER, c("event_type"))))
        .otherwise(F.array(one("other", user), one(B.ERROR_HEADER, c("event_type")),
                           one(B.ERROR_HEADER, user)))
    )
    return W.table(spark, sf_dir, "events").select(
        "event_id", B.header(made, B.ERROR_HEADER).alias("first_error"),
        B.header(made, B.ERROR_HEADER, last=True).alias("last_error"))


# ---- bus records, validation, routing -----------------------------------------------

@query(f"""WITH {ENV} SELECT 'events.' || source AS topic,
coalesce(entities[1], event_id) AS key,
'{{"entities":[' || CASE WHEN len(entities) > 0 THEN '"' || entities[1] || '"' ELSE '' END
|| '],"event_id":"' || event_id || '","payload":' || json(payload)::VARCHAR || ',"source":"'
|| source || '","ts_ms":' || ts_ms || '}}' AS value FROM env""")
def to_bus(spark, sf_dir):
    return B.to_bus(W.envelopes(spark, sf_dir)).select(
        "topic", c("key").cast("string").alias("key"), c("value").cast("string").alias("value"))


def _mutated(spark, sf_dir):
    """Event values broken in one way or another, by the event's number."""
    kind = c("event_id") % 13

    def part(name: str, good: Column, *broken: tuple[int, str]) -> Column:
        value = good
        for n, text in broken:
            value = F.when(kind == n, F.lit(text)).otherwise(value)
        return F.concat(F.lit(f'"{name}":'), value)

    quoted = F.concat(F.lit('"'), c("event_type"), F.lit('"'))
    own_id = F.concat(F.lit('"'), "event_type", F.lit(":"), c("event_id").cast("string"),
                      F.lit('"'))
    ts = F.unix_millis(c("ts").cast("timestamp")).cast("string")
    k = F.get_json_object("props", "$.k")
    whole = F.concat(
        F.lit("{"), part("event_id", own_id, (1, "7")), F.lit(","),
        part("source", quoted, (2, '""')), F.lit(","),
        part("entities", F.lit('["U"]'), (3, '"AAPL"'), (6, "[1]"), (10, "[]")), F.lit(","),
        part("ts_ms", ts, (4, '"soon"'), (6, "true"), (12, "1.0")), F.lit(","),
        part("payload", F.concat(F.lit('{"k":'), k, F.lit("}")), (5, "null"),
             (8, '{"k":"high"}'), (9, '{"z":1}'), (11, '{"k":1.5}')),
        F.lit("}"),
    )
    value = F.when(kind == 7, F.concat(F.lit("not json "), c("event_id").cast("string")))
    return W.table(spark, sf_dir, "events").select("event_id", value.otherwise(whole).alias("value"))


_PROBLEMS = """mut AS (SELECT event_id, event_type, event_id % 13 AS kind, CASE event_id % 13
WHEN 1 THEN 'event_id missing or not a string' WHEN 2 THEN 'source missing or not a string'
WHEN 3 THEN 'entities not a list of strings' WHEN 4 THEN 'ts_ms not an integer'
WHEN 5 THEN 'payload not an object'
WHEN 6 THEN 'entities not a list of strings; ts_ms not an integer'
WHEN 7 THEN 'envelope is not an object'
WHEN 8 THEN '''high'' is not of type ''integer''' WHEN 9 THEN '''k'' is a required property'
WHEN 11 THEN '1.5 is not of type ''integer''' WHEN 12 THEN 'ts_ms not an integer'
ELSE '' END AS problems FROM events)"""


@query(f"WITH {_PROBLEMS} SELECT event_id, problems FROM mut")
def check(spark, sf_dir):
    checked = V.check(_mutated(spark, sf_dir), W.registry())
    return checked.select("event_id", F.array_join("problems", "; ").alias("problems"))


@query(f"WITH {_PROBLEMS} SELECT event_id FROM mut WHERE problems = ''")
def route_valid(spark, sf_dir):
    return V.route(_mutated(spark, sf_dir), W.registry())[0].select("event_id")


@query(f"""WITH {_PROBLEMS}
SELECT CASE WHEN kind IN (2, 7) THEN 'events.unknown.dlq'
 ELSE 'events.' || event_type || '.dlq' END AS topic,
CASE WHEN kind = 3 THEN 'A' WHEN kind IN (6, 7) THEN 'unknown' ELSE 'U' END AS key,
'schema: ' || problems AS error FROM mut WHERE problems != ''""")
def route_dead_letters(spark, sf_dir):
    rejects = V.route(_mutated(spark, sf_dir), W.registry())[1]
    return rejects.select("topic", c("key").cast("string").alias("key"),
                          B.header(c("headers"), B.ERROR_HEADER).alias("error"))


@query(f"""WITH {_PROBLEMS} SELECT 'schema: ' || problems AS error, 'no broker' AS dlq_error,
CASE WHEN kind = 7 THEN 'not json ' || event_id END AS raw,
CASE WHEN kind IN (2, 7) THEN NULL ELSE event_type END AS source FROM mut WHERE problems != ''""")
def spool(spark, sf_dir):
    checked = V.check(_mutated(spark, sf_dir), W.registry()).filter(F.size("problems") > 0)
    path = sinks.scratch_dir(spark, "spool")
    B.write_spool(checked.withColumn("reason", V.reason(c("problems"))), path, "no broker")
    lines = "error string, dlq_error string, envelope struct<raw:string, source:string>"
    return spark.read.schema(lines).json(path).select(
        "error", "dlq_error", "envelope.raw",
        F.when(c("envelope.source") != "", c("envelope.source")).alias("source"))


# ---- pairs --------------------------------------------------------------------------

@query(f"WITH {PAIRS} SELECT entity, a_id, b_id, ts_ms, {DAY} AS dt FROM pairs")
def pairs(spark, sf_dir):
    return _text_dt(C.pairs(W.envelopes(spark, sf_dir)))


@query(f"""WITH {PAIRS} SELECT entity, a_id, b_id, ts_ms, {DAY} AS dt FROM pairs
ORDER BY ts_ms DESC, entity, a_id, b_id LIMIT 10""")
def latest_pairs(spark, sf_dir):
    return _text_dt(L.latest_pairs(C.pairs(W.envelopes(spark, sf_dir))))


@query(f"""WITH {PAIRS}, twice AS (SELECT * FROM pairs, range(2) a, range(2) b)
SELECT entity, a_id, b_id, ts_ms, {DAY} AS dt FROM twice""")
def pairs_of_copies(spark, sf_dir):
    rows = W.envelopes(spark, sf_dir)
    return _text_dt(C.pairs(rows.unionByName(rows)))


def _scratch(spark: SparkSession, label: str) -> Settings:
    base = sinks.scratch_dir(spark, label)
    return Settings.at(base)


def _bus_stream(spark, sf_dir):
    """The events file read as a stream and turned into bus rows."""
    events = W.table(spark, sf_dir, "events")
    # A stream source lists folders: the pattern finds the table as a folder and as a single file.
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]")
    return W.bus_rows(stream)


@query(f"WITH {PAIRS.replace('FROM env)', 'FROM env WHERE n % 97 != 0)')} "
       f"SELECT entity, a_id, b_id, ts_ms, {DAY} AS dt FROM pairs")
def stream_pairs_to_sink(spark, sf_dir):
    cfg = _scratch(spark, "pairs")
    envelopes = B.parse_envelopes(B.topic_filter(_bus_stream(spark, sf_dir)), position=True)
    K.start_pairs(stream_pairs(envelopes), cfg, available_now=True).awaitTermination()
    return _text_dt(sinks.read_pairs(spark, cfg))


@query(f"""WITH {BUS} SELECT event_id, source, ts_ms, payload, {DAY} AS dt FROM bus
WHERE ts_ms IS NOT NULL AND len(entities) = 0""")
def stream_raw_to_sink(spark, sf_dir):
    cfg = _scratch(spark, "raw")
    envelopes = B.parse_envelopes(B.topic_filter(_bus_stream(spark, sf_dir)))
    K.start_raw(envelopes, cfg, available_now=True).awaitTermination()
    return _text_dt(sinks.read_raw(spark, cfg).drop("entities"))


@query(f"""WITH {BUS}, live AS (SELECT *, ts_ms < 1705276800000 AS early FROM bus
 WHERE topic NOT LIKE '%.dlq' AND ts_ms IS NOT NULL),
last AS (SELECT max(ts_ms) - 600000 AS mark FROM live)
SELECT side, count(*) * copies AS n, count(DISTINCT event_id) AS events FROM live, last,
 (VALUES ('a', 1), ('b', 3)) AS v(side, copies) WHERE len(entities) > 0 AND ts_ms > mark - 600000 GROUP BY side, copies""")
def stream_state_rows(spark, sf_dir):
    """What the pair join still holds after a stop, a restart and all rows: those within the watermark
    and the window, once on its left side and in three time bins on its right."""
    cfg = _scratch(spark, "state")
    events = W.table(spark, sf_dir, "events")
    early = c("ts").cast("timestamp") < "2024-01-15"
    for rows in (events.filter(early), events.filter(~early)):
        rows.write.mode("append").parquet(cfg.sinks.place("land"))
        stream = spark.readStream.schema(events.schema).parquet(cfg.sinks.place("land"))
        envelopes = B.parse_envelopes(B.topic_filter(W.bus_rows(stream)), position=True)
        K.start_pairs(stream_pairs(envelopes), cfg, available_now=True).awaitTermination()
    held = state_rows(spark, f"{cfg.sinks.checkpoint_root}/{K.PAIRS_QUERY}")
    return held.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("events"))


# Every 97th event is broken and never reaches the sinks.
_SINK_TOTALS = f"""WITH {PAIRS.replace('FROM env)', 'FROM env WHERE n % 97 != 0)')}
SELECT 'correlated' AS sink, count(*) AS n, max(ts_ms) AS last_ts_ms FROM pairs
UNION ALL SELECT 'events_raw', count(*), max(ts_ms) FROM env
WHERE n % 97 != 0 AND len(entities) = 0"""


@query(_SINK_TOTALS)
def backfill(spark, sf_dir):
    cfg = _scratch(spark, "backfill")
    jobs.backfill(W.bus(spark, sf_dir), cfg)
    return S.sink_totals(sinks.read_pairs(spark, cfg), sinks.read_raw(spark, cfg))


def _odd_bus(spark, sf_dir):
    """The bus with times that no timestamp holds, times far ahead, and rows that are no JSON."""
    rows = W.bus(spark, sf_dir)
    ts = F.get_json_object(F.col("value").cast("string"), "$.ts_ms")
    n = F.col("offset") * 6 + F.col("partition")
    text = F.col("value").cast("string")

    def at(time: str) -> Column:
        return F.replace(text, F.concat(F.lit('"ts_ms":'), ts), F.lit(f'"ts_ms":{time}'))

    odd = (F.when(n % 11 == 0, at("9000000000000000000")).when(n % 13 == 0, at("-9000000000000000000"))
           .when(n % 17 == 0, at("253402300799000")).when(n % 19 == 0, F.lit("no json")).otherwise(text))
    return rows.withColumn("value", odd.cast("binary"))


_ODD = f"""{BUS}, odd AS (SELECT *, n % 11 = 0 OR n % 13 = 0 AS beyond, n % 17 = 0 AS ahead,
n % 11 != 0 AND n % 13 != 0 AND n % 17 != 0 AND n % 19 = 0 AS broken FROM bus
WHERE topic NOT LIKE '%.dlq')"""


@query(f"""WITH {_ODD} SELECT 'quarantined' AS kind, count(*) AS n, count(DISTINCT n) AS texts FROM odd
WHERE beyond OR ahead OR broken
UNION ALL SELECT 'stored', count(*), count(DISTINCT n) FROM odd
WHERE NOT (beyond OR ahead OR broken) AND len(entities) = 0""")
def backfill_accounts_for_all(spark, sf_dir):
    """Run twice: the second run has to leave the sinks as they are."""
    cfg = _scratch(spark, "accounts")
    for _ in range(2):
        jobs.backfill(_odd_bus(spark, sf_dir), cfg)
    held = sinks.read_quarantine(spark, cfg).select(F.lit("quarantined").alias("kind"), F.concat_ws(
        ":", "topic", c("partition").cast("string"), c("offset").cast("string")).alias("id"))
    stored = sinks.read_raw(spark, cfg).select(F.lit("stored").alias("kind"), c("event_id").alias("id"))
    return held.union(stored).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("texts"))


@query(_SINK_TOTALS)
def backfill_of_a_shortened_bus(spark, sf_dir):
    """Run again once the bus has dropped its older half: the sinks keep what they hold."""
    cfg = _scratch(spark, "shortened")
    for rows in (W.bus(spark, sf_dir), W.bus(spark, sf_dir).filter("timestamp >= '2024-01-15 12:00:00'")):
        jobs.backfill(rows, cfg)
    return S.sink_totals(sinks.read_pairs(spark, cfg), sinks.read_raw(spark, cfg))


# ---- all sinks from one read --------------------------------------------------------

def _slices(spark, sf_dir) -> list[DataFrame]:
    """The events as three batches by time, but every seventh comes with the last; a third of all is
    about one entity."""
    ts = c("ts").cast("timestamp")
    third = (F.when(ts < "2024-01-11", 0).when(ts < "2024-01-21", 1).otherwise(2))
    events = W.table(spark, sf_dir, "events").withColumn(
        "user_id", F.when(c("event_id") % 3 == 0, 0).otherwise(c("user_id")).cast("bigint"))
    batch = F.when(c("event_id") % 7 == 0, 2).otherwise(third)
    return [events.filter(batch == b) for b in range(3)]


_FANOUT = f"""WITH {BUS.replace("'U' || user_id", "'U' || CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END")},
arrived AS (SELECT *, (CASE WHEN n % 7 = 0 THEN 2 WHEN "timestamp" < TIMESTAMP '2024-01-11' THEN 0
 WHEN "timestamp" < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END)::BIGINT AS batch
 FROM bus WHERE topic LIKE 'events.%' AND topic NOT LIKE '%.dlq'),
marks AS (SELECT b.batch, max(a.ts_ms) - 600000 AS watermark_ms FROM (SELECT unnest([0, 1, 2])::BIGINT AS batch) b
 LEFT JOIN arrived a ON a.batch < b.batch - 1 GROUP BY b.batch),
judged AS (SELECT a.*, m.watermark_ms, len(entities) > 0 AND coalesce(ts_ms <= m.watermark_ms, false) AS late
 FROM arrived a JOIN marks m USING (batch)),
fresh AS (SELECT * FROM judged WHERE NOT late),
ent AS (SELECT event_id, source, ts_ms, unnest(entities) AS entity FROM fresh),
pairs AS (SELECT l.entity, l.event_id AS a_id, r.event_id AS b_id, greatest(l.ts_ms, r.ts_ms) AS ts_ms
 FROM ent l JOIN ent r ON l.entity = r.entity AND l.source < r.source AND abs(l.ts_ms - r.ts_ms) <= 600000)"""


@query(f"{_FANOUT} SELECT entity, a_id, b_id, ts_ms, {DAY} AS dt FROM pairs")
def fanout_pairs(spark, sf_dir):
    """A stream that stops after each of three batches; a third of the events is about an entity that nobody has named."""
    cfg = _scratch(spark, "fanout")
    for rows in _slices(spark, sf_dir):
        rows.write.mode("append").parquet(cfg.sinks.place("land"))
        stream = spark.readStream.schema(rows.schema).parquet(cfg.sinks.place("land"))
        jobs.fan_out(spark, W.bus_rows(stream), cfg, available_now=True).awaitTermination()
    return _text_dt(sinks.read_pairs(spark, cfg))


def _fanned(spark, sf_dir, label: str, again: tuple[int, ...] = ()) -> Settings:
    """The three batches, some of them a second time."""
    cfg = _scratch(spark, label)
    for batch, rows in enumerate(_slices(spark, sf_dir)):
        for _ in range(1 + again.count(batch)):
            write_fanout(W.bus_rows(rows), batch, cfg, jobs.AHEAD_MS)
    return cfg


@query(f"""{_FANOUT} SELECT event_id, source, array_to_string(entities, ' ') AS entities, ts_ms,
watermark_ms - ts_ms AS late_ms, batch, {DAY} AS dt FROM judged WHERE late""")
def fanout_late(spark, sf_dir):
    cfg = _fanned(spark, sf_dir, "late")
    return _text_dt(sinks.read_late(spark, cfg).drop("payload").withColumn("entities", _joined("entities")))


@query(f"""{_FANOUT} SELECT batch, count(*) AS n, count(*) FILTER (ts_ms IS NULL) AS unusable,
count(*) FILTER (len(entities) = 0) AS raw, count(*) FILTER (late) AS late,
count(*) FILTER (len(entities) > 0 AND NOT late) AS entity_rows, max(ts_ms) AS max_ms,
any_value(watermark_ms) AS watermark_ms FROM judged GROUP BY batch""")
def fanout_batches(spark, sf_dir):
    """Every row of the bus is counted once: unusable, raw, to be paired, or late."""
    return sinks.read_batches(spark, _fanned(spark, sf_dir, "batches"))


@query(f"""{_FANOUT} SELECT 'pairs' AS sink, count(*) AS n, count(DISTINCT a_id || b_id) AS different FROM pairs
UNION ALL SELECT 'raw', count(*), count(DISTINCT event_id) FROM judged WHERE len(entities) = 0
UNION ALL SELECT 'late', count(*), count(DISTINCT event_id) FROM judged WHERE late""")
def fanout_repeated(spark, sf_dir):
    """Batches that ran again, as after a lost driver, leave the same rows."""
    cfg = _fanned(spark, sf_dir, "repeated", again=(1, 2, 2))
    frames = {"pairs": sinks.read_pairs(spark, cfg).select(F.concat("a_id", "b_id").alias("id")),
              "raw": sinks.read_raw(spark, cfg).select(c("event_id").alias("id")),
              "late": sinks.read_late(spark, cfg).select(c("event_id").alias("id"))}
    return reduce(DataFrame.union, (
        df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("different"))
        .select(F.lit(name).alias("sink"), "n", "different") for name, df in frames.items()))


@query(f"""WITH {_ODD} SELECT CASE WHEN beyond OR broken THEN '-' WHEN ahead THEN '12-31'
ELSE strftime(make_timestamp(ts_ms * 1000), '%m-%d') END AS group_key, count(*) AS n
FROM odd GROUP BY group_key""")
def group_odd_times_by_day(spark, sf_dir):
    feed = B.decode_feed(B.topic_filter(_odd_bus(spark, sf_dir)))
    return views.group_view(feed, views.stream_view(), "day")


@query(f"""WITH {_ODD} SELECT source, max(CASE WHEN ahead AND NOT beyond THEN 253402300799000
WHEN NOT beyond AND NOT broken THEN ts_ms END) AS cursor_ms FROM odd GROUP BY source""")
def advance_cursors_past_odd_times(spark, sf_dir):
    none = spark.createDataFrame([], sinks.CURSOR_SCHEMA)
    v = F.try_parse_json(c("value").cast("string"))
    rows = B.topic_filter(_odd_bus(spark, sf_dir)).select(
        F.split_part("topic", F.lit("."), F.lit(2)).alias("source"),
        F.try_variant_get(v, "$.ts_ms", "bigint").alias("ts_ms"))
    return S.advance_cursors(none, rows)


# How many bytes a sink takes is the writer's affair, so only their presence is compared.
@query(_SINK_TOTALS.replace("AS last_ts_ms FROM", "AS last_ts_ms, 'yes' AS has_bytes FROM")
       .replace("max(ts_ms) FROM env", "max(ts_ms), 'yes' FROM env"))
def sink_overview(spark, sf_dir):
    cfg = _scratch(spark, "overview")
    jobs.backfill(W.bus(spark, sf_dir), cfg)
    found, raw = sinks.read_pairs(spark, cfg), sinks.read_raw(spark, cfg)
    rows = S.sink_overview(found, raw, sinks.sink_bytes(spark, cfg))
    return rows.select("sink", "n", "last_ts_ms",
                       F.when((c("bytes") > 0) & (c("share") < 1), "yes").alias("has_bytes"))


@query("""SELECT 'raw' AS query, count(DISTINCT event_type) - 1 AS planned,
count(DISTINCT event_type) - 1 AS committed, 'no' AS running FROM events""")
def query_progress(spark, sf_dir):
    """The events land as a file for each type and are taken one file at a time."""
    cfg, events = _scratch(spark, "progress"), W.table(spark, sf_dir, "events")
    events.repartition("event_type").write.partitionBy("event_type").parquet(cfg.sinks.place("land"))
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
              .parquet(cfg.sinks.place("land")))
    envelopes = B.parse_envelopes(W.bus_rows(stream.select(*events.columns)))
    K.start_raw(envelopes, cfg, available_now=True).awaitTermination()
    return sinks.query_progress(spark, cfg.sinks.checkpoint_root, 0).select(
        "query", "planned", "committed", F.when(c("running"), "yes").otherwise("no").alias("running"))


def _feed(spark, sf_dir):
    return B.decode_feed(W.bus(spark, sf_dir))


_INDEX = """SELECT p.entity, p.a_id, p.b_id, p.ts_ms, coalesce(a.summary, p.a_id) AS a,
coalesce(b.summary, p.b_id) AS b, abs(a.ts_ms - b.ts_ms) AS gap_ms
FROM pairs p LEFT JOIN known a ON a.event_id = p.a_id LEFT JOIN known b ON b.event_id = p.b_id"""
_RESOLVED = f"""WITH {PAIRS}, {FEED.strip()},
known AS (SELECT * FROM feed WHERE topic NOT LIKE '%.dlq')"""


def _resolved(spark, sf_dir):
    events = _feed(spark, sf_dir).filter(~B.is_dead_letter()).select(
        *L.ARRIVAL, "event_id", "ts_ms", "summary")
    return views.resolve_pairs(C.pairs(W.envelopes(spark, sf_dir)), L.last_by_id(events))


@query(f"{_RESOLVED} {_INDEX}")
def resolve_pairs(spark, sf_dir):
    return _resolved(spark, sf_dir).drop("dt")


# ---- status -------------------------------------------------------------------------

@query(f"WITH {BUS} SELECT topic, count(*) AS n FROM bus GROUP BY topic")
def topic_counts(spark, sf_dir):
    return S.topic_counts(W.bus(spark, sf_dir))


_NOW = 1_705_190_400  # 2024-01-14


@query(f"""WITH s AS (SELECT unnest(range({_NOW} - 3600, {_NOW})) AS second),
n AS (SELECT (epoch_us(ts) // 1000) // 1000 AS second, count(*) AS n FROM events GROUP BY 1)
SELECT s.second, coalesce(n.n, 0) AS n FROM s LEFT JOIN n USING (second)""")
def rate(spark, sf_dir):
    return S.rate(W.bus(spark, sf_dir), _NOW, 3600)


@query(f"""SELECT (count(*) FILTER ((epoch_us(ts) // 1000) // 1000 BETWEEN {_NOW} - 1000 AND {_NOW} - 1)
* 1000 / 1000)::BIGINT AS milli_per_second FROM events""")
def mean_rate(spark, sf_dir):
    rates = S.rate(W.bus(spark, sf_dir), _NOW, 3600)
    per_second = S.mean_rate(rates, _NOW, 1000)
    return per_second.select(
        F.round(c("per_second") * 1000).cast("bigint").alias("milli_per_second"))


_DEPTH = f"""WITH {BUS}, parts AS (SELECT topic, "partition",
max("offset") + 1 - min("offset") AS depth FROM bus GROUP BY ALL),
depths AS (SELECT topic, sum(depth)::BIGINT AS depth FROM parts GROUP BY topic),
registry AS (SELECT unnest(['click', 'error', 'ghost', 'purchase', 'signup', 'view']) AS name)"""


@query(f"{_DEPTH} SELECT topic, depth FROM depths")
def topic_depths(spark, sf_dir):
    return S.topic_depths(W.bus(spark, sf_dir))


@query(f"""{_DEPTH} SELECT 'events.' || name || '.dlq' AS topic, coalesce(depth, 0) AS depth
FROM registry LEFT JOIN depths ON topic = 'events.' || name || '.dlq'""")
def dlq_depths(spark, sf_dir):
    return S.dlq_depths(W.registry().frame(spark), W.bus(spark, sf_dir))


_NOW_MS = 1_705_600_000_000
_STATUS = f"""WITH {ENV}, {_CURSORS}, {BUS.strip()},
registry AS (SELECT unnest(['click', 'error', 'ghost', 'purchase', 'signup', 'view']) AS name),
status AS (SELECT name, 'events.' || name AS topic,
CASE WHEN name < 'm' THEN '60s' ELSE '5m' END AS interval,
CASE WHEN name < 'm' THEN 60 ELSE 300 END::BIGINT AS interval_s,
(SELECT count(*) FROM bus WHERE topic = 'events.' || name) AS n,
(SELECT count(*) FROM bus WHERE topic = 'events.' || name || '.dlq') AS dlq, cursor_ms,
CASE WHEN cursor_ms IS NULL THEN 'never' WHEN {_NOW_MS} - cursor_ms > 86400000 THEN 'stale'
ELSE 'ok' END AS state FROM registry LEFT JOIN cursors ON source = name)"""


def _source_status(spark, sf_dir):
    return S.source_status(W.registry().frame(spark), _cursors(spark, sf_dir),
                           W.bus(spark, sf_dir), _NOW_MS)


@query(f"{_STATUS} SELECT * FROM status")
def source_status(spark, sf_dir):
    return _source_status(spark, sf_dir)


@query(f"{_STATUS} SELECT name, n, round(n * 10000 / sum(n) OVER ())::BIGINT AS parts "
       "FROM status")
def source_share(spark, sf_dir):
    return S.with_share(_source_status(spark, sf_dir), "n").select(
        "name", "n", F.round(c("share") * 10000).cast("bigint").alias("parts"))


@query(f"""WITH {ENV}, {_CURSORS}, allc AS (SELECT source, cursor_ms FROM cursors
UNION ALL SELECT source, ts_ms FROM env)
SELECT source, max(cursor_ms) AS cursor_ms FROM allc GROUP BY source""")
def advance_cursors(spark, sf_dir):
    return S.advance_cursors(_cursors(spark, sf_dir), W.envelopes(spark, sf_dir))


@query(f"""WITH {PAIRS}, raw AS (SELECT * FROM env WHERE len(entities) = 0)
SELECT (SELECT count(*) FROM pairs) AS n_pairs, (SELECT count(*) FROM raw) AS n_raw,
(SELECT max(ts_ms) FROM pairs) AS last_pair_ms, (SELECT max(ts_ms) FROM raw) AS last_raw_ms""")
def sink_signature(spark, sf_dir):
    rows = W.envelopes(spark, sf_dir)
    return S.sink_signature(C.pairs(rows), K.raw_rows(rows))


# ---- newest first -------------------------------------------------------------------

@query(f"""WITH {ENV} SELECT event_id, source, ts_ms, {DAY} AS dt FROM env
WHERE len(entities) = 0 ORDER BY ts_ms DESC, event_id LIMIT 10""")
def latest_raw(spark, sf_dir):
    raw = K.raw_rows(W.envelopes(spark, sf_dir))
    return _text_dt(L.latest_raw(raw).select("event_id", "source", "ts_ms", "dt"))


@query(f"""WITH {ENV} SELECT event_id, source, ts_ms, payload, {DAY} AS dt, payload AS summary
FROM env WHERE len(entities) = 0 ORDER BY ts_ms DESC, event_id LIMIT 2000""")
def store_view_raw(spark, sf_dir):
    return L.store_view(K.raw_rows(W.envelopes(spark, sf_dir)))


@query(f"""WITH {PAIRS} SELECT entity, a_id, b_id, ts_ms, {DAY} AS dt FROM pairs
ORDER BY ts_ms DESC, entity, a_id, b_id LIMIT 2000""")
def store_view_pairs(spark, sf_dir):
    return L.store_view(C.pairs(W.envelopes(spark, sf_dir)))


@query(f"""WITH {FEED}, keyed AS (SELECT *, row_number() OVER (PARTITION BY entities[1]
ORDER BY "timestamp" DESC, topic DESC, "partition" DESC, "offset" DESC) AS r FROM feed
WHERE len(entities) > 0) SELECT entities[1] AS event_id, topic, "offset", ts_ms, summary
FROM keyed WHERE r = 1""")
def last_by_id(spark, sf_dir):
    # Keyed by user, so that an id occurs many times.
    by_user = _feed(spark, sf_dir).select(
        *L.ARRIVAL, F.try_element_at("entities", F.lit(1)).alias("event_id"), "ts_ms", "summary")
    return L.last_by_id(by_user).select("event_id", "topic", "offset", "ts_ms", "summary")


@query(f"""WITH {BUS}, live AS (SELECT CASE WHEN n % 4 = 0 THEN 'U' || (n % 40) ELSE event_id END AS event_id,
 topic, "partition", "offset", "timestamp", ts_ms FROM bus WHERE topic NOT LIKE '%.dlq'),
keyed AS (SELECT *, row_number() OVER (PARTITION BY event_id
ORDER BY "timestamp" DESC, topic DESC, "partition" DESC, "offset" DESC) AS r FROM live)
SELECT event_id, topic, "offset", ts_ms FROM keyed WHERE r = 1""")
def index_after_batches(spark, sf_dir):
    """The index of last rows after five batches with two rebuilt bases; a quarter of the rows repeat ids."""
    cfg = _scratch(spark, "index")
    n = c("offset") * 6 + c("partition")
    own = F.concat(F.lit('"event_id":"U'), (n % 40).cast("string"), F.lit('"'))
    value = F.when(n % 4 == 0, F.regexp_replace(c("value").cast("string"), F.lit('"event_id":"[^"]*"'), own)).otherwise(
        c("value").cast("string"))
    bus = W.bus(spark, sf_dir).withColumn("value", value.cast("binary"))
    for batch in range(5):
        update_index(bus.filter(c("offset") % 5 == batch), batch, cfg, every=2)
    return read_index(spark, cfg).select("event_id", "topic", "offset", "ts_ms")


_ARRIVAL = '"timestamp" DESC, topic DESC, "partition" DESC, "offset" DESC'


@query(f"""WITH {FEED} SELECT topic, "offset", event_id, ts_ms FROM feed
WHERE topic NOT LIKE '%.dlq' ORDER BY {_ARRIVAL} LIMIT 5000""")
def ring_events(spark, sf_dir):
    return L.ring(_feed(spark, sf_dir))[0].select("topic", "offset", "event_id", "ts_ms")


@query(f"""WITH {FEED} SELECT topic, "offset", event_id, error FROM feed
WHERE topic LIKE '%.dlq' ORDER BY {_ARRIVAL} LIMIT 500""")
def ring_dead_letters(spark, sf_dir):
    return L.ring(_feed(spark, sf_dir))[1].select("topic", "offset", "event_id", "error")


@query(f"""WITH {FEED} SELECT topic, "offset" FROM feed
WHERE "timestamp" > TIMESTAMP '2024-01-20 12:00:00'""")
def since(spark, sf_dir):
    after = {"timestamp": "2024-01-20 12:00:00", "topic": "events.zz", "partition": 0, "offset": 0}
    at = {**after, "timestamp": spark.sql("SELECT TIMESTAMP '2024-01-20 12:00:00' AS t").first().t}
    return L.since(_feed(spark, sf_dir), at).select("topic", "offset")


@query(f"""WITH {FEED}, tail AS (SELECT *, max("offset") OVER (PARTITION BY topic, "partition")
AS last FROM feed WHERE topic LIKE '%.dlq'), ranked AS (SELECT *, row_number() OVER
(PARTITION BY topic ORDER BY "offset" DESC, "partition" DESC) AS r FROM tail
WHERE "offset" > last - 5)
SELECT topic, "offset", error, n FROM ranked WHERE r <= 5""")
def peek(spark, sf_dir):
    topics = [s.dlq_topic for s in W.registry()]
    tail = L.peek(W.bus(spark, sf_dir), topics)
    number = F.split_part(F.get_json_object("value", "$.event_id"), F.lit(":"), F.lit(2))
    return tail.select("topic", "offset", "error", number.cast("bigint").alias("n"))


@query(f"""WITH {ENV} SELECT event_id, source, ts_ms, {DAY} AS dt FROM env
WHERE len(entities) = 0 ORDER BY ts_ms DESC, event_id LIMIT 300""")
def newest_raw_days(spark, sf_dir):
    """The newest rows of a sink, from as many of its newest days as hold them."""
    cfg = _scratch(spark, "newest")
    K.write_batch(K.raw_rows(W.envelopes(spark, sf_dir)), cfg.sinks.raw, ["dt", "source"])
    newest = sinks.newest_days(spark, cfg.sinks.raw, sinks.RAW_SCHEMA, 300)
    return _text_dt(L.latest_raw(newest, 300).select("event_id", "source", "ts_ms", "dt"))


@query(f"""WITH {PAIRS} SELECT entity, a_id, b_id, ts_ms, {DAY} AS dt FROM pairs
ORDER BY ts_ms DESC, entity, a_id, b_id LIMIT 10""")
def newest_pair_days(spark, sf_dir):
    cfg = _scratch(spark, "newest")
    K.write_batch(C.pairs(W.envelopes(spark, sf_dir)), cfg.sinks.pairs, ["dt"])
    return _text_dt(L.latest_pairs(sinks.newest_days(spark, cfg.sinks.pairs, sinks.PAIRS_SCHEMA, 10)))


@query(_SINK_TOTALS)
def totals_from_footers(spark, sf_dir):
    """Rows and latest times of the sinks without a data page read; the tests look at the plan."""
    cfg = _scratch(spark, "totals")
    jobs.backfill(W.bus(spark, sf_dir), cfg)
    return sinks.totals(spark, cfg).select("sink", "n", "last_ts_ms")


_PEEK = ORACLES["peek"]


@query(_PEEK)
def peek_of_ranges(spark, sf_dir):
    """The same from bounded ranges: the last records of each partition and no others are looked at."""
    bus, topics = W.bus(spark, sf_dir), [s.dlq_topic for s in W.registry()]
    ranges = B.tail_ranges(S.ends_of(bus.filter(c("topic").isin(topics))), 5)
    tail = L.peek(B.within(bus, ranges), topics)
    number = F.split_part(F.get_json_object("value", "$.event_id"), F.lit(":"), F.lit(2))
    return tail.select("topic", "offset", "error", number.cast("bigint").alias("n"))


@query(f"""WITH {BUS} SELECT 'events.' || k || '.dlq' AS topic,
(SELECT coalesce(sum(d), 0)::BIGINT FROM (SELECT max("offset") + 1 - min("offset") AS d FROM bus
 WHERE topic = 'events.' || k || '.dlq' GROUP BY "partition")) AS depth
FROM (SELECT unnest(['view', 'nowhere']) AS k)""")
def depths_of_named_topics(spark, sf_dir):
    """Also of a topic that no source is configured for, as ``dlq TOPIC`` shows it."""
    names = spark.createDataFrame([("events.view.dlq",), ("events.nowhere.dlq",)], "topic string")
    return S.named_depths(names, W.bus(spark, sf_dir))


def _over_views(spark: SparkSession, cfg: Settings, statement: str) -> DataFrame:
    """A statement over the sinks' views, which are gone again once it is resolved."""
    sinks.register_views(spark, cfg)
    df = spark.sql(statement)
    for view in (sinks.RAW_TABLE, sinks.PAIRS_TABLE):
        spark.catalog.dropTempView(view)
    return df


@query(f"""WITH {ENV} SELECT event_id, source, ts_ms FROM env
WHERE len(entities) = 0 AND source = 'view'""")
def sql_by_source(spark, sf_dir):
    cfg = _scratch(spark, "sql")
    K.write_batch(K.raw_rows(W.envelopes(spark, sf_dir)), cfg.sinks.raw, ["dt", "source"])
    return _over_views(spark, cfg, "SELECT event_id, source, ts_ms FROM events_raw "
                       "WHERE source = 'view'")


@query(f"""WITH {PAIRS} SELECT entity, a_id, b_id, ts_ms FROM pairs
WHERE a_id LIKE '%click%' ORDER BY {DAY} DESC""")
def sql_pairs_by_id(spark, sf_dir):
    cfg = _scratch(spark, "sql")
    K.write_batch(C.pairs(W.envelopes(spark, sf_dir)), cfg.sinks.pairs, ["dt"])
    return _over_views(spark, cfg, "SELECT entity, a_id, b_id, ts_ms FROM correlated "
                       "WHERE a_id LIKE '%click%' "
                       "ORDER BY dt DESC, ts_ms DESC, entity, a_id, b_id")


def _over_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``jobs.query`` over catalog tables of freshly written sinks, in a database of this call's own."""
    cfg = _scratch(spark, "tables")
    cfg = replace(cfg, tables=replace(cfg.tables, database=f"eventlens_{uuid.uuid4().hex}"))
    out = []
    try:
        jobs.backfill(W.bus(spark, sf_dir), cfg)
        repair.bootstrap_tables(spark, cfg)
        for name, newest in ((sinks.RAW_TABLE, L.latest_raw), (sinks.PAIRS_TABLE, L.latest_pairs)):
            path = cfg.sinks.place(f"newest_{name}")
            newest(spark.table(repair.table_name(cfg, name))).write.parquet(path)
            out.append(spark.read.parquet(path))
    finally:  # external tables: their files stay
        spark.sql(f"DROP DATABASE IF EXISTS {cfg.tables.database} CASCADE")
    return out[0], out[1]


@query(f"""WITH {BUS} SELECT event_id, source, ts_ms, {DAY} AS dt FROM bus
WHERE ts_ms IS NOT NULL AND len(entities) = 0 ORDER BY ts_ms DESC, event_id LIMIT 10""")
def tables_latest_raw(spark, sf_dir):
    return _over_tables(spark, sf_dir)[0].select("event_id", "source", "ts_ms", "dt")


@query(f"""WITH {PAIRS.replace('FROM env)', 'FROM env WHERE n % 97 != 0)')}
SELECT entity, a_id, b_id, ts_ms, {DAY} AS dt FROM pairs ORDER BY ts_ms DESC, entity, a_id, b_id LIMIT 10""")
def tables_latest_pairs(spark, sf_dir):
    return _over_tables(spark, sf_dir)[1].select("entity", "a_id", "b_id", "ts_ms", "dt")


# ---- views --------------------------------------------------------------------------

@query(f"""WITH {FEED}, odd AS (SELECT topic, "offset", n, CASE WHEN n % 89 = 0 THEN NULL
ELSE event_id END AS event_id, source, CASE WHEN n % 89 = 0 THEN '' ELSE
array_to_string(entities, ' ') END AS entities, CASE WHEN n % 89 = 0 THEN NULL ELSE ts_ms END
AS ts_ms, CASE WHEN n % 89 = 0 THEN '{{"raw": "not json"}}' ELSE summary END AS summary, error
FROM feed) SELECT topic, "offset", event_id, source, entities, ts_ms, summary, error FROM odd""")
def decode_feed(spark, sf_dir):
    broken = (c("offset") * 6 + c("partition")) % 89 == 0
    bus = W.bus(spark, sf_dir).withColumn(
        "value", F.when(broken, F.lit("not json").cast("binary")).otherwise(c("value")))
    return B.decode_feed(bus).select("topic", "offset", "event_id", "source", _joined("entities"),
                                     "ts_ms", "summary", "error")


def _live(spark, sf_dir):
    return _feed(spark, sf_dir).filter(~B.is_dead_letter())


_STREAM = f"""WITH {FEED}, live AS (SELECT *, {SHORT} AS t, array_to_string(entities, ' ') AS e,
topic || '@' || "offset" AS place FROM feed WHERE topic NOT LIKE '%.dlq')"""


@query(f"""{_STREAM} SELECT event_id FROM live WHERE source LIKE '%click%' AND e LIKE '%u1%' = false
AND e NOT LIKE '%U1%' AND lower(t || ' ' || source || ' ' || e || ' ' || summary || ' ' || place)
LIKE '%01-1%' AND substr(t, 1, 5) LIKE '%01-%'""")
def where_text(spark, sf_dir):
    return views.where_text(
        _live(spark, sf_dir), "source:CLICK -entities:u1 01-1 day:01-", views.stream_view()
    ).select("event_id")


@query(f"""{_STREAM} SELECT event_id FROM live WHERE lower(place) LIKE '%view@1%'
AND lower(t || ' ' || source || ' ' || e || ' ' || summary || ' ' || place) NOT LIKE '%9%'""")
def where_text_by_label(spark, sf_dir):
    return views.where_text(
        _live(spark, sf_dir), "topic@off:view@1 -9", views.stream_view()).select("event_id")


@query(f"""WITH {ENV}, stored AS (SELECT event_id, source, ts_ms, {SHORT} AS t, {DAY} AS dt FROM env
WHERE len(entities) = 0) SELECT event_id, source, ts_ms FROM stored
WHERE source LIKE '%ic%' AND t LIKE '%01-1%' AND dt LIKE '%2024%' AND t NOT LIKE '%01-12%'""")
def where_text_of_a_sink(spark, sf_dir):
    """Source, day and date choose folders of the sink; the tests look at the plan."""
    cfg = _scratch(spark, "filtered")
    K.write_batch(K.raw_rows(W.envelopes(spark, sf_dir)), cfg.sinks.raw, ["dt", "source"])
    return views.where_text(L.stored(sinks.read_raw(spark, cfg)), "source:IC time:01-1 dt:2024 -time:01-12",
                            views.stored_view()).select("event_id", "source", "ts_ms")


@query(f"{_STREAM} SELECT event_id, source, ts_ms FROM live ORDER BY ts_ms DESC NULLS FIRST")
def order_view(spark, sf_dir):
    shown = views.order_view(_live(spark, sf_dir), views.stream_view())
    return shown.select("event_id", "source", "ts_ms")


def _group(view, key, frame):
    return lambda spark, sf_dir: views.group_view(frame(spark, sf_dir), view(), key)


def _group_query(name: str, fn: Query, sql: str) -> None:
    fn.__name__ = name
    query(sql)(fn)


for _key, _expr in {
    "source": "source",
    "entity": "unnest(CASE WHEN len(entities) > 0 THEN entities ELSE ['(none)'] END)",
    "day": "substr(t, 1, 5)",
    "topic": "topic",
}.items():
    _group_query(
        f"group_stream_by_{_key}", _group(views.stream_view, _key, _live),
        f"{_STREAM}, g AS (SELECT {_expr} AS group_key FROM live) "
        "SELECT group_key, count(*) AS n FROM g GROUP BY group_key")

for _key, _expr in {
    "entity": "entity",
    "pair": "split_part(a_id, ':', 1) || ' × ' || split_part(b_id, ':', 1)",
    "day": DAY,
}.items():
    _group_query(
        f"group_pairs_by_{_key}", _group(views.pairs_view, _key, _resolved),
        f"WITH {PAIRS}, g AS (SELECT {_expr} AS group_key FROM pairs) "
        "SELECT group_key, count(*) AS n FROM g GROUP BY group_key")


def _stored(spark, sf_dir):
    return L.stored(K.raw_rows(W.envelopes(spark, sf_dir)))


for _key, _expr in {"source": "source", "dt": DAY}.items():
    _group_query(
        f"group_stored_by_{_key}", _group(views.stored_view, _key, _stored),
        f"""WITH {ENV}, stored AS (SELECT * FROM env WHERE len(entities) = 0), g AS (SELECT {_expr} AS group_key FROM stored)
SELECT group_key, count(*) AS n FROM g GROUP BY group_key""")


def _dead(spark, sf_dir):
    return _feed(spark, sf_dir).filter(B.is_dead_letter())


for _key, _expr in {"topic": "topic", "error": "split_part(error, ':', 1)"}.items():
    _group_query(
        f"group_dlq_by_{_key}", _group(views.dlq_view, _key, _dead),
        f"""WITH {FEED}, g AS (SELECT {_expr} AS group_key FROM feed WHERE topic LIKE '%.dlq')
SELECT group_key, count(*) AS n FROM g GROUP BY group_key""")


# ---- jobs ---------------------------------------------------------------------------

def _ingest_registry() -> Registry:
    schema = {"type": "object", "required": ["title"],
              "properties": {"title": {"type": "string"}, "k": {"type": "integer"}}}
    return Registry(tuple(
        replace(s, payload_schema=schema) for s in _extractors().sources))


def _ingest(spark, sf_dir):
    bad = F.regexp_replace("payload", r'"k":(\d*7)\b', '"k":"$1"')
    rows = _titled(spark, sf_dir).withColumn("payload", bad)
    return jobs.ingest(rows, _cursors(spark, sf_dir), _ingest_registry())


# Only the four configured sources have a payload contract.
_INGEST = f"""WITH {ENV}, {_CURSORS}, fresh AS (
SELECT e.*, 'U' || user_id AS u, user_id, {_first_seen(_CASHTAGS.format(_TITLE))} AS tags,
 user_id % 10 = 7 AND event_type != 'purchase' AS bad
FROM env e JOIN events v ON v.event_id = e.n LEFT JOIN cursors ON cursors.source = e.source
WHERE cursor_ms IS NULL OR ts_ms > cursor_ms)"""


@query(f"""{_INGEST} SELECT 'events.' || source AS topic, CASE
WHEN source IN ('click', 'error') THEN string_split(tags, ' ')[1]
WHEN source = 'view' THEN 'BUY' ELSE event_id END AS key FROM fresh WHERE NOT bad""")
def ingest_records(spark, sf_dir):
    records = _ingest(spark, sf_dir).records
    return records.select("topic", c("key").cast("string").alias("key"))


@query(f"""{_INGEST} SELECT 'events.' || source || '.dlq' AS topic,
'schema: ''' || user_id || ''' is not of type ''integer''' AS error FROM fresh WHERE bad""")
def ingest_rejects(spark, sf_dir):
    rejects = _ingest(spark, sf_dir).rejects
    return rejects.select("topic", B.header(c("headers"), B.ERROR_HEADER).alias("error"))


@query(f"""{_INGEST}, allc AS (SELECT source, cursor_ms FROM cursors
UNION ALL SELECT source, ts_ms FROM fresh WHERE NOT bad)
SELECT source, max(cursor_ms) AS cursor_ms FROM allc GROUP BY source""")
def ingest_cursors(spark, sf_dir):
    return _ingest(spark, sf_dir).cursors


_AGE = f"{_NOW_MS} - cursor_ms"


@query(f"""{_STATUS} SELECT name,
coalesce(strftime(make_timestamp(cursor_ms * 1000), '%Y-%m-%dT%H:%M:%SZ'), '-') AS cursor,
CASE WHEN cursor_ms IS NULL THEN '-' WHEN {_AGE} < 1000 THEN 'now'
WHEN {_AGE} >= 86400000 THEN ({_AGE}) // 86400000 || 'd'
WHEN {_AGE} >= 3600000 THEN ({_AGE}) // 3600000 || 'h'
WHEN {_AGE} >= 60000 THEN ({_AGE}) // 60000 || 'm' ELSE ({_AGE}) // 1000 || 's' END AS age,
interval, state FROM status""")
def status_report(spark, sf_dir):
    report = jobs.status_report(spark, W.registry(), _cursors(spark, sf_dir),
                                W.bus(spark, sf_dir), _scratch(spark, "status"), _NOW_MS)
    return report["sources"]


@query(f"""{_DEPTH} SELECT 'events.' || name || '.dlq' AS topic, coalesce(depth, 0) AS depth
FROM registry LEFT JOIN depths ON topic = 'events.' || name || '.dlq' WHERE name = 'view'""")
def dlq_report_of_topic(spark, sf_dir):
    return jobs.dlq_report(spark, W.registry(), W.bus(spark, sf_dir), "events.view.dlq")[0]


@query(f"""{_RESOLVED}, newest AS (SELECT * FROM pairs ORDER BY ts_ms DESC, entity, a_id, b_id
LIMIT 2000)
{_INDEX.replace('FROM pairs p', 'FROM newest p')}""")
def overview_correlated(spark, sf_dir):
    cfg = _scratch(spark, "view")
    K.write_batch(C.pairs(W.envelopes(spark, sf_dir)), cfg.sinks.pairs, ["dt"])
    frames = jobs.overview(spark, W.registry(), _cursors(spark, sf_dir), W.bus(spark, sf_dir),
                           cfg, _NOW_MS)
    return frames["correlated"].drop("dt")
