import pytest
from pyspark.sql import functions as F

from eventlens.functions import entities as E
from eventlens.functions import jsontext as J
from eventlens.functions import times as T


@pytest.mark.parametrize(("text", "tags"), [
    ("$aapl and $AAPL and $GOOG", ["AAPL", "GOOG"]),
    ("$TOOLONG $A1 $B", ["B"]),
    ("pre$AAPL, $MSFT.", ["AAPL", "MSFT"]),
    ("$abcé $abc", ["ABC"]),
    ("", []), (None, []),
])
def test_cashtags(value, text, tags):
    assert value(E.cashtags(F.col("t")), t=text) == tags


@pytest.mark.parametrize(("text", "symbols"), [
    ("AAPL", ["AAPL"]), ("brk.b", ["BRK.B"]), ("", []), ("123", []),
    ("aapl\u00a0msft aapl", ["AAPL", "MSFT"]), ("ABCDEFGHIJK", []), (None, []),
])
def test_symbol_tokens(value, text, symbols):
    assert value(E.symbol_tokens(F.col("t")), t=text) == symbols


@pytest.mark.parametrize(("text", "found"), [
    ("AAPL is rising", ["AAPL"]),
    ("Buy $AAPL and $MSFT now", ["AAPL", "MSFT"]),
    ("AAPL $AAPL AAPL", ["AAPL"]),
    ("TOOLONGTICKER 123 !@#", []),
    ("(IBM), 'ge'; the ORCL.", ["IBM", "GE", "ORCL"]),
    (None, []),
])
def test_tickers(value, text, found):
    # "rising" has six letters and "is" is a stop word.
    assert value(E.tickers(F.col("t")), t=text) == found


def test_normalize(spark):
    df = spark.createDataFrame(
        [([" AAPL ", "", "AAPL", "MSFT", None, "\u2003GE\t"],), (None,)], "e array<string>")
    rows = [r.n for r in df.select(E.normalize_entities(F.col("e")).alias("n")).collect()]
    assert rows == [["AAPL", "MSFT", "GE"], []]


@pytest.mark.parametrize(("payload", "fields", "text"), [
    ('{"title":"$AAPL and $MSFT","url":"https://x/$AAPL"}', ["title", "url"],
     "$AAPL and $MSFT https://x/$AAPL"),
    ('{"url":"u","title":"t"}', ["title", "missing", "url"], "t u"),
    ('{"title":null,"n":7}', ["title", "n"], "7"),
    ('["title"]', ["title"], ""), ("junk", ["title"], ""), (None, ["title"], ""),
    ('{"title":"t"}', [], ""),
])
def test_entity_text(value, payload, fields, text):
    assert value(E.entity_text(F.col("p"), fields), p=payload) == text


@pytest.mark.parametrize(("payload", "text"), [
    ('{"symbol":"TSLA","price":250.1,"currency":"USD"}', "TSLA 250.1 USD"),
    ('{"symbol":"TSLA","price":250.0}', "TSLA 250.0"),
    ('{"symbol":"TSLA","title":"Recall"}', "TSLA · Recall"),
    ('{"symbol":"","title":"Recall"}', "Recall"),
    ('{"title":"Show HN"}', "Show HN"),
    ('{"a":1}', '{"a": 1}'),
    ('{"b":[1,"x,y:\\"z"],"a":{"k":null}}', '{"a": {"k": null}, "b": [1, "x,y:\\"z"]}'),
    ('{"a":"é😀"}', '{"a": "\\u00e9\\ud83d\\ude00"}'),
    ("null", ""), (None, ""), ('"text"', "text"), ("not json", "not json"),
])
def test_summary(value, payload, text):
    assert value(J.summary(F.col("p")), p=payload) == text


def test_summary_is_whole_unless_a_display_bounds_it(value):
    long = '{"a":"' + "x,y:" * 200 + '"}'
    assert value(J.summary(F.col("p")), p=long) == '{"a": "' + "x,y:" * 200 + '"}'
    assert value(J.summary(F.col("p"), limit=90), p=long) == ('{"a": "' + "x,y:" * 200)[:90]


@pytest.mark.parametrize(("n", "text"), [
    (0, "0 B"), (1023, "1023 B"), (1024, "1.0 KiB"), (1536, "1.5 KiB"), (1280, "1.2 KiB"),
    (1024 ** 3, "1.0 GiB"), (5 * 1024 ** 5, "5120.0 TiB"),
])
def test_human_bytes(value, n, text):
    assert value(J.human_bytes(F.lit(n)), x="") == text


@pytest.mark.parametrize(("ms", "text"), [
    (0, "now"), (999, "now"), (-5, "now"), (1000, "1s"), (59_999, "59s"), (60_000, "1m"),
    (3_599_999, "59m"), (3_600_000, "1h"), (86_400_000, "1d"), (200_000_000, "2d"),
])
def test_age(value, ms, text):
    assert value(T.age(F.lit(ms)), x="") == text


@pytest.mark.parametrize(("text", "seconds"), [
    ("60s", 60), ("5m", 300), ("1h", 3600), ("5d", None), ("junk", None),
])
def test_interval_seconds(value, text, seconds):
    assert value(T.interval_seconds(F.col("t")), t=text) == seconds


def test_dates_do_not_depend_on_the_session_zone(spark, value):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert str(value(T.event_date(F.lit(-1)), x="")) == "1969-12-31"
        assert str(value(T.event_date(F.lit(1_700_006_399_999)), x="")) == "2023-11-14"
        assert str(value(T.event_date(F.lit(1_700_006_400_000)), x="")) == "2023-11-15"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_isotime(value):
    assert value(T.isotime(F.lit(1_725_199_200_123)), x="") == "2024-09-01T14:00:00Z"
    assert value(T.short_time(F.lit(None).cast("bigint")), x="") == "-"


@pytest.mark.parametrize(("text", "ms"), [
    ("Sun, 01 Sep 2024 14:00:00 GMT", 1_725_199_200_000),
    ("Sun, 01 Sep 2024 14:00:00 +0000", 1_725_199_200_000),
    ("Sun, 1 Sep 2024 09:00:00 EST", 1_725_199_200_000),
    ("01 sep 24 14:00 UT", 1_725_199_200_000),
    ("Sun, 01 Sep 2024 14:00:00", 1_725_199_200_000),
    ("Sun, 01 Sep 2024 16:00:00 +0200", 1_725_199_200_000),
    ("junk", None), ("", None), (None, None), ("Sun, 41 Sep 2024 14:00:00 GMT", None),
])
def test_rfc2822(value, text, ms):
    assert value(T.rfc2822_ms(F.col("t")), t=text) == ms


@pytest.mark.parametrize(("a", "b", "label"), [
    ("hn:1", "rss:x:y", "hn × rss"), ("plain", None, "plain × "),
])
def test_pair_label(value, a, b, label):
    assert value(J.pair_label(F.col("a"), F.col("b")), a=a, b=b) == label


@pytest.mark.parametrize(("error", "group"), [
    ("schema: title missing", "schema"), ("plain", "plain"), (None, "-"), ("", "-"),
])
def test_error_class(value, error, group):
    assert value(J.error_class(F.col("e")), e=error) == group
