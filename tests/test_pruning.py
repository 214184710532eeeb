"""Reads that open no more than they need: newest days, totals from footers, filters that choose folders."""

import re

import pytest
from pyspark.sql import functions as F

from eventlens.operators import filters, latest, views
from eventlens.settings import Settings
from eventlens.sources import sinks
from eventlens.streaming.sinks import write_batch

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01


@pytest.fixture(scope="module")
def cfg(spark, tmp_path_factory):
    """Ten days, five rows a day, the times of a day in pairs of equal ones."""
    cfg = Settings.at(str(tmp_path_factory.mktemp("pruning")))
    rows = [(f"e{d}:{k}", [], T0 + d * DAY + k // 2 * 1000, "{}", ("hn", "rss")[k % 2]) for d in range(10) for k in range(5)]
    raw = spark.createDataFrame(rows, "event_id string, entities array<string>, ts_ms bigint, payload string, source string")
    write_batch(raw.withColumn("dt", F.to_date(F.timestamp_millis("ts_ms"))), cfg.sinks.raw, ["dt", "source"])
    return cfg


def partitions_read(df):
    """The conditions that choose folders."""
    python = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    text = python.explainString(df._jdf.queryExecution(), "formatted")
    return re.search(r"PartitionFilters: \[(.*)\]", text)[1]


@pytest.mark.parametrize(("n", "days"), [(1, 1), (5, 1), (6, 2), (11, 4), (20, 4), (21, 8), (50, 10), (60, 10)])
def test_newest_rows_come_from_the_newest_days(spark, cfg, n, days):
    newest = sinks.newest_days(spark, cfg.sinks.raw, sinks.RAW_SCHEMA, n)
    assert newest.select("dt").distinct().count() == days
    if days < 10:
        assert "dt" in partitions_read(newest)
    got = [r.event_id for r in latest.latest_raw(newest, n).collect()]
    assert got == [r.event_id for r in latest.latest_raw(sinks.read_raw(spark, cfg), n).collect()]
    assert len(got) == min(n, 50)


def test_newest_rows_of_a_sink_never_written(spark, tmp_path):
    assert sinks.newest_days(spark, str(tmp_path / "none"), sinks.RAW_SCHEMA, 5).count() == 0
    assert sinks.partition_values(spark, str(tmp_path / "none"), "dt") == []


def test_totals_read_no_data(spark, cfg):
    rows = {r.sink: (r.n, r.last_ts_ms) for r in sinks.totals(spark, cfg).collect()}
    assert rows == {"events_raw": (50, T0 + 9 * DAY + 2000), "correlated": (0, None)}
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    plan = sinks.read_footers(own, cfg.sinks.raw, sinks.RAW_SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), MAX\(ts_ms\)\]", plan)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
    sizes = {r.sink: r.bytes for r in sinks.sink_bytes(spark, cfg).collect()}
    listed = sinks.file_listing(spark, [cfg.sinks.raw]).agg(F.sum("length")).first()[0]
    assert sizes == {"events_raw": listed, "correlated": 0}


@pytest.mark.parametrize(("query", "part"), [
    ("source:hn", "source"), ("dt:2024-01-0", "dt"), ("time:01-03", "dt"), ("time:1-03 source:hn", "dt"), ("-dt:01-05", "dt"),
])
def test_filters_choose_folders(spark, cfg, query, part):
    stored = latest.stored(sinks.read_raw(spark, cfg))
    found = views.where_text(stored, query, views.stored_view())
    assert part in partitions_read(found)
    plain = stored.collect()
    shown = {r.event_id: (r.source, r.dt, r.dt[5:]) for r in plain}
    term = query.split()[0].lstrip("-").split(":")
    wanted = {i for i, (source, dt, day) in shown.items()
              if (term[1] in {"source": source, "dt": dt, "time": day}[term[0]]) != query.startswith("-")
              and ("source:hn" not in query or source == "hn")}
    assert {r.event_id for r in found.collect()} == wanted != set()


@pytest.mark.parametrize("query", ["time:00:00:01", "time:-", "time:01", "01-03", "-time:01-03", "time:3 00:00", "time:01-03 00:00:0"])
def test_conclusions_lose_no_row(spark, cfg, query):
    """The same rows as without a date to conclude on."""
    stored = latest.stored(sinks.read_raw(spark, cfg)).union(
        spark.sql("SELECT 'no time', 'hn', NULL, '{}', NULL, 's'"))
    view = views.stored_view()
    plain = stored.filter(filters.compiled(filters.parse(query), view.text_of))
    assert sorted(r.event_id for r in views.where_text(stored, query, view).collect()) == sorted(
        r.event_id for r in plain.collect())


def test_terms():
    H, T = filters.Holds, filters.Turned
    assert filters.parse("a:b -c:d:e - -x :y  Z:") == (
        H("a", "b"), T(H("c", "d:e")), H(None, "-"), T(H(None, "x")), H(None, ":y"), H("z", ""))
