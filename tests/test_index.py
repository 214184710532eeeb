"""The index of last rows after batches, against the last rows of all of them at once."""

import json

import pytest

from eventlens.operators import latest
from eventlens.settings import Settings
from eventlens.sources import bus as B
from eventlens.streaming.index import read_index, rebase, start_index, update_index

COLUMNS = ("event_id", "timestamp", "topic", "partition", "offset", "ts_ms", "summary")


@pytest.fixture
def cfg(tmp_path):
    return Settings.at(str(tmp_path / "sinks"))


@pytest.fixture
def batches(bus):
    """Seven batches; every id comes in several of them, and one in all."""
    def row(b, k, event_id):
        value = json.dumps({"event_id": event_id, "source": "hn", "entities": [], "ts_ms": b, "payload": {"title": f"{b}.{k}"}})
        return "events.hn", k % 2, 10 * b + k, value, None, 1000 * b + k
    return [bus(*[row(b, k, "always" if k == 0 else f"e{(b * 3 + k) % 8}") for k in range(5)]) for b in range(7)]


def shown(df):
    return sorted(map(str, df.select(*COLUMNS).collect()))


def whole(batches):
    rows = batches[0]
    for b in batches[1:]:
        rows = rows.union(b)
    return latest.last_by_id(B.decode_feed(rows).select(*COLUMNS))


def test_the_index_equals_the_last_rows_of_all_batches(spark, cfg, batches):
    assert read_index(spark, cfg).count() == 0
    for n, rows in enumerate(batches):
        update_index(rows, n, cfg, every=3)
        assert shown(read_index(spark, cfg)) == shown(whole(batches[:n + 1]))
    folders = {k: spark.read.parquet(f"{cfg.sinks.place('index')}/{k}").select("batch").distinct().count()
               for k in ("base", "delta")}
    assert folders == {"base": 1, "delta": 1}


def test_repeated_batches_change_nothing(spark, cfg, batches):
    for n, rows in enumerate(batches[:4]):
        update_index(rows, n, cfg, every=3)
    before = shown(read_index(spark, cfg))
    for n in (3, 2, 3):
        update_index(batches[n], n, cfg, every=3)
        assert shown(read_index(spark, cfg)) == before


def test_ids_not_seen_for_long_are_dropped(spark, cfg, batches):
    for n, rows in enumerate(batches):
        update_index(rows, n, cfg, every=7, keep_ms=1_500_000)
    kept = read_index(spark, cfg).collect()
    last = {r.event_id: r.timestamp for r in whole(batches).collect()}
    newest = max(last.values())
    assert {r.event_id for r in kept} == {i for i, t in last.items() if (newest - t).total_seconds() <= 1500} != set(last)


def test_a_base_that_was_not_finished_is_not_seen(spark, cfg, batches):
    update_index(batches[0], 0, cfg)
    spark.range(3).write.parquet(f"{cfg.sinks.place('index')}/base/_staging-5")
    assert shown(read_index(spark, cfg)) == shown(whole(batches[:1]))
    rebase(spark, cfg, 0)
    assert shown(read_index(spark, cfg)) == shown(whole(batches[:1]))


def test_a_stream_keeps_the_index(spark, cfg, batches, tmp_path):
    at = str(tmp_path / "bus")
    for rows in batches[:3]:
        rows.coalesce(1).write.mode("append").parquet(at)
    stream = spark.readStream.schema(B.BUS).option("maxFilesPerTrigger", 1).parquet(at)
    start_index(stream, cfg, every=2, available_now=True).awaitTermination()
    assert shown(read_index(spark, cfg)) == shown(whole(batches[:3]))
