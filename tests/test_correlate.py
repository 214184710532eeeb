import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlens.operators.correlate import entityless, pairs, per_entity
from eventlens.streaming.pairs import stream_pairs

T0 = 1_700_000_000_000
MINUTE = 60_000


def found(df):
    return sorted((r.entity, r.a_id, r.b_id, r.ts_ms - T0) for r in df.collect())


@pytest.fixture(params=["cells", "grid"])
def pair_up(request):
    """Both forms of the join, each cut up finely."""
    if request.param == "cells":
        return lambda df, window="10 minutes": pairs(df, window, chunk=2)
    return lambda df, window="10 minutes": stream_pairs(df, window, 3, ("AAPL",))


def test_any_two_sources(envelopes, pair_up):
    df = pair_up(envelopes(("b1", "blog", ["ETH"], 0), ("p1", "podcast", ["ETH"], MINUTE)))
    assert found(df) == [("ETH", "b1", "p1", MINUTE)]
    assert str(df.first().dt) == "2023-11-14"
    assert df.columns == ["entity", "a_id", "b_id", "ts_ms", "dt"]


def test_smaller_source_name_comes_first(envelopes, pair_up):
    df = envelopes(("r", "rss", ["AAPL"], 0), ("h", "hn", ["AAPL"], 30_000))
    assert found(pair_up(df)) == [("AAPL", "h", "r", 30_000)]


def test_same_source_never_pairs(envelopes, pair_up):
    df = envelopes(("h1", "hn", ["AAPL"], 0), ("h2", "hn", ["AAPL"], 1000))
    assert found(pair_up(df)) == []


def test_three_sources_make_three_pairs(envelopes, pair_up):
    df = envelopes(("a1", "alpha", ["AAPL"], 0), ("b1", "beta", ["AAPL"], 1000),
                   ("g1", "gamma", ["AAPL"], 2000))
    assert found(pair_up(df)) == [("AAPL", "a1", "b1", 1000), ("AAPL", "a1", "g1", 2000),
                                  ("AAPL", "b1", "g1", 2000)]


def test_entities_of_one_envelope(envelopes, pair_up):
    df = envelopes(("h", "hn", ["AAPL", "MSFT", "AAPL"], 0), ("r", "rss", ["AAPL", "MSFT"], 0))
    assert found(pair_up(df)) == [("AAPL", "h", "r", 0), ("MSFT", "h", "r", 0)]


@pytest.mark.parametrize("delta", [MINUTE, 10 * MINUTE, -10 * MINUTE])
def test_window_is_inclusive(envelopes, pair_up, delta):
    df = envelopes(("h", "hn", ["X"], 0), ("r", "rss", ["X"], delta))
    assert found(pair_up(df)) == [("X", "h", "r", max(0, delta))]


@pytest.mark.parametrize("delta", [10 * MINUTE + 1, -10 * MINUTE - 1])
def test_past_the_window(envelopes, pair_up, delta):
    assert found(pair_up(envelopes(("h", "hn", ["X"], 0), ("r", "rss", ["X"], delta)))) == []


def test_nulls_and_blanks_never_pair(envelopes, pair_up):
    df = envelopes(
        ("n", None, ["AAPL"], 0), ("s", "  ", ["AAPL"], 0), ("t", "hn", None, 0),
        ("u", "rss", ["", " ", None, "AAPL"], 0), ("v", "hn", ["", " ", None, "AAPL"], 0),
        ("w", "web", ["AAPL"], None),
    )
    assert found(pair_up(df)) == [("AAPL", "v", "u", 0)]


def test_copies_multiply(envelopes, pair_up):
    df = envelopes(*[("h", "hn", ["X"], 0)] * 5, *[("r", "rss", ["X"], 1)] * 3)
    assert found(pair_up(df)) == [("X", "h", "r", 1)] * 15


def test_times_before_the_epoch(envelopes, pair_up):
    df = envelopes(("h", "hn", ["X"], -T0 - 1), ("r", "rss", ["X"], -T0 + 1))
    [row] = pair_up(df).collect()
    assert (row.ts_ms, str(row.dt)) == (1, "1970-01-01")


def brute_force(rows, window_ms):
    out = []
    for i, source, entities, t in rows:
        for j, other, partners, u in rows:
            if source < other and abs(t - u) <= window_ms:
                out += [(e, i, j, max(t, u)) for e in set(entities) & set(partners)]
    return sorted(out)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from(["a", "b", "c"]), st.lists(st.sampled_from("XY"), max_size=2),
    st.integers(-3, 3), st.integers(-2, 2)), max_size=14), st.integers(1, 5))
def test_any_chunk_size_gives_the_same_pairs(envelopes, rows, chunk):
    rows = [(f"{s}{n}", s, e, minutes * 5 * MINUTE + extra)
            for n, (s, e, minutes, extra) in enumerate(rows)]
    frame = envelopes(*rows) if rows else envelopes(("x", "a", [], 0))
    assert found(pairs(frame, "5 minutes", chunk)) == brute_force(rows, 5 * MINUTE)
    assert found(stream_pairs(frame, "5 minutes", chunk)) == brute_force(rows, 5 * MINUTE)


def test_hot_entity_hot_source_and_copies(envelopes):
    """Most rows share one entity and one source, a third are copies of one event."""
    rng = random.Random(7)
    rows = [(f"h{n}", "hot", ["X"], rng.randrange(20 * MINUTE)) for n in range(300)]
    rows += [("copy", "hot", ["X"], 5 * MINUTE)] * 200
    rows += [(f"o{n}", rng.choice(["cold", "warm"]), ["X"], rng.randrange(20 * MINUTE))
             for n in range(6)]
    expected = brute_force(rows, 10 * MINUTE)
    assert found(pairs(envelopes(*rows), chunk=16)) == expected
    assert found(stream_pairs(envelopes(*rows))) == expected


def test_no_task_gets_a_whole_hot_cell(envelopes):
    """The join keys split a hot cell into blocks of about ``chunk`` rows a side."""
    from eventlens.settings import window_ms
    from eventlens.operators import correlate as C

    rows = envelopes(*[(f"h{n}", "hot", ["X"], n) for n in range(400)],
                     *[("copy", "hot", ["X"], 0)] * 400, ("o", "other", ["X"], 0))
    base = C._distinct_rows(per_entity(rows), window_ms("10 minutes"))
    links = C._links(C._cells(base, 50), window_ms("10 minutes"), 50)
    side = C._side(base, links, "a", 50)
    loads = side.groupBy("b_bin", "a_block", "b_block").agg(F.sum("a_copies").alias("n")).collect()
    assert sum(r.n for r in loads) == 800
    assert len(loads) == 16
    assert max(r.n for r in loads) <= 4 * 50


def test_entityless(envelopes):
    df = envelopes(("n", "a", None, 0), ("e", "a", [], 0), ("b", "a", [""], 0), ("x", "a", ["X"], 0))
    assert {r.event_id for r in entityless(df).collect()} == {"n", "e"}


def test_scan_and_shuffle_happen_once(spark, tmp_path, envelopes):
    """Every use of the rows reads the same shuffle, and payloads are never read."""
    path = str(tmp_path / "env")
    envelopes(*[(f"{s}{n}", s, ["X"], n * 1000) for n in range(50) for s in "ab"]
              ).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = pairs(spark.read.parquet(path))
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert final.count("FileScan") == 1
    assert "payload" not in final
    assert "CartesianProduct" not in final and "NestedLoop" not in final
