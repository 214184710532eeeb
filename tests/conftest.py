import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("eventlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


ENVELOPE = "event_id string, source string, entities array<string>, ts_ms bigint, payload string"
T0 = 1_700_000_000_000


@pytest.fixture(scope="session")
def envelopes(spark):
    """Rows of (id, source, entities, milliseconds after T0)."""
    def make(*rows):
        return spark.createDataFrame(
            [(i, s, e, None if t is None else T0 + t, "{}") for i, s, e, t in rows], ENVELOPE
        )

    return make


@pytest.fixture(scope="session")
def value(spark):
    """The values of columns over a one-row frame of string columns."""
    def evaluate(make, **texts):
        frame = spark.createDataFrame(
            [tuple(texts.values())], ", ".join(f"{n} string" for n in texts) or "_ string"
        )
        return frame.select(make.alias("v")).first().v

    return evaluate


BUS = ("topic string, partition int, offset bigint, key binary, value binary, "
       "headers array<struct<key:string,value:binary>>, timestamp timestamp")


@pytest.fixture(scope="session")
def bus(spark):
    """Bus rows of (topic, partition, offset, value text, error, epoch seconds)."""
    from datetime import UTC, datetime

    def make(*rows):
        return spark.createDataFrame([
            (t, p, o, b"k", None if v is None else v.encode(),
             None if e is None else [("eventlens.error", e.encode())],
             datetime.fromtimestamp(s, UTC))
            for t, p, o, v, e, s in rows
        ], BUS)

    return make
