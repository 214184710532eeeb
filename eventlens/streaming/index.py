"""The last row of every event id, kept up to date by a stream.

Each batch leaves its own last rows as a small delta; every so many batches the base and the deltas become
a new base, without ids that have not been seen for ``keep_ms``. Reading takes the newest base and the
deltas behind it, so its cost follows the ids that are kept and not the length of the bus.

A delta is a folder named by its batch and a base one named by the last batch in it; a base gets its
name only when it is whole. So a batch that runs again replaces its delta, or finds it in a base
already, and a reader never sees half a base.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlens.operators import latest
from eventlens.settings import Settings
from eventlens.sources import bus as B
from eventlens.sources.sinks import partition_values

INDEX, INDEX_QUERY = "index", "index"
INDEX_SCHEMA = ("event_id string, timestamp timestamp, topic string, partition int, offset bigint, "
                "ts_ms bigint, summary string")
#: Batches between two bases.
EVERY = 16


def _folder(cfg: Settings, kind: str) -> str:
    return f"{cfg.sinks.place(INDEX)}/{kind}"


def _numbers(spark: SparkSession, cfg: Settings, kind: str) -> list[int]:
    return sorted(map(int, partition_values(spark, _folder(cfg, kind), "batch")))


def read_index(spark: SparkSession, cfg: Settings) -> DataFrame:
    """One row per event id that is kept, as ``operators.latest.last_by_id`` over the whole bus has it."""
    bases = _numbers(spark, cfg, "base")
    upto = bases[-1] if bases else -1
    folders = [f"{_folder(cfg, 'base')}/batch={upto}"] if bases else []
    folders += [f"{_folder(cfg, 'delta')}/batch={n}" for n in _numbers(spark, cfg, "delta") if n > upto]
    if not folders:
        return spark.createDataFrame([], INDEX_SCHEMA)
    names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]
    return latest.last_by_id(spark.read.schema(INDEX_SCHEMA).parquet(*folders).select(*names))


def update_index(bus: DataFrame, batch: int, cfg: Settings, every: int = EVERY, keep_ms: int | None = None) -> None:
    """One batch of bus rows into the index; again for the same rows, it changes nothing."""
    spark = bus.sparkSession
    feed = B.decode_feed(B.topic_filter(bus, cfg.bus.topics))
    names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]
    bases = _numbers(spark, cfg, "base")
    if not bases or bases[-1] < batch:
        latest.last_by_id(feed.select(*names)).write.mode("overwrite").parquet(f"{_folder(cfg, 'delta')}/batch={batch}")
    if (batch + 1) % every == 0:
        rebase(spark, cfg, batch, keep_ms)


def rebase(spark: SparkSession, cfg: Settings, batch: int, keep_ms: int | None = None) -> None:
    """Makes base and deltas up to ``batch`` one base, then removes what it replaces."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(cfg.sinks.place(INDEX))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    target = hadoop.Path(f"{_folder(cfg, 'base')}/batch={batch}")
    if not fs.exists(target):
        rows = read_index(spark, cfg)
        if keep_ms is not None and (newest := rows.agg(F.max("timestamp")).first()[0]) is not None:
            rows = rows.filter(F.col("timestamp") >= F.lit(newest - timedelta(milliseconds=keep_ms)))
        staged = f"{_folder(cfg, 'base')}/_staging-{batch}"
        rows.write.mode("overwrite").parquet(staged)
        if not fs.rename(hadoop.Path(staged), target):
            raise OSError(f"{staged} could not be moved to {target}")
    for kind, last in (("base", batch - 1), ("delta", batch)):
        for n in _numbers(spark, cfg, kind):
            if n <= last:
                fs.delete(hadoop.Path(f"{_folder(cfg, kind)}/batch={n}"), True)


def start_index(bus: DataFrame, cfg: Settings, every: int = EVERY, keep_ms: int | None = None,
                available_now: bool = False) -> StreamingQuery:
    writer = (bus.writeStream.queryName(INDEX_QUERY)
              .option("checkpointLocation", f"{cfg.sinks.checkpoint_root}/{INDEX_QUERY}")
              .foreachBatch(lambda rows, batch: update_index(rows, batch, cfg, every, keep_ms)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif cfg.sinks.trigger:
        writer = writer.trigger(processingTime=cfg.sinks.trigger)
    return writer.start()
