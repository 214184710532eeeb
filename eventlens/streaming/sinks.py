"""Partitioned Parquet sinks, streaming and batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlens.functions.times import event_date
from eventlens.operators.correlate import entityless
from eventlens.settings import Settings
from eventlens.sources.bus import unparsed
from eventlens.sources.sinks import QUARANTINE, path_exists, read_sink

# The suffix goes up whenever the join's state changes shape: a query cannot restart
# from a checkpoint of another shape.
PAIRS_QUERY = "correlate-v2"
RAW_QUERY = "raw"
QUARANTINE_QUERY = "quarantine"


def raw_rows(envelopes: DataFrame) -> DataFrame:
    """What the raw sink keeps: envelopes without entities, with their date."""
    return entityless(envelopes).select(
        "event_id", "source", "entities", "ts_ms", "payload",
        event_date(F.col("ts_ms")).alias("dt"),
    )


def quarantine_rows(bus: DataFrame, ahead_ms: int | None = None) -> DataFrame:
    """The bus rows that parsing leaves out, as text, with the date they arrived."""
    return _as_text(unparsed(bus, ahead_ms))


def unusable_rows(judged: DataFrame) -> DataFrame:
    """The same of rows that ``sources.bus.judged`` has parsed."""
    return _as_text(judged.filter("NOT usable"))


def _as_text(rows: DataFrame) -> DataFrame:
    return rows.select(
        "topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"),
        F.to_date("timestamp").alias("dt"))


def start_sink(df: DataFrame, name: str, path: str, partitions: list[str], cfg: Settings,
               available_now: bool = False) -> StreamingQuery:
    """Appends a stream to Parquet under the query's own checkpoint.

    Rows of one partition are brought together, ``cfg.sinks.files`` files for each, so a batch neither
    leaves a file for each task and partition nor puts a whole day into one task.
    """
    place = F.pmod(F.xxhash64(*df.columns), F.lit(cfg.sinks.files))
    writer = (
        df.repartition(*partitions, place).writeStream.format("parquet").outputMode("append").queryName(name)
        .partitionBy(*partitions)
        .option("path", path).option("checkpointLocation", f"{cfg.sinks.checkpoint_root}/{name}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif cfg.sinks.trigger:
        writer = writer.trigger(processingTime=cfg.sinks.trigger)
    return writer.start()


def start_raw(envelopes: DataFrame, cfg: Settings, available_now: bool = False) -> StreamingQuery:
    return start_sink(raw_rows(envelopes), RAW_QUERY, cfg.sinks.raw, ["dt", "source"], cfg,
                      available_now)


def start_pairs(pairs: DataFrame, cfg: Settings, available_now: bool = False) -> StreamingQuery:
    return start_sink(pairs, PAIRS_QUERY, cfg.sinks.pairs, ["dt"], cfg, available_now)


def start_quarantine(bus: DataFrame, cfg: Settings, ahead_ms: int | None = None,
                     available_now: bool = False) -> StreamingQuery:
    return start_sink(quarantine_rows(bus, ahead_ms), QUARANTINE_QUERY, cfg.sinks.place(QUARANTINE),
                      ["dt"], cfg, available_now)


def write_batch(df: DataFrame, path: str, partitions: list[str], replace: bool = False) -> None:
    """Appends a batch frame to a sink; ``replace`` writes the partitions it touches anew.

    The rebalance brings a partition's rows together so files come out few and even, and
    splits a partition that is too large for one task. A folder that a stream writes is
    refused: readers follow the stream's file log there and would not see these files.
    """
    if path_exists(df.sparkSession, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} belongs to a stream; write the batch to another folder")
    writer = df.hint("rebalance", *partitions).write.partitionBy(*partitions)
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def merge_batch(df: DataFrame, path: str, schema: str, partitions: list[str]) -> None:
    """Appends the rows that a sink does not hold yet; nothing it holds is touched.

    Copies count: of a row that is there k times and comes n times, n - k are appended. New rows and
    stored ones are weighed against each other by one aggregation, which combines copies per task;
    of the sink, only the days that the new rows are of are read.
    """
    stored = read_sink(df.sparkSession, path, schema).select(*df.columns)
    stored = stored.join(df.select("dt").distinct(), "dt", "left_semi").select(*df.columns)
    weighed = df.withColumn("_n", F.lit(1)).union(stored.withColumn("_n", F.lit(-1)))
    missing = (weighed.groupBy(*df.columns).agg(F.sum("_n").alias("_n")).filter("_n > 0")
               .withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))).drop("_n"))
    write_batch(missing, path, partitions)
