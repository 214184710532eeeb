"""Reading what the jobs have written: Parquet trees, catalog tables, checkpoint files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.settings import Settings


RAW_SCHEMA = ("event_id string, entities array<string>, ts_ms bigint, payload string, "
              "dt date, source string")
PAIRS_SCHEMA = "entity string, a_id string, b_id string, ts_ms bigint, dt date"

# The names the tables and the views share.
RAW_TABLE = "events_raw"
PAIRS_TABLE = "correlated"


CURSORS, QUARANTINE = "cursors", "quarantine"
# Of the fan-out: what pairs are made of, what came too late, and what each batch held.
ENTITY_ROWS, LATE, BATCHES = "entity_rows", "late", "batches"
ENTITY_ROWS_SCHEMA = "event_id string, source string, entities array<string>, ts_ms bigint, batch bigint, dt date"
LATE_SCHEMA = ("event_id string, source string, entities array<string>, ts_ms bigint, payload string, "
               "late_ms bigint, batch bigint, dt date")
BATCHES_SCHEMA = ("n bigint, unusable bigint, raw bigint, entity_rows bigint, late bigint, max_ms bigint, "
                  "watermark_ms bigint, batch bigint")
CURSOR_SCHEMA = "source string, cursor_ms bigint"
QUARANTINE_SCHEMA = ("topic string, partition int, offset bigint, timestamp timestamp, value string, "
                     "dt date")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or a glob) matches anything on its file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder the session names for checkpoints."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a shared folder")
        base = tempfile.mkdtemp(prefix="scratch-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def read_sink(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A partitioned Parquet sink; empty when it was never written.

    The schema is given, so no file footer is read to infer it and files that lack a
    column read it as null.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def partition_values(spark: SparkSession, path: str, key: str) -> list[str]:
    """The values of a sink's outermost partition column, from folder names, ascending; nulls left out."""
    if not path_exists(spark, path):
        return []
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    names = [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    values = [n.removeprefix(f"{key}=") for n in names if n.startswith(f"{key}=")]
    return sorted(v for v in values if v != "__HIVE_DEFAULT_PARTITION__")


def read_raw(spark: SparkSession, cfg: Settings) -> DataFrame:
    return read_sink(spark, cfg.sinks.raw, RAW_SCHEMA)


def read_pairs(spark: SparkSession, cfg: Settings) -> DataFrame:
    return read_sink(spark, cfg.sinks.pairs, PAIRS_SCHEMA)


def read_quarantine(spark: SparkSession, cfg: Settings) -> DataFrame:
    """Bus rows that are no envelopes, with their text as it came."""
    return read_sink(spark, cfg.sinks.place(QUARANTINE), QUARANTINE_SCHEMA)


def read_cursors(spark: SparkSession, cfg: Settings) -> DataFrame:
    """How far each source has been sent. Each run appends its rows; the furthest one counts."""
    rows = read_sink(spark, cfg.sinks.place(CURSORS), CURSOR_SCHEMA)
    return rows.groupBy("source").agg(F.max("cursor_ms").alias("cursor_ms"))


def append_cursors(cursors: DataFrame, cfg: Settings) -> None:
    cursors.select("source", "cursor_ms").coalesce(1).write.mode("append").parquet(
        cfg.sinks.place(CURSORS))


def newest_days(spark: SparkSession, path: str, schema: str, n: int) -> DataFrame:
    """The rows of as many of a sink's newest days as hold ``n`` rows: all of a top-n by time is there.

    A row's day follows from its time, so no older day can have a newer row; ties of the n-th row are of
    its day as well. Days are taken one, two, four, .. at a time, and a count reads footers only.
    """
    rows = read_sink(spark, path, schema)
    days, take = partition_values(spark, path, "dt"), 1
    while take < len(days):
        newest = rows.filter(F.col("dt") >= F.lit(days[-take]).cast("date"))
        if newest.count() >= n:
            return newest
        take *= 2
    return rows


def totals(spark: SparkSession, cfg: Settings) -> DataFrame:
    """sink, n, last_ts_ms from the footers of its files, and bytes from one look at the folder.

    Counts and maxima are pushed into the Parquet reader, which has them from each file's footer. That
    needs another reader than other queries use, so it is set in a session of its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    out = []
    for name, schema in ((PAIRS_TABLE, PAIRS_SCHEMA), (RAW_TABLE, RAW_SCHEMA)):
        n, last = read_footers(own, cfg.sinks.place(name), schema).first()
        out.append((name, n, last, folder_bytes(spark, cfg.sinks.place(name))))
    return spark.createDataFrame(out, "sink string, n bigint, last_ts_ms bigint, bytes bigint")


def read_footers(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """n, last_ts_ms of a sink; one row."""
    return read_sink(spark, path, schema).agg(F.count(F.lit(1)).alias("n"), F.max("ts_ms").alias("last_ts_ms"))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """What a sink's partitions take; 0 for one that was never written. Files are not listed here."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return 0
    shown = [f.getPath() for f in fs.listStatus(p) if f.getPath().getName()[0] not in "_."]
    return sum(fs.getContentSummary(child).getLength() for child in shown)


def read_late(spark: SparkSession, cfg: Settings) -> DataFrame:
    """Events that came behind the watermark, by how much, and in which batch."""
    return read_sink(spark, cfg.sinks.place(LATE), LATE_SCHEMA)


def read_batches(spark: SparkSession, cfg: Settings) -> DataFrame:
    """What each batch of the fan-out held: a row per batch."""
    return read_sink(spark, cfg.sinks.place(BATCHES), BATCHES_SCHEMA)


def register_views(spark: SparkSession, cfg: Settings) -> None:
    """Temp views over the sinks, for plain SQL where there is no catalog."""
    read_raw(spark, cfg).createOrReplaceTempView(RAW_TABLE)
    read_pairs(spark, cfg).createOrReplaceTempView(PAIRS_TABLE)


def file_listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, modified, length of every file below the paths; contents are not read."""
    present = [p for p in paths if path_exists(spark, p)]
    if not present:
        return spark.createDataFrame([], "path string, modified timestamp, length bigint")
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(present)
        .select("path", F.col("modificationTime").alias("modified"), "length")
    )


def sink_bytes(spark: SparkSession, cfg: Settings) -> DataFrame:
    """sink, bytes: 0 for a sink that was never written."""
    return spark.createDataFrame(
        [(name, folder_bytes(spark, cfg.sinks.place(name))) for name in (PAIRS_TABLE, RAW_TABLE)],
        "sink string, bytes bigint")


def query_progress(spark: SparkSession, checkpoint_root: str, now_ms: int) -> DataFrame:
    """Per streaming query the last planned and committed batch and the commit's age.

    A planned batch without a commit is running. Only file names and times are read.
    """
    files = file_listing(
        spark, [f"{checkpoint_root}/*/offsets", f"{checkpoint_root}/*/commits"]
    ).select(
        F.regexp_extract("path", r"/([^/]+)/(?:offsets|commits)/\d+$", 1).alias("query"),
        F.regexp_extract("path", r"/(offsets|commits)/\d+$", 1).alias("kind"),
        F.regexp_extract("path", r"/(\d+)$", 1).try_cast("bigint").alias("batch"),
        F.unix_millis("modified").alias("modified_ms"),
    ).filter(F.col("query") != "")
    committed = F.col("kind") == "commits"
    return files.groupBy("query").agg(
        F.max(F.when(F.col("kind") == "offsets", F.col("batch"))).alias("planned"),
        F.max(F.when(committed, F.col("batch"))).alias("committed"),
        (F.lit(now_ms) - F.max_by("modified_ms", F.when(committed, F.col("batch"))))
        .alias("committed_ago_ms"),
    ).select(
        "*",
        (F.col("planned").isNotNull() & ~F.col("planned").eqNullSafe(F.col("committed")))
        .alias("running"),
    )
