"""All sinks from one read of the bus.

Each micro-batch is parsed once and goes to every sink: events without entities, pairs, bus rows that
are no envelopes, events that came too late, and the entity rows that later batches pair with. These
rows are the state, as a table by day: a batch lands its own, then joins what is new to the rows within
the window, by ``operators.correlate.pairs``, which counts the cells of this very batch. So an entity
that becomes hot is spread over chunk pairs at once, without anybody naming it, and no grid is part of
a checkpoint.

A batch is repeated whole if the driver or a sink fails before its commit. What it lands carries its
number in the file names, and landing a batch first removes files of that number; it reads only rows
of its own and of earlier batches. So a repeated batch leaves the same rows.

An event is late if its time is not after the watermark: the latest time of all batches before the
previous one less the window, which is what Spark's own stream join drops. Late events are not paired; they are kept with their
lateness, and ``batches`` has the counts of every batch, which add up to its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlens.functions.times import DAY_MS, MAX_TS_MS, MIN_TS_MS, event_date
from eventlens.operators.correlate import FRESH, pairs
from eventlens.settings import Settings, window_ms
from eventlens.sources import bus as B
from eventlens.sources import sinks
from eventlens.streaming import repair
from eventlens.streaming.sinks import raw_rows, unusable_rows

FANOUT_QUERY = "fanout"
# Of a task that writes: partitions it has open at once, and bytes it holds for each.
OPEN_FILES, ROW_GROUP = 64, 8 << 20
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# Entity rows that one join takes, unless a single day has more. The tasks of a join have a file open for
# each of its days, and each file holds dictionaries of the ids in it.
WAVE = 500_000
# Adaptive execution merges a join's partitions by what they read. Pairs of a large day are many more than
# that, so such a join keeps this many tasks a core, if the partitions have a megabyte each.
FEWEST, TASKS_A_CORE = "spark.sql.adaptive.coalescePartitions.minPartitionNum", 4


@contextmanager
def _set(spark: SparkSession, key: str, value: int) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def land(df: DataFrame, path: str, partitions: list[str], batch: int) -> list[str]:
    """Writes the rows of one batch into a partitioned sink; returns the partitions as ``k=v/...``.

    They are staged below the sink, unseen by readers, then moved to ``batch-<number>-<k>.parquet``.
    Files that an earlier attempt at this batch has left in those partitions go first.

    Each task writes its rows as they come, unsorted, with a small row group open for each partition.
    Bringing rows of one partition together is the caller's to do.
    """
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    staged = hadoop.Path(f"{path}/_staging/batch-{batch}")
    fs = staged.getFileSystem(spark._jsc.hadoopConfiguration())
    with _set(spark, WRITERS, OPEN_FILES):
        (df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).partitionBy(*partitions)
         .parquet(staged.toString()))
    root = fs.resolvePath(staged).toUri().getPath()
    files, found = [], fs.listFiles(staged, True)
    while found.hasNext():
        file = found.next().getPath()
        if file.getName().endswith(".parquet"):
            files.append((file, file.getParent().toUri().getPath().removeprefix(root).strip("/")))
    touched = sorted({folder for _, folder in files})
    for folder in touched:
        target = hadoop.Path(f"{path}/{folder}") if folder else hadoop.Path(path)
        fs.mkdirs(target)
        for old in fs.globStatus(hadoop.Path(target, f"batch-{batch}-*")) or []:
            fs.delete(old.getPath(), False)
    for k, (file, folder) in enumerate(files):
        target = hadoop.Path(f"{path}/{folder}/batch-{batch}-{k}.parquet")
        if not fs.rename(file, target):
            raise OSError(f"{file} could not be moved to {target}")
    fs.delete(staged, True)
    return touched


def _counts(rows: DataFrame, late: Column) -> list[Column]:
    def n(condition: Column, name: str) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)

    usable = F.col("usable")
    named = F.size(F.coalesce("e.entities", F.array().cast("array<string>"))) > 0
    ts = F.when(usable, F.col("e.ts_ms"))
    fresh = F.when(named & ~late, ts)
    return [F.count(F.lit(1)).alias("n"), n(~usable, "unusable"), n(usable & ~named, "raw"),
            n(usable & named & ~late, "entity_rows"), n(usable & named & late, "late"),
            F.max(ts).alias("max_ms"), F.min(fresh).alias("_low"), F.max(fresh).alias("_high")]


def _waves(known: DataFrame, width: int, most: int) -> list[tuple[int, int]]:
    """First and last day number of runs of days that have ``most`` rows or fewer, or are one day.

    A join reads one window more than its days. So that this stays little, they last eight windows at least.
    """
    days = known.groupBy(F.unix_date("dt").alias("day")).count().orderBy("day").collect()
    waves: list[tuple[int, int]] = []
    held = 0
    for day, n in days:
        if waves and (held + n <= most or (waves[-1][1] + 1 - waves[-1][0]) * DAY_MS < 8 * width):
            waves[-1], held = (waves[-1][0], day), held + n
        else:
            waves.append((day, day))
            held = n
    return waves


def write_fanout(bus: DataFrame, batch: int, cfg: Settings, ahead_ms: int | None = None,
                 landed: Callable[[str, list[str]], None] | None = None) -> None:
    """One batch of bus rows into all sinks. Running it again for the same rows changes nothing.

    ``landed`` is told each table's partitions that got files.
    """
    spark, width = bus.sparkSession, window_ms(cfg.join.window)
    before, stored = sinks.read_batches(spark, cfg).filter(F.col("batch") < batch).agg(
        F.max(F.when(F.col("batch") < batch - 1, F.col("max_ms"))), F.coalesce(F.sum("entity_rows"), F.lit(0))).first()
    watermark = None if before is None else before - width
    late = F.lit(False) if watermark is None else F.col("e.ts_ms") <= watermark
    rows = B.judged(B.topic_filter(bus, cfg.bus.topics), ahead_ms)
    # What is kept of a row: a usable one is wanted parsed, any other as its text.
    rows = rows.select("topic", "partition", "offset", "timestamp", "e", "usable",
                       F.when(~F.col("usable"), F.col("value")).alias("value")).persist()

    def spread(name: str, frame: DataFrame, *keys: str, together: bool = True) -> None:
        frame = frame.hint("rebalance", *keys) if together else frame
        touched = land(frame, cfg.sinks.place(name), list(keys), batch)
        if landed is not None and touched:
            landed(name, touched)

    try:
        counts = rows.agg(*_counts(rows, late)).first()
        usable = rows.filter("usable")
        envelopes = usable.select("e.*")
        named = usable.filter(F.size("e.entities") > 0)
        dt = event_date(F.col("ts_ms")).alias("dt")
        number = F.lit(batch).cast("bigint").alias("batch")

        held = named.filter(~late).select("e.*").select("event_id", "source", "entities", "ts_ms", number, dt)
        spread(sinks.ENTITY_ROWS, held, "dt")
        # New rows and earlier ones from one scan of what has landed, so the join shuffles them once.
        known = sinks.read_sink(spark, cfg.sinks.place(sinks.ENTITY_ROWS), sinks.ENTITY_ROWS_SCHEMA)
        known = known.withColumn(FRESH, F.col("batch") == batch)

        def near(first_ms: int, last_ms: int) -> DataFrame:
            low, high = (F.lit(ms).cast("bigint") for ms in (
                max(counts["_low"] - width, first_ms), min(counts["_high"] + width, last_ms)))
            # The days are implied by the times, and unlike them choose folders.
            return known.filter((F.col("batch") <= batch) & F.col("ts_ms").between(low, high)
                                & F.col("dt").between(event_date(low), event_date(high)))

        if counts["_low"] is None:
            found = [(pairs(known.limit(0), cfg.join.window), False)]
        elif stored + counts["entity_rows"] <= WAVE:
            found = [(pairs(near(MIN_TS_MS - width, MAX_TS_MS + width), cfg.join.window), False)]
        else:
            # A pair is of the day of its later row; the other one is at most a window before.
            found = [(pairs(near(first * DAY_MS - width, (last + 1) * DAY_MS - 1), cfg.join.window)
                      .filter(F.col("ts_ms") >= first * DAY_MS), first == last)
                     for first, last in _waves(near(MIN_TS_MS - width, MAX_TS_MS + width), width, WAVE)]
        too_late = named.filter(late).select("e.*").select(
            "event_id", "source", "entities", "ts_ms", "payload",
            (F.lit(watermark).cast("bigint") - F.col("ts_ms")).alias("late_ms"), number, dt)

        spread(sinks.RAW_TABLE, raw_rows(envelopes), "dt", "source")
        # Many more than the rows they are made of: they are neither shuffled nor sorted once more.
        for part, one_day in found:
            tasks = TASKS_A_CORE * spark.sparkContext.defaultParallelism
            with _set(spark, FEWEST, tasks) if one_day else nullcontext():
                spread(sinks.PAIRS_TABLE, part, "dt", together=False)
        spread(sinks.LATE, too_late, "dt")
        spread(sinks.QUARANTINE, unusable_rows(rows), "dt")
        # Last of all, since a later batch's watermark is taken from it.
        done = spark.range(1).select(*(
            F.lit(counts[c]).cast("bigint").alias(c) for c in ("n", "unusable", "raw", "entity_rows", "late", "max_ms")),
            F.lit(watermark).cast("bigint").alias("watermark_ms"), number)
        land(done, cfg.sinks.place(sinks.BATCHES), ["batch"], batch)
    finally:
        rows.unpersist()


def start_fanout(spark: SparkSession, bus: DataFrame, cfg: Settings, ahead_ms: int | None = None,
                 available_now: bool = False) -> StreamingQuery:
    """The fan-out over a bus stream; tables get the partitions that land, and only these."""
    landed = None
    if cfg.tables.hive:
        repair.bootstrap_tables(spark, cfg)

        def landed(name: str, touched: list[str]) -> None:
            if name in repair.TABLES:
                repair.register_partitions(spark, cfg, name, touched)

    writer = (bus.writeStream.queryName(FANOUT_QUERY)
              .option("checkpointLocation", f"{cfg.sinks.checkpoint_root}/{FANOUT_QUERY}")
              .foreachBatch(lambda rows, batch: write_fanout(rows, batch, cfg, ahead_ms, landed)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif cfg.sinks.trigger:
        writer = writer.trigger(processingTime=cfg.sinks.trigger)
    return writer.start()
