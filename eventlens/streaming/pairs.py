"""The pair join over a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.times import event_date, event_time
from eventlens.operators.correlate import per_entity
from eventlens.settings import window_ms


def with_event_time(envelopes: DataFrame, window: str) -> DataFrame:
    """Event time with its watermark. Set once, upstream: both join sides inherit it."""
    window_ms(window)
    return envelopes.withColumn("event_time", event_time(F.col("ts_ms"))).withWatermark(
        "event_time", window
    )


def state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(side, entity, event_id, ts_ms) of the rows that the pair join holds, from its last state on disk."""
    def side(name: str, prefix: str) -> DataFrame:
        state = spark.read.format("statestore").option("joinSide", name).load(checkpoint)
        return state.select(F.lit(prefix).alias("side"), *(
            F.col(f"value.{prefix}_{c}").alias(c) for c in ("entity", "event_id", "ts_ms")))

    return side("left", "a").union(side("right", "b"))


def state_versions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operator, batches of the state that a restart can go back to."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorName", "stateStoreName", "minBatchId", "maxBatchId")


def stream_pairs(envelopes: DataFrame, window: str = "10 minutes", hot_grid: int = 8,
                 hot_entities: tuple[str, ...] = ()) -> DataFrame:
    """``operators.correlate.pairs`` over a stream; works on a batch frame as well.

    The join's key is (entity, time bin of one window's length): an ``a`` row is kept in its own
    bin, a ``b`` row in its own and both neighbours, so a row meets the rows of one bin and not all
    the state of its entity, and each pair meets once. Both time bounds stand in the condition
    as well, so Spark drops state that the watermark has passed.

    Nobody can know a stream's cell sizes beforehand. An entity named as hot is spread further over
    ``hot_grid`` state partitions: an ``a`` row takes one of them by its id, or by its ``position``
    on the bus where there is one, and a ``b`` row is shown to all. Key and grid are part of the
    state, so changing them needs a new checkpoint.
    """
    rows = per_entity(with_event_time(envelopes, window))
    grid = F.lit(1)
    if hot_entities:
        grid = F.when(F.col("entity").isin(*hot_entities), hot_grid).otherwise(grid)
    rows = (rows.withColumn("_grid", grid)
            .withColumn("_bin", F.floor(F.col("ts_ms") / window_ms(window))))
    place = ["position"] if "position" in rows.columns else ["event_id", "ts_ms"]
    one = F.pmod(F.xxhash64(*place), F.col("_grid")).cast("int")
    every = F.sequence(F.lit(0), F.col("_grid") - 1)
    near_bins = F.sequence(F.col("_bin") - 1, F.col("_bin") + 1)

    def side(name: str, frame: DataFrame, bin_: Column, cell: Column) -> DataFrame:
        renamed = [F.col(c).alias(f"{name}_{c}") for c in
                   ("entity", "event_id", "source", "ts_ms", "event_time")]
        return frame.select(*renamed, bin_.alias(f"{name}_bin"), cell.alias(f"{name}_cell"))

    copies = rows.withColumn("_near", F.explode(near_bins)).withColumn("_cell", F.explode(every))
    near = F.expr(
        f"a_event_time BETWEEN b_event_time - INTERVAL {window} "
        f"AND b_event_time + INTERVAL {window}"
    )
    c = F.col
    joined = side("a", rows, c("_bin"), one).join(
        side("b", copies, c("_near"), c("_cell")),
        (c("a_entity") == c("b_entity")) & (c("a_bin") == c("b_bin"))
        & (c("a_cell") == c("b_cell")) & near & (c("a_source") < c("b_source")),
    )
    later = F.greatest("a_ts_ms", "b_ts_ms")
    return joined.select(
        c("a_entity").alias("entity"), c("a_event_id").alias("a_id"),
        c("b_event_id").alias("b_id"), later.alias("ts_ms"), event_date(later).alias("dt"),
    )
