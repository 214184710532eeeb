"""Proportional stratified interleaving of rows into shards, in DataFrame functions only.

Rows are shuffled by a seeded hash and ranked within their source; sorted by fractional rank
(rank - 1/2) / rows of the source, any run of rows holds the sources in the table's proportion.
The sorted sequence is cut into shards of equal length, give or take one row.

No window ever spans a source or the table: a rank is the number of rows in earlier cells (a
fixed grid over the hash, or over the fraction) plus the rank inside the cell, so a source with a
third of all rows is ranked by thousands of tasks. Only the per-cell counts, at most ``cells``
for each source, are summed in order.

Defined results: a null text has no bytes; a null source is a stratum of its own; null ids are
ranked like others; equal rows are interchangeable and each gets a place; an empty table gives
an empty result; other columns are ignored by ``assign`` and kept by ``shard_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 4096
CELL_ROWS = 50_000
SEED = 20261


def shuffle_key(seed: int, *values: Column) -> Column:
    """A seeded hash of ``values`` in [0, 2^52), exact as a double."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *values), 12)


def cells_for(n: int) -> int:
    """A power of two: ``CELLS`` at least, else cells of some ``CELL_ROWS`` rows."""
    return max(CELLS, 1 << (n // CELL_ROWS).bit_length())


def _place(rows: DataFrame, group: list[str], cell: str, order: list, name: str) -> DataFrame:
    """Adds ``name``, the rank from 0 within ``group`` by cell and then by ``order``; and the
    group's rows as ``_total``."""
    sizes = rows.groupBy(*group, cell).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy(cell).rowsBetween(
        Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*(group or [F.lit(0)]))
    starts = sizes.select(
        *group, cell, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(everything).alias("_total"))
    inside = Window.partitionBy(*group, cell).orderBy(*order)
    return (rows.withColumn("_in", F.row_number().over(inside))
            .join(starts, [*group, cell])
            .withColumn(name, F.col("_start") + F.col("_in") - 1)
            .drop("_start", "_in"))


def assign(
    rows: DataFrame, key: str, source: str, n_shards: int, *, seed: int = SEED, cells: int | None = None
) -> DataFrame:
    """``rows`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in each shard).

    Columns that already have these names are replaced.
    """
    if n_shards < 1:
        raise ValueError("n_shards has to be positive")
    cells = cells or cells_for(rows.count())
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    source = F.col(source)
    keyed = rows.select(
        F.struct(*kept).alias("row"), F.col(key).alias("key"),
        F.concat(source.isNull().cast("int").cast("string"),
                 F.coalesce(source.cast("string"), F.lit(""))).alias("source"),
        # Of the whole row, so that rows without a key, or with a common one, are dealt out as well.
        shuffle_key(seed, F.col(key), *map(F.col, kept)).alias("hash"), F.xxhash64(*kept).alias("whole")
    ).withColumn("cell", F.shiftright("hash", 52 - (cells.bit_length() - 1)))
    # The hash, then the key and the whole row: repeated keys stay in one order.
    order = ["hash", "key", "whole"]
    ranked = _place(keyed, ["source"], "cell", order, "rank").drop("cell")
    spread = (ranked.withColumn("at", (F.col("rank") + 0.5) / F.col("_total")).drop("_total")
              .withColumn("cell", F.floor(F.col("at") * cells)))
    placed = _place(spread, [], "cell", ["at", "source", *order], "position")
    shard = F.expr(f"(position * {n_shards}L) div _total")
    first = F.expr(f"(shard * _total + {n_shards - 1}L) div {n_shards}L")
    return (placed.withColumn("shard", shard.cast("int"))
            .withColumn("slot", (F.col("position") - first).cast("bigint"))
            .select("row.*", "shard", "slot"))


def summary_rows(docs: DataFrame) -> DataFrame:
    """Per document the narrow row that is dealt out: id, source, size, checksum of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))


def write_shards(docs: DataFrame, path: str, n_shards: int, *, seed: int = SEED) -> None:
    """Writes whole rows as Parquet, one folder per shard, each in slot order."""
    (assign(docs, "doc_id", "source", n_shards, seed=seed)
     .repartition(n_shards, "shard").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
