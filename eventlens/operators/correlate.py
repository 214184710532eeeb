"""Pairs of events from different sources that share an entity close in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.settings import window_ms
from eventlens.functions.times import event_date

# Rows one side of a join block may hold, so a block compares at most CHUNK^2 pairs.
CHUNK = 20_000
# A boolean column of envelopes: pairs then need one side for which it holds.
FRESH = "_fresh"
# What tells the cells of an entity apart.
CELL = ("bin", "source")


def entityless(envelopes: DataFrame) -> DataFrame:
    """Envelopes that name no entity; a missing array counts as naming none."""
    return envelopes.filter(F.col("entities").isNull() | (F.size("entities") == 0))


def per_entity(envelopes: DataFrame) -> DataFrame:
    """One row per envelope and distinct entity; blank sources and entities are left out."""
    kept = ["event_id", "source", "ts_ms"]
    kept += [c for c in ("event_time", "position", FRESH) if c in envelopes.columns]
    return (
        envelopes.filter(F.trim("source") != "")
        .select(*kept, F.explode(F.array_distinct("entities")).alias("entity"))
        .filter(F.trim("entity") != "")
    )


def pairs(envelopes: DataFrame, window: str = "10 minutes", chunk: int = CHUNK) -> DataFrame:
    """Every pair of events of different sources sharing an entity within ``window``.

    Both bounds are inclusive. ``a_id`` belongs to the smaller source name, ``ts_ms`` is
    the later time and ``dt`` its UTC date. Envelopes that occur several times pair
    several times.

    Time is cut into cells of one window length: a cell holds the rows of one entity,
    source and time bin. Which cells can pair at all is settled on per-cell statistics,
    so rows without a possible partner are gone before the pairing and rows of one
    source never meet. Cells with more than ``chunk`` rows are cut into chunks, and
    every (left chunk, right chunk) is a join key of its own: a hot entity, a hot
    source or a crowd of copies spreads over as many tasks as it has chunk pairs.

    With a column ``FRESH`` only pairs with a fresh side are returned, and cells of old rows never meet.
    """
    width = window_ms(window)
    cell = (*CELL, FRESH) if FRESH in envelopes.columns else CELL
    rows = _distinct_rows(per_entity(envelopes), width, cell)
    links = _links(_cells(rows, chunk, cell), width, chunk, cell)
    left, right = (_copies(_side(rows, links, side, chunk, cell), f"{side}_copies") for side in "ab")
    matched = left.join(
        right, ["entity", *(f"{side}_{c}" for side in "ab" for c in (*cell, "block"))]
    ).filter(F.abs(F.col("a_ts") - F.col("b_ts")) <= width)
    later = F.greatest("a_ts", "b_ts")
    return matched.select(
        "entity", "a_id", "b_id", later.alias("ts_ms"), event_date(later).alias("dt")
    )


def _distinct_rows(rows: DataFrame, width: int, cell: tuple[str, ...] = CELL) -> DataFrame:
    """Copies folded into a count before anything is shuffled whole."""
    bin_ = ((F.col("ts_ms") - F.pmod("ts_ms", F.lit(width))) / width).cast("bigint")
    # Nulls are ruled out here and not left to each join to infer: the five uses of this
    # frame then stay identical, and Spark runs its shuffle once and reuses it.
    return (
        rows.filter(F.col("ts_ms").isNotNull())
        .groupBy("entity", *cell[1:], "event_id", "ts_ms")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("bin", F.coalesce(bin_, F.lit(0)))
    )


def _pieces(chunk: int) -> Column:
    """How many pieces of at most ``chunk`` copies a folded row is cut into."""
    return F.ceil(F.col("copies") / chunk)


def _cells(rows: DataFrame, chunk: int, cell: tuple[str, ...] = CELL) -> DataFrame:
    return rows.groupBy("entity", *cell).agg(
        F.sum("copies").alias("n"), F.min("ts_ms").alias("first"), F.max("ts_ms").alias("last")
    )


def _links(cells: DataFrame, width: int, chunk: int, cell: tuple[str, ...] = CELL) -> DataFrame:
    """Cells that can pair, with the number of chunks each side of the link is cut into."""
    def side(name: str) -> DataFrame:
        return cells.select(
            "entity",
            *[F.col(c).alias(f"{name}_{c}") for c in (*cell, "first", "last")],
            F.ceil(F.col("n") / chunk).cast("int").alias(f"{name}_chunks"),
        )

    # A partner lies in the same or a neighbouring bin, so each right cell stands in three.
    near = side("b").withColumn(
        "a_bin", F.explode(F.array(*[F.col("b_bin") + d for d in (-1, 0, 1)]))
    )
    wanted = F.col(f"a_{FRESH}") | F.col(f"b_{FRESH}") if FRESH in cell else F.lit(True)
    return (
        side("a").join(near, ["entity", "a_bin"])
        .filter(wanted & (F.col("a_source") < F.col("b_source")))
        .filter((F.col("b_first") - F.col("a_last") <= width)
                & (F.col("a_first") - F.col("b_last") <= width))
        .select("entity", *(f"{s}_{c}" for s in "ab" for c in (*cell, "chunks")))
    )


def _copies(side: DataFrame, copies: str) -> DataFrame:
    """One row per copy. Copies multiply by the join itself: pairs are many more than the rows of
    its sides, so nothing is generated from a pair. Most rows are single, and no array is made for these."""
    several = F.array_repeat(F.lit(0), F.col(copies))
    one = F.when(F.col(copies) == 1, F.array(F.lit(0))).otherwise(several)
    return side.withColumn("_copy", F.explode(one)).drop("_copy", copies)


def _side(rows: DataFrame, links: DataFrame, me: str, chunk: int,
          cell: tuple[str, ...] = CELL) -> DataFrame:
    """Rows of one side of every link, placed in their own chunk and shown to each
    chunk of the other side."""
    other = "b" if me == "a" else "a"
    mine = rows.select(
        "entity", *[F.col(c).alias(f"{me}_{c}") for c in cell],
        F.col("event_id").alias(f"{me}_id"), F.col("ts_ms").alias(f"{me}_ts"),
        "copies", _pieces(chunk).alias("pieces"),
    )
    linked = mine.join(links, ["entity", *(f"{me}_{c}" for c in cell)])
    cut = linked.withColumn("piece", F.explode(F.sequence(F.lit(1), F.col("pieces"))))
    size = F.least(F.lit(chunk), F.col("copies") - (F.col("piece") - 1) * chunk).cast("int")
    block = F.pmod(F.xxhash64(f"{me}_id", f"{me}_ts", "piece"), F.col(f"{me}_chunks")).cast("int")
    return cut.select(
        "entity", *(f"{s}_{c}" for s in "ab" for c in cell), f"{me}_id", f"{me}_ts",
        size.alias(f"{me}_copies"), block.alias(f"{me}_block"),
        F.explode(F.sequence(F.lit(0), F.col(f"{other}_chunks") - 1)).alias(f"{other}_block"),
    )
