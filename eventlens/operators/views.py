"""What people see of events, pairs, stored rows and dead letters: to filter, to sort, to group.

A view is built from named fields. A field is sorted by its value and searched by its text; groups are
keys that a row belongs to, and can be searched, too. ``operators.filters`` has the filter language.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions import jsontext as J
from eventlens.functions.times import age, short_time
from eventlens.operators import filters


def _plain(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


class View:
    """Fields by name, in the order they are shown, each a value and its text; and groups by name.

    ``also`` gives fields a second name. The first field is the one to sort by.
    """

    def __init__(self, fields: Mapping[str, tuple[Column, Column]], groups: Mapping[str, Column],
                 also: Mapping[str, str] | None = None):
        self.values = {name: value for name, (value, _) in fields.items()}
        self.texts = {name: text for name, (_, text) in fields.items()}
        self.groups = dict(groups)
        self.also = dict(also or {})

    @cached_property
    def whole(self) -> Column:
        return F.concat_ws(" ", *self.texts.values())

    @cached_property
    def searched(self) -> dict[str, Column]:
        """Text by every name that a filter may use; fields come before groups of the same name."""
        by_group = {name: F.array_join(keys, " ") for name, keys in self.groups.items()}
        return by_group | {other: self.texts[name] for other, name in self.also.items()} | self.texts

    def text_of(self, field: str | None) -> Column:
        return self.whole if field is None else self.searched.get(field, F.lit(""))


def _fields(**values: Column) -> dict[str, tuple[Column, Column]]:
    """Fields that are searched as they are, behind the time that every view begins with."""
    ts_ms = F.col("ts_ms")
    return {"time": (ts_ms, short_time(ts_ms))} | {name: (v, _plain(v)) for name, v in values.items()}


def stream_view() -> View:
    """Over a decoded feed."""
    c = F.col
    return View(
        _fields(source=c("source"), entity=F.array_join("entities", " "), summary=c("summary"),
                offset=F.concat_ws("@", "topic", c("offset").cast("string"))),
        {"source": F.array("source"), "topic": F.array("topic"),
         "entity": F.when(F.size("entities") > 0, c("entities")).otherwise(F.array(F.lit("(none)"))),
         "day": F.array(F.substring(short_time(c("ts_ms")), 1, 5))},
        {"entities": "entity", "topic@off": "offset"})


def pairs_view() -> View:
    """Over resolved pairs."""
    c = F.col
    pair = J.pair_label(c("a_id"), c("b_id"))
    gap = c("gap_ms")
    return View(
        _fields(entity=c("entity"), pair=pair, a=c("a"), b=c("b")) | {"gap": (gap, F.coalesce(age(gap), F.lit("-")))},
        {"entity": F.array("entity"), "pair": F.array(pair), "day": F.array(c("dt").cast("string"))},
        {"Δt": "gap"})


def stored_view() -> View:
    """Over stored raw rows: all of them (``stored``) or the newest (``store_view``)."""
    dt = F.col("dt").cast("string")
    return View(_fields(source=F.col("source"), dt=dt, summary=F.col("summary")),
                {"source": F.array("source"), "dt": F.array(dt)})


def dlq_view() -> View:
    """Over the dead-letter rows of a decoded feed."""
    error = F.coalesce(F.nullif("error", F.lit("")), F.lit("-"))
    return View(_fields(topic=F.col("topic"), error=error, summary=F.col("summary")),
                {"topic": F.array("topic"), "error": F.array(J.error_class(F.col("error")))})


def _of_day(part: str) -> Column | None:
    """What follows for the date of a row whose time, shown as month-day and clock, has ``part`` in it."""
    before, dash, behind = part.partition("-")
    if not dash:
        return None  # a piece of the clock, or of one number: any day may have it
    day = F.coalesce(F.date_format(F.col("dt").cast("date"), "MM-dd"), F.lit("-"))
    return F.contains(day, F.lit(f"{before[-2:]}-{behind[:2].rstrip()}"))


def where_text(df: DataFrame, query: str, view: View) -> DataFrame:
    """The rows that a filter text leaves.

    ``source:`` and ``dt:`` terms are conditions on those columns alone, and ``time:`` and ``day:`` terms
    that name a day are turned into one on ``dt`` where rows have it: Spark then opens only such folders.
    """
    terms = filters.parse(query)
    found = df.filter(filters.compiled(terms, view.text_of))
    return found.filter(filters.implied(terms, {"time": _of_day})) if "dt" in df.columns else found


def order_view(df: DataFrame, view: View, key: str | None = None, desc: bool = True) -> DataFrame:
    """Sorted by a field. Missing values come last ascending and first descending.

    Equal values are ordered by the texts of the other fields, which also lets the sort spread a value
    that many rows share over tasks.
    """
    name = view.also.get(key, key)
    if name not in view.values:
        name = next(iter(view.values))
    value = view.values[name]
    order = value.desc_nulls_first() if desc else value.asc_nulls_last()
    return df.orderBy(order, *(text for other, text in view.texts.items() if other != name))


def group_view(df: DataFrame, view: View, key: str) -> DataFrame:
    """How many rows each key of a group has, most first, then by key; a row may have several."""
    counted = df.select(F.explode(view.groups[key]).alias("group_key")).groupBy("group_key")
    return counted.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "group_key")


def resolve_pairs(pairs: DataFrame, events: DataFrame) -> DataFrame:
    """Pairs with both summaries (the id where the event is unknown) and the time gap.

    ``events`` has one row per ``event_id``, as ``last_by_id`` returns it.
    """
    def known(side: str) -> DataFrame:
        # All events: what their files take says little of what they take in memory, so they are merged
        # by id, as the aggregation has sorted them, and never collected for a broadcast.
        return events.select(F.col("event_id").alias(f"{side}_id"),
                             F.col("summary").alias(f"_{side}_text"),
                             F.col("ts_ms").alias(f"_{side}_ms")).hint("merge")

    joined = pairs.join(known("a"), "a_id", "left").join(known("b"), "b_id", "left")
    return joined.select(
        *pairs.columns,
        F.coalesce("_a_text", "a_id").alias("a"),
        F.coalesce("_b_text", "b_id").alias("b"),
        F.abs(F.col("_a_ms") - F.col("_b_ms")).alias("gap_ms"),
    )
