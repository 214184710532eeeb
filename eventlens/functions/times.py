"""Epoch-millisecond arithmetic and the time texts shown to people (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
# 0001-01-01 .. 9999-12-31; a value outside overflows timestamp arithmetic.
MIN_TS_MS = -62_135_596_800_000
MAX_TS_MS = 253_402_300_799_999


def event_time(ts_ms: Column) -> Column:
    return F.timestamp_millis(ts_ms)


def event_date(ts_ms: Column) -> Column:
    """UTC calendar date of an epoch-millisecond value, whatever the session time zone."""
    return F.date_from_unix_date(_div(ts_ms, DAY_MS).cast("int"))


def bounded(ts_ms: Column) -> Column:
    """The time if a timestamp can hold it, else null."""
    return F.when(ts_ms.between(MIN_TS_MS, MAX_TS_MS), ts_ms)


def isotime(ts_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(bounded(ts_ms)), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def short_time(ts_ms: Column) -> Column:
    """``MM-DD HH:MM:SS``, or ``-`` without a time."""
    shown = F.date_format(F.timestamp_millis(bounded(ts_ms)), "MM-dd HH:mm:ss")
    return F.coalesce(shown, F.lit("-"))


def age(ms: Column) -> Column:
    """How long ago, in the largest whole unit: now, 59s, 4m, 23h, 2d."""
    def whole(unit: int, suffix: str) -> Column:
        return F.concat(_div(ms, unit).cast("string"), F.lit(suffix))

    return (
        F.when(ms < 1_000, F.lit("now"))
        .when(ms >= DAY_MS, whole(DAY_MS, "d"))
        .when(ms >= 3_600_000, whole(3_600_000, "h"))
        .when(ms >= 60_000, whole(60_000, "m"))
        .otherwise(whole(1_000, "s"))
    )


def interval_seconds(text: Column) -> Column:
    """Seconds of ``60s`` / ``5m`` / ``1h``; null for anything else."""
    number = F.regexp_extract(text, r"^(\d+)[smh]$", 1)
    scale = (
        F.when(F.endswith(text, F.lit("s")), 1)
        .when(F.endswith(text, F.lit("m")), 60)
        .when(F.endswith(text, F.lit("h")), 3600)
    )
    return F.when(number != "", number.try_cast("bigint") * scale)


def rfc2822_ms(text: Column) -> Column:
    """Epoch milliseconds of a mail/RSS date; null when it is missing or malformed."""
    # Zone names of RFC 2822 and their offsets.
    zones = {
        "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
        "AST": "-0400", "ADT": "-0300", "EST": "-0500", "EDT": "-0400",
        "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600",
        "PST": "-0800", "PDT": "-0700",
    }
    # Spark refuses to parse weekday names and reads zone names as regions with
    # daylight saving, so drop the former and turn the latter into offsets.
    body = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9},\s*", "")
    body = F.regexp_replace(body, r"\s+", " ")
    body = F.regexp_replace(body, r"^(\d{1,2} [A-Za-z]{3}) ([0-6]\d) ", "$1 20$2 ")
    body = F.regexp_replace(body, r"^(\d{1,2} [A-Za-z]{3}) ([7-9]\d) ", "$1 19$2 ")
    zone = F.upper(F.regexp_extract(body, r" ([A-Za-z]{1,3})$", 1))
    offset = F.create_map(*[F.lit(x) for pair in zones.items() for x in pair])
    body = F.when(
        zone != "",
        F.concat(F.regexp_replace(body, r" [A-Za-z]{1,3}$", " "),
                 F.coalesce(F.try_element_at(offset, zone), F.lit("+0000"))),
    ).otherwise(body)
    body = F.regexp_replace(body, r"^(\d{1,2} \S+ \d{4} \d{1,2}:\d{2}(:\d{2})?)$", "$1 +0000")
    month = F.initcap(F.regexp_extract(body, r"^\d{1,2} ([A-Za-z]{3}) ", 1))
    body = F.concat(F.regexp_extract(body, r"^(\d{1,2}) ", 1), F.lit(" "), month,
                    F.regexp_extract(body, r"^\d{1,2} [A-Za-z]{3}( .*)$", 1))
    return F.unix_millis(F.try_to_timestamp(body, F.lit("d MMM yyyy H:mm[:ss] Z")))


def _div(value: Column, unit: int) -> Column:
    """Floor division of a long, exact for negative values too."""
    whole = value.cast("bigint")
    return ((whole - F.pmod(whole, F.lit(unit))) / unit).cast("bigint")
