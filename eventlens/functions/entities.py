"""Text -> entity arrays, as Column expressions that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the producers treat as white space, including the Unicode ones
# a bare \s leaves out in Java.
SPACE = r"\s\x{1c}-\x{1f}\x{85}\p{Z}"

# Upper-case words that look like tickers but are not.
STOP_WORDS = (
    "A", "AN", "THE", "AND", "OR", "BUT", "IF", "OF", "AT", "BY", "FOR",
    "IN", "ON", "TO", "FROM", "WITH", "IS", "ARE", "WAS", "WERE", "BE",
    "BEEN", "BEING", "HAVE", "HAS", "HAD", "DO", "DOES", "DID", "CAN",
    "COULD", "SHOULD", "WOULD", "WILL", "SHALL", "MAY", "MIGHT", "MUST",
    "NOT", "NO", "SO", "ALL", "ANY", "SOME", "MORE", "MOST", "OTHER",
    "INTO", "OVER", "AFTER", "THEN", "NOW", "JUST", "ALSO", "HOW", "OUT",
    "UP", "DOWN", "BUY", "SELL", "HOLD", "NEWS", "TODAY", "WEEK", "YEAR",
)

# The patterns an entity has to match.
CASHTAG = r"\$([A-Za-z]{1,5})(?![\p{L}\p{N}_])"
SYMBOL = r"[A-Z][A-Z.\-]{0,9}"
TICKER = r"[A-Z]{1,5}"
# Characters that may surround a bare ticker.
EDGE = r"""$.()\[\]"'"""


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def entity_text(payload: Column, fields: Sequence[str]) -> Column:
    """The named payload fields joined by a space; absent and null fields are skipped."""
    if not fields:
        return F.lit("")
    schema = "struct<" + ",".join(f"`{f}`:string" for f in fields) + ">"
    parsed = F.from_json(payload, schema)
    return F.concat_ws(" ", *[parsed.getField(f) for f in fields])


def cashtags(text: Column) -> Column:
    """``$aapl and $AAPL`` -> ``[AAPL]``: distinct, upper case, first seen first."""
    found = F.regexp_extract_all(text, F.lit(CASHTAG), F.lit(1))
    return F.coalesce(F.array_distinct(F.transform(found, F.upper)), _none())


def symbol_tokens(text: Column) -> Column:
    """White-space tokens that look like an exchange symbol (``BRK.B``)."""
    whole = f"(?<![^{SPACE}])({SYMBOL})(?![^{SPACE}])"
    found = F.regexp_extract_all(F.upper(text), F.lit(whole), F.lit(1))
    return F.coalesce(F.array_distinct(found), _none())


def tickers(text: Column) -> Column:
    """Cashtags when there are any, else bare ticker-like tokens minus stop words."""
    tags = cashtags(text)
    # One pass over the text: a token stands between separators, brackets and quotes aside.
    gap = f"{SPACE},;"
    whole = f"(?<![^{gap}])[{EDGE}]*+({TICKER})[{EDGE}]*+(?![^{gap}])"
    found = F.regexp_extract_all(F.upper(text), F.lit(whole), F.lit(1))
    bare = F.array_except(found, F.array(*[F.lit(w) for w in STOP_WORDS]))
    return F.coalesce(F.when(F.size(tags) > 0, tags).otherwise(bare), _none())


def normalize_entities(entities: Column) -> Column:
    """Stripped, non-blank, distinct, in first-seen order; null becomes an empty array."""
    kept = F.filter(F.transform(entities, strip), lambda e: e != "")
    return F.coalesce(F.array_distinct(kept), _none())


def _none() -> Column:
    return F.array().cast("array<string>")
