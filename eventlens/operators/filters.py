"""The filter language of the views: a text, the expression it stands for, and Columns made from it.

Terms are set apart by white space and all have to hold. ``name:words`` looks in one field, other
terms look in the whole row, and a leading ``-`` turns a term round. A field holds a term if its text has
it as a part, whatever the case; a field that a view does not have is empty.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

_TERM = re.compile(r"(?P<turned>-(?=.))?(?:(?P<field>[^:]+):)?(?P<part>.*)", re.DOTALL)


class Holds(NamedTuple):
    """A field's text, or that of the whole row (no field), has ``part`` in it."""

    field: str | None
    part: str


class Turned(NamedTuple):
    """The opposite of a term."""

    term: Holds


Filter = tuple[Holds | Turned, ...]


def parse(text: str) -> Filter:
    """The terms of a filter text, in order."""
    out = []
    for word in text.lower().split():
        found = _TERM.fullmatch(word)
        term = Holds(found["field"], found["part"])
        out.append(Turned(term) if found["turned"] else term)
    return tuple(out)


def compiled(terms: Filter, text_of: Callable[[str | None], Column]) -> Column:
    """A condition for rows; ``text_of`` gives the text of a field, and of the row for none."""
    def one(term: Holds | Turned) -> Column:
        if isinstance(term, Turned):
            return ~one(term.term)
        return F.contains(F.lower(text_of(term.field)), F.lit(term.part))

    return reduce(Column.__and__, map(one, terms), F.lit(True))


def implied(terms: Filter, by_field: Mapping[str, Callable[[str], Column | None]]) -> Column:
    """What follows for other columns, such as those a sink is partitioned by.

    ``by_field`` says for a field and a part what every row that holds it satisfies. Nothing is
    concluded from terms that are turned round or look in the whole row.
    """
    found = [by_field[t.field](t.part) for t in terms if isinstance(t, Holds) and t.field in by_field]
    return reduce(Column.__and__, [c for c in found if c is not None], F.lit(True))
