"""H1: a wide base as a declarative column map, compiled into one projection.

A weekly base has some 190 columns, most taken over, some cleaned of currency signs or code prefixes and cast, some contract
dates in text of several formats. Each is one ``Rule`` of the map; the whole map is one
``select``, so the scan reads the sources of the map and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.shape import clean_name, strip_cast


def quoted(name: str) -> Column:
    """A top-level column whose name may hold dots or backquotes."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class Rule:
    """``target`` from ``source``: ``keep`` as it is, ``strip`` matches of ``arg`` and cast to ``to``, read a ``date`` of
    format ``arg``, or ``lower`` case. Bad text becomes NULL."""

    target: str
    source: str
    how: str = "keep"
    arg: str = ""
    to: str = "bigint"

    def column(self) -> Column:
        c = F.col(self.source)
        made = {
            "keep": lambda: c,
            "strip": lambda: strip_cast(c, self.arg, self.to),
            "date": lambda: F.try_to_date(c.cast("string"), self.arg),
            "lower": lambda: F.lower(c),
        }
        if self.how not in made:
            raise ValueError(f"rule {self.how!r} of {self.target!r} is not one of {sorted(made)}")
        return made[self.how]().alias(self.target)


def apply_map(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The columns of the map, in its order. All missing sources and clashing targets are named in one error."""
    missing = sorted({r.source for r in rules} - set(df.columns))
    if missing:
        raise ValueError(f"sources of the column map are missing: {missing}")
    names = [clean_name(r.target) for r in rules]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"targets of the column map clash: {twice}")
    return df.select(*[r.column() for r in rules])
