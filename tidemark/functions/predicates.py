"""Row predicates with the reference's NULL semantics spelled out."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: the missing-account sentinel of the source system.
MISSING_ACCOUNT = "?"


def valid_key(df: DataFrame, col: str) -> Column:
    """Key is not NULL and, for string keys, not the '?' sentinel.

    A numeric key is only NULL-checked: comparing it with '?' would raise
    under ANSI casting.
    """
    c = F.col(col)
    if isinstance(df.schema[col].dataType, StringType):
        return c.isNotNull() & (c != F.lit(MISSING_ACCOUNT))
    return c.isNotNull()


def not_like(col: str | Column, patterns: list[str], match: str = "any") -> Column:
    """``NOT LIKE`` over several patterns.

    ``match='any'`` is the reference as written (OR of NOT LIKE: true unless the
    value contains every pattern); ``match='all'`` is the evidently intended AND.
    NULL input gives NULL, so the row is rejected in both modes.
    """
    c = F.col(col) if isinstance(col, str) else col
    terms = [~c.like(p) for p in patterns]
    if match == "any":
        return reduce(or_, terms)
    if match == "all":
        return reduce(and_, terms)
    raise ValueError(f"match must be 'any' or 'all', not {match!r}")


def not_in(col: str | Column, values: list) -> Column:
    """``NOT IN``; NULL input is rejected (three-valued logic)."""
    c = F.col(col) if isinstance(col, str) else col
    return ~c.isin(*values)


def present_or_not_blank(col: str | Column, blanks: list[str], pattern: str, match: str = "any") -> Column:
    """``x IS NOT NULL OR x NOT IN blanks OR x NOT LIKE pattern``.

    As coded (``any``) this reduces to ``x IS NOT NULL``; ``all`` gives the AND.
    """
    c = F.col(col) if isinstance(col, str) else col
    terms = [c.isNotNull(), ~c.isin(*blanks), ~c.like(pattern)]
    return reduce(or_, terms) if match == "any" else reduce(and_, terms)
