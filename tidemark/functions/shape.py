"""Reshaping in single projections: casts, name cleaning, prefixes, durations.

Every helper builds one ``select`` rather than a loop of ``withColumn`` calls,
so a plan over hundreds of columns stays one projection.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

# Name parts of the base's look-ahead outcome columns (they
# describe the 7 days after the week and are labels, not features).
LOOKAHEAD_NAME_PARTS = ("_in_next_7d", "_next_7d_")

# A column is a date candidate when its lower-case name holds one
# of these substrings (F6), and gets a companion column with this suffix.
DATE_NAME_PARTS = ("_dt_actual", "_date", "_modified_dt", "start_dt")
DURATION_SUFFIX = "_duration_days"

_NOT_WORD = re.compile(r"[^\w_]")


def strip_cast(col: str | Column, pattern: str, to: str = "bigint") -> Column:
    """G1+G2/Q8: remove every match of ``pattern``, then ``try_cast`` (bad input → NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, pattern, "").try_cast(to)


def clean_name(name: str) -> str:
    """F5 rule: drop characters outside ``[\\w_]``, lower-case."""
    return _NOT_WORD.sub("", name).lower()


def clean_names(df: DataFrame) -> DataFrame:
    """F5 for all columns at once; two names that clean to one raise (Q9)."""
    seen: dict[str, str] = {}
    for c in df.columns:
        k = clean_name(c)
        if k in seen:
            raise ValueError(f"columns {seen[k]!r} and {c!r} both clean to {k!r}")
        seen[k] = c
    return df.toDF(*[clean_name(c) for c in df.columns])


def parse_dates(df: DataFrame, cols: list[str], fmt: str) -> DataFrame:
    """Text columns as DATE by an explicit format; ill-formed text becomes NULL."""
    wanted = set(cols)
    return df.select(*[F.try_to_date(F.col(c), fmt).alias(c) if c in wanted else F.col(c) for c in df.columns])


def is_date_name(name: str) -> bool:
    low = name.lower()
    return any(p in low for p in DATE_NAME_PARTS)


def add_durations(df: DataFrame, as_of: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """For date-named columns of date, timestamp or string type, cast the
    column to DATE in place and add ``<c>_duration_days = datediff(c, as_of)``
    (positive when c is after the as-of date). One projection.
    """
    out: list[Column] = []
    extra: list[Column] = []
    for f in df.schema.fields:
        c = f.name
        dtype = f.dataType
        eligible = (
            c not in exclude
            and c != as_of
            and is_date_name(c)
            and not c.lower().endswith(DURATION_SUFFIX)
            and isinstance(dtype, (DateType, TimestampType, TimestampNTZType, StringType))
        )
        if not eligible:
            out.append(F.col(c))
            continue
        as_date = F.try_to_date(F.col(c)) if isinstance(dtype, StringType) else F.to_date(F.col(c))
        out.append(as_date.alias(c))
        extra.append(F.datediff(as_date, F.col(as_of)).alias(c + DURATION_SUFFIX))
    return df.select(*out, *extra)


def drop_raw_dates(df: DataFrame) -> DataFrame:
    """Keep non-date columns plus the ``*_duration_days`` columns."""
    keep = [c for c in df.columns if not is_date_name(c) or c.lower().endswith(DURATION_SUFFIX)]
    return df.select(*keep)


def normalise_values(col: str | Column, mapping: dict[str, str]) -> Column:
    """``CASE WHEN x = a THEN b …`` ELSE x; unmapped values pass unchanged."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for src, dst in mapping.items():
        expr = F.when(c == F.lit(src), F.lit(dst)) if expr is None else expr.when(c == F.lit(src), F.lit(dst))
    return c if expr is None else expr.otherwise(c)


def lookahead_columns(df: DataFrame) -> list[str]:
    """Names of look-ahead outcome columns; they pass through unchanged, and a
    model trainer must treat them as labels."""
    return [c for c in df.columns if any(p in c.lower() for p in LOOKAHEAD_NAME_PARTS)]


def fill_strings(df: DataFrame, value: str = "None") -> DataFrame:
    """F8: NULL of every string column replaced by ``value`` (the reference's
    ``na.fill('None')``; offered, not applied by any block)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.na.fill(value, subset=cols) if cols else df
