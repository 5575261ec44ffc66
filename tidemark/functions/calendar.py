"""Calendar dimension, event-to-week mapping, as-of frame and week lists.

The calendar is one row per day: ``calendar_date`` DATE, ``week`` INT in
``YYYYWW`` form (ISO year and ISO week) and ``month_of_year`` INT ``YYYYMM``
(the month holding the Thursday of that ISO week, so each week has exactly
one month and the distinct (week, month) dimension never fans out).

``IsoCalendar`` is that calendar without a range: week, month and as-of day are
expressions of the date, so no join is needed and no day is outside of it. A
calendar stored as a table is joined; it carries a broadcast hint only when its
row count was found small enough, else the join shuffles.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType

from tidemark import WEEK

CAL_DATE = "calendar_date"
MONTH = "month_of_year"
AS_OF = "as_of"

# Largest dimension that gets a broadcast hint; ~270 years of days.
BROADCAST_MAX_ROWS = 100_000


def iso_week_of(d: Column) -> Column:
    """ISO ``YYYYWW`` of a DATE column (ISO year is the year of the week's Thursday)."""
    thursday = F.date_add(d, 3 - F.weekday(d))
    return (F.year(thursday) * 100 + F.weekofyear(d)).cast("int")


def iso_month_of(d: Column) -> Column:
    thursday = F.date_add(d, 3 - F.weekday(d))
    return (F.year(thursday) * 100 + F.month(thursday)).cast("int")


def week_end(week: Column) -> Column:
    """Last day of an ISO ``YYYYWW`` week."""
    jan4 = F.make_date((week / 100).cast("int"), F.lit(1), F.lit(4))
    monday = F.date_sub(jan4, F.weekday(jan4))
    return F.date_add(monday, (week % 100 * 7 - 1).cast("int"))


def month_of_week(week: Column) -> Column:
    """``YYYYMM`` of the week's Thursday."""
    thursday = F.date_sub(week_end(week), 3)
    return (F.year(thursday) * 100 + F.month(thursday)).cast("int")


@dataclass(frozen=True)
class IsoCalendar:
    """Every day there is, by expression; ``weeks`` or the inclusive ``span`` limit it to those weeks."""

    weeks: tuple[int, ...] | None = None
    span: tuple[int, int] | None = None

    def holds(self, week: Column) -> Column:
        if self.weeks is not None:
            return week.isin(*self.weeks)
        return week.between(*self.span) if self.span is not None else week.isNotNull()

    def bounds(self) -> tuple[dt.date, dt.date] | None:
        """First and last day of the limited calendar; None without a limit."""
        weeks = list(self.weeks) if self.weeks is not None else list(self.span or ())
        return iso_week_bounds(weeks) if weeks else None


    def week_dimension(self, spark: SparkSession) -> None:
        """Month and as-of day are expressions of the week."""
        return None

    def week_of(self, day: Column) -> Column:
        return iso_week_of(day)


@dataclass(frozen=True)
class StoredCalendar:
    """A stored calendar whose weeks are whole runs of days: the sorted first days of its weeks with their labels.

    The week of a day is a binary search in that array, an expression like the ISO week, so mapping dates to weeks
    needs no join and no exchange. The labels may follow no formula. Days before the first week and after ``last`` have no week.
    ``stored_calendar`` makes one of a table, or tells that the table is not of this kind.
    """

    starts: tuple[dt.date, ...]
    labels: tuple[int, ...]
    months: tuple[int | None, ...]
    last: dt.date
    kept: tuple[int, ...] | None = None

    def limited(self, weeks: tuple[int, ...] | None, span: tuple[int, int] | None = None) -> StoredCalendar:
        """The calendar with only the given weeks, or those of the inclusive span of labels."""
        keep = weeks if weeks is not None else tuple(w for w in self.labels if span[0] <= w <= span[1]) if span is not None else None
        return replace(self, kept=keep)

    def holds(self, week: Column) -> Column:
        return week.isNotNull() if self.kept is None else week.isin(*self.kept)

    def ends(self) -> tuple[dt.date, ...]:
        return (*(d - dt.timedelta(days=1) for d in self.starts[1:]), self.last)

    def bounds(self) -> tuple[dt.date, dt.date] | None:
        if not self.kept:
            return None
        days = [(a, z) for a, z, w in zip(self.starts, self.ends(), self.labels) if w in set(self.kept)]
        return (min(a for a, _ in days), max(z for _, z in days)) if days else None

    def position(self, day: Column) -> Column:
        """Index of the last start on or before ``day``; -1 before the first. ``len(starts).bit_length()`` comparisons."""
        epoch = dt.date(1970, 1, 1)
        starts = F.lit([(d - epoch).days for d in self.starts])
        steps = F.lit([1 << i for i in reversed(range(len(self.starts).bit_length()))])
        number = F.unix_date(day)
        further = lambda at, step: F.coalesce((at + step < F.lit(len(self.starts))) & (F.get(starts, at + step) <= number), F.lit(False))
        return F.aggregate(steps, F.lit(-1), lambda at, step: F.when(further(at, step), at + step).otherwise(at))

    def week_of(self, day: Column) -> Column:
        return F.when((day >= F.lit(self.starts[0])) & (day <= F.lit(self.last)), F.get(F.lit(list(self.labels)), self.position(day)))

    def week_dimension(self, spark: SparkSession) -> DataFrame:
        """One row per week: (week, month_of_year, as_of)."""
        rows = list(zip(self.labels, self.months, self.ends()))
        return F.broadcast(spark.createDataFrame(rows, f"{WEEK} int, {MONTH} int, {AS_OF} date"))


def stored_calendar(days: DataFrame, max_weeks: int = 20_000) -> StoredCalendar | None:
    """The break points of a day table (``calendar_date``, week, ``month_of_year``), or None where it has to be joined.

    It has to be where a week's days are not one run, a day is missing between the first and the last, two rows
    give one day, a week has two months, or there are more than ``max_weeks`` weeks. One aggregate by week checks all of that; one row
    per week comes to the driver.
    """
    weeks = days.where(F.col(CAL_DATE).isNotNull() & F.col(WEEK).isNotNull()).groupBy(WEEK).agg(
        F.min(CAL_DATE).alias("a"), F.max(CAL_DATE).alias("z"), F.count("*").alias("n"), F.min(MONTH).alias("m"), F.max(MONTH).alias("m2"),
    )
    rows = weeks.limit(max_weeks + 1).collect()
    rows.sort(key=lambda r: r["a"])
    whole = all((r["z"] - r["a"]).days + 1 == r["n"] and r["m"] == r["m2"] for r in rows)
    tiled = all((b["a"] - a["z"]).days == 1 for a, b in zip(rows, rows[1:]))
    if not rows or len(rows) > max_weeks or not whole or not tiled:
        return None
    return StoredCalendar(tuple(r["a"] for r in rows), tuple(r[WEEK] for r in rows), tuple(r["m"] for r in rows), rows[-1]["z"])


def generate_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Day table of a range, for use like a stored calendar."""
    n_days = (end - start).days + 1
    if n_days <= 0:
        raise ValueError("the calendar's end is before its start")
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    days = spark.range(n_days).select(d.alias(CAL_DATE))
    days = days.select(CAL_DATE, iso_week_of(F.col(CAL_DATE)).alias(WEEK), iso_month_of(F.col(CAL_DATE)).alias(MONTH))
    return F.broadcast(days) if n_days <= BROADCAST_MAX_ROWS else days


def normalise_calendar(df: DataFrame, date_col: str, week_col: str, month_col: str | None = None) -> DataFrame:
    """Bring a stored calendar to the engine's types: DATE day, INT week (Q10).

    It is counted once; a calendar of at most ``BROADCAST_MAX_ROWS`` days gets a broadcast hint.
    """
    cols = [F.to_date(F.col(date_col)).alias(CAL_DATE), F.col(week_col).try_cast("int").alias(WEEK)]
    if month_col:
        cols.append(F.col(month_col).try_cast("int").alias(MONTH))
    out = df.select(*cols)
    return F.broadcast(out) if out.count() <= BROADCAST_MAX_ROWS else out


def map_to_week(df: DataFrame, date_expr: Column, calendar: DataFrame | IsoCalendar | StoredCalendar, keep_date: str | None = None) -> DataFrame:
    """Events with the week of their day.

    With an ``IsoCalendar`` or a ``StoredCalendar`` the week is computed and only the calendar's limit filters rows;
    with a stored calendar an inner join on the day drops days that it does not hold.
    A NULL date has no week and is dropped in both forms.
    """
    if not isinstance(calendar, DataFrame):
        day = F.to_date(date_expr)
        extra = [day.alias(keep_date)] if keep_date else []
        out = df.select(*[F.col(c) for c in df.columns if c != WEEK], calendar.week_of(day).alias(WEEK), *extra)
        return out.filter(calendar.holds(F.col(WEEK)))
    cal = calendar.select(F.col(CAL_DATE).alias("__cal_d"), F.col(WEEK).alias("__cal_w"))
    # One join on the computed day and one projection (few analysed steps).
    out = df.join(cal, F.to_date(date_expr) == F.col("__cal_d"), "inner")
    extra = [F.col("__cal_d").alias(keep_date)] if keep_date else []
    return out.select(*[F.col(c) for c in df.columns if c != WEEK], F.col("__cal_w").alias(WEEK), *extra)


def week_dimension(calendar: DataFrame) -> DataFrame:
    """One row per week of a stored calendar: (week, month_of_year, as_of = last day of the week) (C3, D-3)."""
    return calendar.groupBy(WEEK, MONTH).agg(F.max(CAL_DATE).alias(AS_OF))


def bounded_frame(df: DataFrame, name: str, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """A small frame several joins use: written once, counted, and given a broadcast hint if it is small."""
    from tidemark.session import materialize

    out = materialize(df, name)
    return F.broadcast(out) if out.count() <= max_rows else out


def as_of_frame(base: DataFrame, end_col: str = AS_OF) -> DataFrame:
    """(week, as_of) with as_of = max end date of the base in that week, never collected."""
    return base.groupBy(WEEK).agg(F.max(end_col).alias(AS_OF))


def week_list(df: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Distinct weeks, optionally within [lo, hi], ascending."""
    out = df.select(F.col(WEEK).cast("int").alias(WEEK)).distinct()
    if lo is not None:
        out = out.filter(F.col(WEEK) >= lo)
    if hi is not None:
        out = out.filter(F.col(WEEK) <= hi)
    return out.orderBy(WEEK)


def run_sequences(asof: DataFrame, lo: int, hi: int) -> DataFrame:
    """A10: (as-of date, week) pairs of weeks in [lo, hi], ascending, as text
    (``yyyy-MM-dd`` and ``YYYYWW``), the form a launcher passes to each run."""
    return (
        asof.filter(F.col(WEEK).between(lo, hi))
        .orderBy(WEEK)
        .select(F.date_format(AS_OF, "yyyy-MM-dd").alias(AS_OF), F.col(WEEK).cast("string").alias(WEEK))
    )


def iso_week_bounds(weeks: list[int]) -> tuple[dt.date, dt.date]:
    """Driver-side date range of a list of ISO weeks, for a raw-date scan filter.

    ``to_date(ts) = calendar_date`` is not a Parquet-pushable predicate; adding
    ``ts BETWEEN lo AND hi`` lets the scan skip row groups.
    """
    days = [dt.date.fromisocalendar(w // 100, 1, 1) + dt.timedelta(weeks=w % 100 - 1) for w in weeks]
    return min(days), max(days) + dt.timedelta(days=6)


def typed_day(day: dt.date, dtype: DataType) -> Column:
    """A literal of the column's own type for ``day`` at midnight, so a
    comparison stays on the raw column and can be pushed to the Parquet scan."""
    if isinstance(dtype, DateType):
        return F.lit(day)
    text = F.lit(day.isoformat() + " 00:00:00")
    if isinstance(dtype, TimestampNTZType):
        return text.cast("timestamp_ntz")
    return text.cast("timestamp")


def day_range(df: DataFrame, col: str, lo: dt.date | None, hi: dt.date | None) -> Column:
    """``lo <= col < hi + 1 day`` on the raw column (either bound optional)."""
    dtype = df.schema[col].dataType
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= typed_day(lo, dtype))
    if hi is not None:
        cond = cond & (F.col(col) < typed_day(hi + dt.timedelta(days=1), dtype))
    return cond
