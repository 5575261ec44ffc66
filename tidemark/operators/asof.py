"""Latest-as-of join (B5 + E2): for each (account, week) of a spine, the row
of a history table that is latest by an ordering key among rows dated on or
before the week's as-of day.

Plan: (1) place each history row in the first week whose as-of day is not before
its date; (2) partial aggregate the history to one struct per (account,
week) — a hot account shrinks to at most one row per week before
any shuffle; (3) union with the spine keys; (4) a running ``max`` over the
account's weeks. Step 4 partitions by account, but each account holds at most
(#history weeks + #spine weeks) rows, bounded by the calendar, not by the
account's raw row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import ACCOUNT, WEEK
from tidemark.functions.calendar import AS_OF


def place_as_of(df: DataFrame, date: Column, asof: DataFrame, week: str = WEEK, as_of: str = AS_OF) -> DataFrame:
    """``df`` with the first week whose as-of day is on or after ``date``.

    ``asof`` is one row per week with as-of days that rise with the week. Each week stands for the days after
    the as-of day before it; the first also for all earlier ones. Rows dated after every as-of day belong to no week.
    The join is an equality on the day, with one row per day between the first and the last as-of day.
    """
    before = F.lag(as_of).over(Window.orderBy(as_of))  # one row per week
    first = asof.agg(F.min(as_of).alias("__first"))
    days = asof.select(week, as_of, before.alias("__before"))
    days = days.select(F.col(week).alias("__week"), F.explode(F.sequence(F.coalesce(F.date_add("__before", 1), F.col(as_of)), F.col(as_of))).alias("__day"))
    placed = df.withColumn("__date", F.to_date(date)).where(F.col("__date").isNotNull())
    placed = placed.withColumn("__date", F.greatest(F.col("__date"), first.scalar()))
    out = placed.join(days, F.col("__date") == F.col("__day"))
    return out.select(*[F.col(c) for c in df.columns if c != week], F.col("__week").alias(week))


def _ranked(order: list[Column], values: list[str]) -> Column:
    return F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *[F.col(v) for v in values])


def as_of_state(
    history: DataFrame, order: list[Column], values: list[str], state: DataFrame | None = None, account: str = ACCOUNT
) -> DataFrame:
    """(account, latest): one row per account, the latest row of ``history`` and of an earlier ``state``.

    A stored state stands for all rows that went into it: rolling it forward reads only newer rows, and ``latest_as_of``
    continues from it. It has one row per account, however long the history.
    """
    rows = history.select(account, _ranked(order, values).alias("latest"))
    if state is not None:
        rows = rows.unionByName(state.select(account, "latest"))
    return rows.groupBy(account).agg(F.max("latest").alias("latest"))


def latest_as_of(
    history: DataFrame,
    spine_keys: DataFrame,
    order: list[Column],
    values: list[str],
    account: str = ACCOUNT,
    week: str = WEEK,
    state: DataFrame | None = None,
) -> DataFrame:
    """``history`` carries (account, week from ``place_as_of``, order cols…, values…).

    ``order`` must end with a unique tie-break; the chosen row is the maximum
    (``ORDER BY … DESC``, NULLs last). Output: spine keys that have a match,
    with ``values``. A ``state`` of ``as_of_state`` stands before every week, for the rows that ``history``
    then need not hold.
    """
    weekly = history.groupBy(account, week).agg(F.max(_ranked(order, values)).alias("__s")).withColumn("__spine", F.lit(0))
    if state is not None:
        before = state.select(account, F.lit(None).cast("int").alias(week), F.col("latest").alias("__s"), F.lit(0).alias("__spine"))
        weekly = weekly.unionByName(before)  # a NULL week sorts first
    spine = spine_keys.select(account, week).withColumn("__s", F.lit(None).cast(weekly.schema["__s"].dataType))
    spine = spine.withColumn("__spine", F.lit(1))
    w = Window.partitionBy(account).orderBy(week, "__spine").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = weekly.unionByName(spine).withColumn("__run", F.max("__s").over(w))
    return both.filter((F.col("__spine") == 1) & F.col("__run").isNotNull()).select(
        account, week, *[F.col(f"__run.{v}").alias(v) for v in values]
    )
