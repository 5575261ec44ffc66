"""Data-quality profiles of a mart (J1-J4), one job each regardless of width.

The reference runs one warehouse query per column; here all columns are
unpivoted and profiled together by narrow aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
)

from tidemark import ACCOUNT, WEEK

# Types whose maximum and minimum Parquet footers hold exactly; fractions are left out because of NaN.
_FOOTER = (ByteType, ShortType, IntegerType, LongType, DateType)
_NUMERIC = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)


def classify_columns(df: DataFrame, exclude: tuple[str, ...] = (ACCOUNT, WEEK)) -> tuple[list[str], list[str]]:
    """(discrete = STRING columns, continuous = numeric columns), minus ``exclude``."""
    discrete = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]
    continuous = [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]
    return discrete, continuous


def discrete_profile(df: DataFrame, cols: list[str], week: str = WEEK) -> DataFrame:
    """J2/D-14/Q12: one row per (column, week, distinct value) with the number of
    categories of that column and week (NULL counted as one and listed as a NULL value).

    The (week, column, value) triples are de-duplicated on the executors and
    counted by a plain aggregate; a column of any number of values stays rows and
    is never gathered into one list.
    """
    long = df.select(
        F.col(week).alias(week),
        F.explode(F.array(*[F.struct(F.lit(c).alias("colname"), F.col(c).cast("string").alias("v")) for c in cols])).alias("p"),
    ).select(week, "p.colname", F.col("p.v").alias("unique_value"))
    distinct = long.distinct()
    counts = distinct.groupBy("colname", week).agg(F.count(F.lit(1)).alias("number_of_categories"))
    return distinct.join(counts, ["colname", week]).select("colname", week, "unique_value", "number_of_categories")


def continuous_profile(df: DataFrame, cols: list[str], week: str = WEEK) -> DataFrame:
    """J3/D-13: max, min, mean and sample stddev per (column, week), long form.

    The columns are unpivoted to (column, week, value) rows, of values that are not NULL alone and with the column's place for its
    name, and reduced by one narrow aggregate, so generated code stays small however many columns there are and a sparse
    column costs what it holds. A column without values in a week has a row of NULLs. DECIMAL
    columns of one type keep it; others are read as DOUBLE.
    """
    types = {df.schema[c].dataType for c in cols}
    exact = len(types) == 1 and isinstance(next(iter(types)), DecimalType)
    value = (lambda c: F.col(c)) if exact else (lambda c: F.col(c).cast("double"))
    values = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), value(c).alias("x")) for i, c in enumerate(cols)]), lambda p: p["x"].isNotNull())
    long = df.select(F.col(week).alias("own_week"), F.explode(values).alias("p")).select("p.i", "own_week", "p.x")
    found = long.groupBy("i", "own_week").agg(
        F.max("x").alias("maximum_value"), F.min("x").alias("minimum_value"), F.avg("x").alias("mean_value"), F.stddev_samp("x").alias("standard_deviation")
    )
    slots = df.select(week).distinct().select(week, F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("slot", "colname"))
    out = slots.join(found, (F.col("slot") == F.col("i")) & F.col(week).eqNullSafe(F.col("own_week")), "left")
    return out.select("colname", week, "maximum_value", "minimum_value", "mean_value", "standard_deviation")


def stamp(df: DataFrame, column: str = "created_dt") -> DataFrame:
    """Run timestamp column as the reference's profiles carry it."""
    return df.withColumn(column, F.current_timestamp())


def append_profile(df: DataFrame, path: str, week: str = WEEK) -> None:
    """Append to the profile history. A run's profile is small, so it becomes a few files of about the advised size,
    sorted by week for row-group skipping, and not a folder for each week."""
    df.hint("rebalance").sortWithinPartitions(week).write.mode("append").parquet(path)


def continuous_state(df: DataFrame, cols: list[str], week: str = WEEK) -> DataFrame:
    """Mergeable profile of numeric columns: one row (colname, week, n, mean, m2, low, high) per column and week.

    ``m2`` is the sum of squared distances from the mean; ``n`` counts values that are not NULL.
    """
    long = df.select(week, F.explode(F.array(*[F.struct(F.lit(c).alias("colname"), F.col(c).cast("double").alias("x")) for c in cols])).alias("p"))
    return long.groupBy(F.col("p.colname").alias("colname"), week).agg(
        F.count("p.x").alias("n"), F.avg("p.x").alias("mean"), (F.var_pop("p.x") * F.count("p.x")).alias("m2"), F.min("p.x").alias("low"), F.max("p.x").alias("high")
    )


def merge_continuous(states: DataFrame, by: list[str]) -> DataFrame:
    """The profile of each group ``by`` from states: that of all rows behind them, without reading those.

    Means are weighted by their counts, and the distances of the parts' means from the whole mean join the sums of squares, so
    nothing cancels. States of any weeks, in any number and order, give the same.
    """
    held = states.where("n > 0")
    means = held.groupBy(*by).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean_value"))
    far = F.col("m2") + F.col("n") * (F.col("mean") - F.col("mean_value")) ** 2
    return held.join(means, by).groupBy(*by).agg(
        F.sum("n").alias("n_values"), F.max("high").alias("maximum_value"), F.min("low").alias("minimum_value"), F.first("mean_value").alias("mean_value"),
        F.sqrt(F.sum(far) / F.nullif(F.sum("n") - 1, F.lit(0))).alias("standard_deviation"),
    )


def discrete_state(df: DataFrame, cols: list[str], week: str = WEEK) -> DataFrame:
    """Mergeable profile of text columns: (colname, week, unique_value, n_rows), exact, one row per value (NULL is one)."""
    long = df.select(week, F.explode(F.array(*[F.struct(F.lit(c).alias("colname"), F.col(c).cast("string").alias("v")) for c in cols])).alias("p"))
    return long.groupBy(F.col("p.colname").alias("colname"), week, F.col("p.v").alias("unique_value")).agg(F.count("*").alias("n_rows"))


def merge_discrete(states: DataFrame, by: list[str]) -> DataFrame:
    """(by…, unique_value, n_rows, number_of_categories) of all rows behind the states."""
    values = states.groupBy(*by, "unique_value").agg(F.sum("n_rows").alias("n_rows"))
    counts = values.groupBy(*by).agg(F.count("*").alias("number_of_categories"))
    return values.join(counts, by)


def distinct_sketch(df: DataFrame, cols: list[str], week: str = WEEK) -> DataFrame:
    """(colname, week, sketch): a HyperLogLog sketch of each column's values, of fixed size however many there are."""
    long = df.select(week, F.explode(F.array(*[F.struct(F.lit(c).alias("colname"), F.col(c).cast("string").alias("v")) for c in cols])).alias("p"))
    return long.groupBy(F.col("p.colname").alias("colname"), week).agg(F.hll_sketch_agg("p.v").alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by…, about) the estimated number of distinct values over the merged sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))


def stored_ranges(spark: SparkSession, path: str, cols: list[str], week: str = WEEK) -> DataFrame:
    """J3/A7 on a written mart: (colname, week, n_rows, n_values, minimum_value, maximum_value) per column and week, from the footers of its Parquet files.

    ``path`` is a table in folders by ``week``. Counts always come from the footers, so does the range of a whole-number or date column
    without NULLs; no page of those columns is read. A column with NULLs has its range scanned, because a row group of NULLs alone has none in its
    footer; so has one of another type. Values are text. A column that is NULL throughout a week has a NULL range; an empty list of columns gives no rows.
    The plan is made in a session of its own, whose Parquet source takes aggregates.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = own.read.parquet(path)
    own.conf.unset("spark.sql.sources.useV1SourceList")
    scanned = own.read.parquet(path)  # an ordinary scan, to which no aggregate is pushed
    if not cols:
        return table.select(F.lit("").alias("colname"), week, *[F.lit(0).cast(t).alias(n) for n, t in _RANGE_FIELDS]).where(F.lit(False))
    tag = {c: f"c{i}" for i, c in enumerate(cols)}
    counts = table.groupBy(week).agg(F.count("*").alias("n_rows"), *[F.count(c).alias(f"{tag[c]}_n") for c in cols])
    holes = counts.agg(*[F.coalesce(F.bool_or(F.col(f"{tag[c]}_n") < F.col("n_rows")), F.lit(False)).alias(tag[c]) for c in cols]).first()
    kept = [c for c in cols if isinstance(table.schema[c].dataType, _FOOTER) and not holes[tag[c]]]
    ends = lambda cs: [f(c).alias(f"{tag[c]}_{e}") for c in cs for e, f in (("lo", F.min), ("hi", F.max))]
    wide = counts
    for source, part in ((table, kept), (scanned, [c for c in cols if c not in kept])):
        if part:
            wide = wide.join(source.groupBy(week).agg(*ends(part)).withColumnRenamed(week, "own_week"), F.col(week).eqNullSafe(F.col("own_week"))).drop("own_week")
    row = lambda c: F.struct(
        F.lit(c).alias("colname"), F.col(week), F.col("n_rows"), F.col(f"{tag[c]}_n").alias("n_values"),
        F.col(f"{tag[c]}_lo").cast("string").alias("minimum_value"), F.col(f"{tag[c]}_hi").cast("string").alias("maximum_value"),
    )
    return wide.select(F.explode(F.array(*[row(c) for c in cols])).alias("r")).select("r.*")


_RANGE_FIELDS = (("n_rows", "bigint"), ("n_values", "bigint"), ("minimum_value", "string"), ("maximum_value", "string"))
