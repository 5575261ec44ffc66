"""A3/A4: sharded text sources that are not clean: broken lines, missing columns, columns of differing types.

A declared schema names the columns with the narrowest type each may have. Every shard is read once in permissive
mode as text fields: a line that is no JSON object goes to the quarantine with its file, a column that a shard
lacks is NULL. A column then gets the first type of its lattice, from the declared one on, that holds all of its values over all
shards; the last type, ``string``, always does. So one shard with ``12.5`` widens an INT column to DOUBLE, and no value becomes
NULL, loses its time of day or a digit of a whole number by a cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.session import materialize

#: Types from narrow to wide; each holds the values of those before it.
LATTICES = (("int", "bigint", "double", "string"), ("date", "timestamp", "string"), ("boolean", "string"))
_LINE, _FILE = "__line", "__file"


def wider(declared: str) -> tuple[str, ...]:
    """The declared type and those that may take its place, in order."""
    for lattice in LATTICES:
        if declared in lattice:
            return lattice[lattice.index(declared) :]
    raise ValueError(f"no lattice holds the type {declared!r}")


def _holds(col: str, kind: str) -> Column:
    """The text is NULL or a value of the type: a DATE without a time of day, a DOUBLE that keeps a whole number exact."""
    c = F.col(col)
    fits = c.try_cast(kind).isNotNull()
    if kind == "date":
        fits = fits & (c.try_cast("date").cast("timestamp") == c.try_cast("timestamp"))
    if kind == "double":
        fits = fits & (F.abs(F.coalesce(c.try_cast("decimal(38,0)"), F.lit(0))) <= F.lit(1 << 53))
    return c.isNull() | F.coalesce(fits, F.lit(False))


def widen(df: DataFrame, declared: dict[str, str]) -> dict[str, str]:
    """The type of each text column: the first of its lattice that holds every value. One aggregate for all columns."""
    tries = {(c, t): wider(k)[:-1] for c, k in declared.items() for t in wider(k)[:-1]}
    aggs = [F.bool_and(_holds(c, t)).alias(f"{c}\x1f{t}") for c, t in tries]
    found = df.agg(*aggs).first() if aggs else None
    out = {}
    for c, k in declared.items():
        out[c] = next((t for t in wider(k)[:-1] if found[f"{c}\x1f{t}"] is not False), wider(k)[-1])
    return out


def read_json_shards(spark: SparkSession, path: str, declared: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of newline-delimited JSON shards under ``path`` (a folder or glob).

    ``rows`` has the declared columns, typed by ``widen``. ``quarantine`` has a row (file, line) for every line that is no JSON
    object. Both are read from one written copy, so each shard is parsed once. Empty lines are neither.
    """
    if {c.lower() for c in declared} & {_LINE, _FILE}:
        raise ValueError(f"the columns {_LINE} and {_FILE} are used by the reader")
    schema = StructType([*(StructField(c, StringType()) for c in declared), StructField(_LINE, StringType())])
    raw = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).json(path)
    raw = materialize(raw.withColumn(_FILE, F.input_file_name()), "shards")
    bad = raw.where(F.col(_LINE).isNotNull()).select(F.col(_FILE).alias("file"), F.col(_LINE).alias("line"))
    good = raw.where(F.col(_LINE).isNull())
    types = widen(good, declared)
    return good.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()]), bad
