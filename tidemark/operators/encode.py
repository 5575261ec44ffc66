"""Category vocabularies, fused one-hot counting and the top-1-per-type pivot.

The reference builds one indicator column per observed value and sums them in
a second step; here each value becomes one conditional aggregate inside the
block's single ``groupBy().agg()`` (F1 fused with D-7), so there is no wide
intermediate row and one shuffle per block. Partial aggregation runs before
the shuffle, which is what keeps a hot key cheap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.shape import clean_name


def discover_vocabularies(sources: dict[str, tuple[DataFrame, list[str]]]) -> dict[str, dict[str, list[str]]]:
    """F4 for several sources in one job: ``{name: (frame, columns)}`` →
    ``{name: {column: sorted distinct non-NULL values}}``.

    Each source is turned into (source, column, value) triples, the triples of
    all sources are unioned and de-duplicated on the executors (partial
    aggregation, one shuffle), and only the distinct values reach the driver,
    as many as the encoded frame gets columns.
    """
    parts = []
    for name, (df, cols) in sources.items():
        triples = F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("s"), F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                    for c in cols
                ]
            )
        )
        parts.append(df.select(triples.alias("p")).select("p.s", "p.c", "p.v"))
    union = reduce(DataFrame.unionByName, parts)
    found = union.where(F.col("v").isNotNull()).distinct().collect()
    out: dict[str, dict[str, list[str]]] = {name: {c: [] for c in cols} for name, (_, cols) in sources.items()}
    for row in found:
        out[row["s"]][row["c"]].append(row["v"])
    for cols in out.values():
        for values in cols.values():
            values.sort()
    return out


def merge_vocabularies(*sets: dict[str, dict[str, list[str]]]) -> dict[str, dict[str, list[str]]]:
    """Union of vocabularies, e.g. the stored one and that of a run; values sorted."""
    out: dict[str, dict[str, set[str]]] = {}
    for one in sets:
        for name, cols in one.items():
            for c, values in cols.items():
                out.setdefault(name, {}).setdefault(c, set()).update(values)
    return {name: {c: sorted(v) for c, v in cols.items()} for name, cols in out.items()}


def check_clean_names(values: list[str], prefix: str = "") -> None:
    """Raise (Q9) when two values would give the same column name."""
    seen: dict[str, str] = {}
    for v in values:
        name = clean_name(f"{prefix}_{v}")
        if name in seen:
            raise ValueError(f"values {seen[name]!r} and {v!r} both give the column {name!r}")
        seen[name] = v


def discover_vocabulary(df: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """F4 for one frame: ``{column: sorted distinct non-NULL values}`` in one job."""
    return discover_vocabularies({"_": (df, cols)})["_"]


def category_counts(col: str | Column, values: list[str], prefix: str, where: Column | None = None) -> list[Column]:
    """F1+D-7: one BIGINT count per value; NULL matches no value (Q5).
    ``where`` limits the rows counted (for an aggregate shared by several blocks)."""
    check_clean_names(values, prefix)
    c = F.col(col) if isinstance(col, str) else col
    if where is not None:
        c = F.when(where, c)
    return [F.count_if(c == F.lit(v)).alias(clean_name(f"{prefix}_{v}")) for v in values]


def weighted_counts(col: str | Column, values: list[str], weight: str | Column, prefix: str) -> list[Column]:
    """per value, the sum of ``weight`` over rows of that value (0 when none)."""
    check_clean_names(values, prefix)
    c = F.col(col) if isinstance(col, str) else col
    w = F.col(weight) if isinstance(weight, str) else weight
    return [
        F.sum(F.when(c == F.lit(v), w).otherwise(F.lit(0))).alias(clean_name(f"{prefix}_{v}"))
        for v in values
    ]


def top1_pivot(
    df: DataFrame,
    keys: list[str],
    pivot_col: str,
    values: list[str],
    order: list[Column],
    attrs: list[str],
) -> DataFrame:
    """F3+E3: per key and pivot value, the attributes of the row that is first
    by ``order`` (ascending; NULLs first like Spark's ``orderBy``), as columns
    ``<value>_<attr>`` with spaces turned to ``_``.

    One ``min`` of an (ordering…, attributes…) struct per value in one aggregate: a single exchange, partial
    before it, so a hot key sends one row per task. The long form (one ``min`` per key and
    value, then a pivot) needs a second exchange and was slower when measured. Rows of other values
    give a NULL struct and are skipped; keys whose rows are all of
    other values come out with all-NULL columns, as the reference's
    distinct-key left join does.
    """
    check_clean_names([v.replace(" ", "_") for v in values])
    # Ordering fields first, so the struct's own order is the requested one.
    ranked = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *[F.col(a).alias(a) for a in attrs])
    aggs = [F.min(F.when(F.col(pivot_col) == F.lit(v), ranked)).alias(f"__p{i}") for i, v in enumerate(values)]
    flat = []
    for i, v in enumerate(values):
        stem = v.replace(" ", "_")
        flat += [F.col(f"__p{i}.{a}").alias(clean_name(f"{stem}_{a}")) for a in attrs]
    if not aggs:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*aggs).select(*[F.col(k) for k in keys], *flat)


def pivot_code(col: str, values: list[str]) -> Column:
    """Place of the column's value in ``values`` from 1 on; 0 for other values and NULL."""
    if not values:
        return F.lit(0)
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in values]), F.col(col).cast("string")), F.lit(0)).cast("int")


def pivot_cells(df: DataFrame, keys: list[str], cells: str, values: list[str], attrs: list[str]) -> DataFrame:
    """F3 from rows that hold an array ``cells`` of structs (code, best, …) with the codes of ``pivot_code``, ascending: per value
    the attributes of the first cell of its code, as columns ``<value>_<attr>``, NULL where there is none.

    The wide row is made by a projection, so what is sorted and exchanged before it is as long as the values that a key has.
    """
    check_clean_names([v.replace(" ", "_") for v in values])
    first = [F.get(cells, F.array_position(F.col(f"{cells}.code"), F.lit(i)) - 1)["best"].alias(f"__p{i}") for i in range(1, len(values) + 1)]
    flat = []
    for i, v in enumerate(values, start=1):
        stem = v.replace(" ", "_")
        flat += [F.col(f"__p{i}.{a}").alias(clean_name(f"{stem}_{a}")) for a in attrs]
    return df.select(*keys, *first).select(*keys, *flat)
