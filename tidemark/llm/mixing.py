"""Mixing sources to target weights by Poisson replication.

The target weight of a source over its share of the corpus gives the mean
number of times each of its documents is repeated. Every document draws its count from the Poisson
distribution with that mean by inverting the distribution function at a uniform number
hashed from the seed and the document, is exploded by the count, and all copies are shuffled by a
hashed key. The draw depends on the row alone, so a recomputed task repeats it.

Scale. Sizes are summed per source with partial aggregates, so a source holding a third of all rows is
one row per task in the shuffle. The rates (one row per source) are broadcast when
counted below ``BROADCAST_SOURCES``; otherwise sources are joined by shuffle. The
copies are dealt out by a hash of document and copy number, so no source or group of copies gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, spare_name
from tidemark.session import materialize

SEED = 17
BROADCAST_SOURCES = 20_000
PIECE = 32.0  # a larger mean is the sum of equal independent pieces of at most this mean
TAIL = 120  # P(Poisson(32) > 120) is below 1e-30, so 53-bit uniforms always fall within the table


def uniform(seed: int, *parts: Column) -> Column:
    """Number in (0, 1) from the first 52 bits of an MD5 of the parts (null: one empty mark)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def pieces(rate: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(rate / PIECE)).cast("int")


def poisson_table(mean: Column) -> Column:
    """array of P(X <= k), k = 0..TAIL, for one piece with the given mean (at most PIECE)."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))
    step = lambda acc, k: F.struct(
        (acc["p"] * mean / k).alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + acc["p"] * mean / k)).alias("c")
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(TAIL)), start, step, lambda acc: acc["c"])


def draw(table: Column, n_pieces: Column, seed: int, *parts: Column) -> Column:
    """Poisson count: for each piece the number of table entries at or below its uniform, added up."""
    numbers = F.transform(F.sequence(F.lit(1), n_pieces), lambda i: uniform(seed, *parts, i))
    return F.aggregate(numbers, F.lit(0), lambda acc, u: acc + F.size(F.filter(table, lambda c: c <= u)))


def rates(docs: DataFrame, weights: DataFrame | None = None, alpha: float = 0.5, budget: float = 1.0, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, size, weight, rate) per source; size counts the characters of its texts plus one per row.

    ``weights`` (source, weight) are target weights; sources without one, or with a weight not above 0, get rate 0.
    Without ``weights`` the target is proportional to size ** alpha. The rates aim at ``budget`` times the
    corpus size in expectation.
    """
    size = F.sum(F.coalesce(F.length(quoted(text_col)), F.lit(0)).cast("long") + 1)
    sizes = docs.groupBy(quoted(source_col).alias("source")).agg(size.alias("size"))
    if weights is None:
        sized = sizes.withColumn("w", F.pow(F.col("size").cast("double"), F.lit(alpha)))
    else:
        target = weights.groupBy("source").agg(F.max("weight").cast("double").alias("w"))
        sized = sizes.join(target.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        sized = sized.withColumn("w", F.when(F.col("w") > 0, F.col("w")).otherwise(0.0))
    sized = materialize(sized, "mix-sizes")
    total = sized.agg(F.sum("size").alias("n"), F.sum("w").alias("w")).first()
    whole, scale = float(total["n"] or 0), float(total["w"] or 0)
    weight = F.col("w") / F.lit(scale) if scale > 0 else F.lit(0.0)
    return sized.select("source", "size", weight.alias("weight")).withColumn("rate", F.col("weight") * F.lit(whole * budget) / F.col("size"))


def mix(
    docs: DataFrame, weights: DataFrame | None = None, alpha: float = 0.5, budget: float = 1.0, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """Copies of ``docs`` rows with ``copy`` (from 1), ``n_copies``, ``rate`` and ``shuffle_key``, dealt out and sorted by the key.

    A null source is a source of its own; null ids draw with one common mark and their text; rows that repeat
    id and text draw the same count; empty texts count one character; an empty table returns no rows. Columns of ``docs`` with one of the
    added names (without regard to case) are not returned.
    """
    added = {"copy", "n_copies", "rate", "shuffle_key"}
    docs = docs.select(*[quoted(c) for c in docs.columns if c.lower() not in added])
    table = rates(docs, weights, alpha, budget, source_col, text_col)
    src, cdf, parts = (spare_name(docs, n) for n in ("mix_source", "mix_cdf", "mix_pieces"))
    table = materialize(
        table.select(F.col("source").alias(src), "rate", pieces(F.col("rate")).alias(parts), poisson_table(F.col("rate") / pieces(F.col("rate"))).alias(cdf)), "mix-rates"
    )
    if table.count() <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    row = [quoted(id_col), F.md5(F.coalesce(quoted(text_col), F.lit("")))]
    drawn = docs.join(table, quoted(source_col).eqNullSafe(quoted(src)))
    drawn = drawn.withColumn("n_copies", draw(quoted(cdf), quoted(parts), seed, *row)).where("n_copies > 0")
    out = drawn.select(*[quoted(c) for c in docs.columns], "rate", "n_copies", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy"))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("order"), F.coalesce(row[0].cast("string"), F.lit("-")), row[1], F.col("copy")))
    return out.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")
