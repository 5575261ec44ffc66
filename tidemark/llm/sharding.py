"""Sharding by fixed virtual slots.

Every record is hashed into one of ``SLOTS`` virtual slots, once and for all. Bytes and rows are
aggregated per slot, and a versioned map says which shard holds each slot. Version 0 gives
the slots, largest first, to the shard that has the fewest bytes; a rebalancing edits the
last map: it moves slots out of shards above the mean, the ones that fit best, into those below, and
writes the next version. Rows never move but with their slot.

Only the slot statistics (at most SLOTS rows) reach the driver; the map (SLOTS rows) is
broadcast. Rows are numbered within their shard by counting within the slot and adding the
rows of the shard's earlier slots, so no task orders a whole shard.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, spare_name
from tidemark.session import materialize, scratch_path

SLOTS = 4096
SHARDS = 16


def virtual_slot(id_col: Column, text: Column, slots: int = SLOTS) -> Column:
    """Slot of a record: hash of its id and text, so copies under other ids are spread."""
    return F.pmod(F.xxhash64(id_col, text), F.lit(slots)).cast("int")


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (none for null) plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def slot_stats(rows: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, n) of rows with ``virtual_slot`` and ``size``; partial sums before the shuffle."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))


def first_map(sizes: dict[int, int], slots: int, shards: int) -> list[int]:
    """Shard of every slot: largest slot first to the shard with the fewest bytes (ties: lowest number)."""
    out = [0] * slots
    loads = [(0, s) for s in range(shards)]
    for slot in sorted(range(slots), key=lambda i: (-sizes.get(i, 0), i)):
        load, shard = loads[0]
        out[slot] = shard
        heapq.heapreplace(loads, (load + sizes.get(slot, 0), shard))
    return out


def edited_map(last: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """The last map with as few slots moved as bring every shard near the mean.

    While it makes the largest and the smallest shard more equal, the slot nearest to half their
    difference moves from the one to the other. Works for a grown ``shards`` too. With fewer shards, the slots of
    those that are gone move first, largest first, each to the shard with the fewest bytes.
    """
    out = list(last)
    held: list[list[int]] = [[] for _ in range(shards)]
    load = [0] * shards
    homeless = sorted((i for i, shard in enumerate(out) if shard >= shards), key=lambda i: (-sizes.get(i, 0), i))
    for slot, shard in enumerate(out):
        if shard < shards and sizes.get(slot, 0):
            held[shard].append(slot)
            load[shard] += sizes[slot]
    for slot in homeless:
        low = min(range(shards), key=lambda s: (load[s], s))
        out[slot] = low
        if sizes.get(slot, 0):
            held[low].append(slot)
            load[low] += sizes[slot]
    while True:
        big, low = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[big] - load[low]
        fits = [s for s in held[big] if 0 < sizes[s] < gap]
        if not fits:
            return out
        slot = min(fits, key=lambda s: (abs(2 * sizes[s] - gap), s))
        held[big].remove(slot)
        held[low].append(slot)
        load[big] -= sizes[slot]
        load[low] += sizes[slot]
        out[slot] = low


def write_map(spark: SparkSession, path: str, version: int, assigned: list[int]) -> None:
    """Append one version of the map to the table at ``path``; written by Spark to shared storage."""
    shard = F.lit(assigned)
    rows = spark.range(len(assigned)).select(F.lit(version).alias("version"), F.col("id").cast("int").alias("virtual_slot"), F.element_at(shard, F.col("id").cast("int") + 1).alias("shard"))
    rows.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(virtual_slot, shard) of one version, by default the last."""
    table = spark.read.parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == version).select("virtual_slot", "shard")


def _sizes(stats: DataFrame, slots: int) -> dict[int, int]:
    return {r["virtual_slot"]: r["bytes"] for r in stats.collect()}  # at most ``slots`` rows


def rebalance(spark: SparkSession, path: str, stats: DataFrame, slots: int = SLOTS, shards: int = SHARDS) -> int:
    """Edit the last map for new slot statistics and return the new version."""
    table = spark.read.parquet(path)
    version = table.agg(F.max("version")).first()[0]
    last = [r["shard"] for r in table.where(F.col("version") == version).orderBy("virtual_slot").collect()]
    write_map(spark, path, version + 1, edited_map(last, _sizes(stats, slots), shards))
    return version + 1


def shard(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, slots: int = SLOTS, map_path: str | None = None, carry: bool = True
) -> DataFrame:
    """``docs`` with size, virtual_slot, shard and slot (number of the row within its shard, from 0 without gaps).

    With ``map_path`` the stored map is edited for these rows (or made, if there is none)
    and its last version is used; else a new map goes to the shared folder. A null text has size 1;
    null ids and texts hash like a value of their own; rows equal in id and text share a slot; an empty table returns no rows. Columns
    of ``docs`` with one of the added names (without regard to case) are not returned. ``carry=False`` returns
    only the id and the text's CRC-32 beside the added columns, so texts are not shuffled.
    """
    spark = docs.sparkSession
    size, vslot = record_size(quoted(text_col)), virtual_slot(quoted(id_col), quoted(text_col), slots)
    lean = docs.select(
        quoted(id_col).alias("id"), F.crc32(F.coalesce(quoted(text_col), F.lit(""))).alias("crc"), size.alias("size"), vslot.alias("virtual_slot")
    )
    if not carry:
        lean = materialize(lean, "shard-rows")
    stats = materialize(slot_stats(lean), "shard-slots")
    if map_path is None:
        map_path, version = scratch_path(spark, "shard-map"), None
    else:
        version = _last_version(spark, map_path)
    if version is None:
        write_map(spark, map_path, 0, first_map(_sizes(stats, slots), slots, shards))
    else:
        rebalance(spark, map_path, stats, slots, shards)
    lookup = read_map(spark, map_path).join(stats, "virtual_slot")
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    lookup = F.broadcast(lookup.select("virtual_slot", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    if carry:
        added = {"size", "virtual_slot", "shard", "slot"}
        rows = docs.select(*[quoted(c) for c in docs.columns if c.lower() not in added], size.alias("size"), vslot.alias("virtual_slot"))
        order = [quoted(id_col), F.xxhash64(quoted(text_col))]
    else:
        rows = lean.select(F.col("id").alias(id_col), F.col("crc").alias("text_crc32"), "size", "virtual_slot")
        order = [quoted(id_col), F.col("text_crc32"), F.col("size")]
    before, number = spare_name(rows, "before"), spare_name(rows, "number")
    within = Window.partitionBy("virtual_slot").orderBy(*order)
    rows = rows.withColumn(number, F.row_number().over(within)).join(lookup.withColumnRenamed("before", before), "virtual_slot")
    return rows.select(*[quoted(c) for c in rows.columns if c not in (before, number)], (quoted(before) + quoted(number) - 1).alias("slot"))


def _last_version(spark: SparkSession, path: str) -> int | None:
    from tidemark.sources.catalog import path_exists

    return spark.read.parquet(path).agg(F.max("version")).first()[0] if path_exists(spark, path) else None
