"""SimHash near-duplicates by multi-index hashing.

Each text gets a 64-bit SimHash of its word shingles. Fingerprints at most
``max_bits`` apart are linked, and components are the connected sets of links.

Search. A 64-bit fingerprint is cut into ``segments`` parts. For a distance of
at most ``max_bits`` = segments * q + a, the first a + 1 segments need a ball of
radius q and the others one of radius q - 1: if all segments differed by
more, the total would exceed ``max_bits``. Every distinct fingerprint is stored once under each of
its segment values; a query enumerates its balls, fetches the table entries by
an equality join and the whole distance is verified. Copies collapse to one
fingerprint before the search, so a group of copies costs one row.

Large buckets. A bucket with more than ``bucket_limit`` different fingerprints
is not paired. Its members emit the keys of their own ball of radius
``max_bits // 2`` over all 64 bits; members that meet under one key are within
``max_bits`` of each other, so the smallest is linked with each of the rest. Two fingerprints
within ``max_bits`` (an even number) always meet under a key half way, so no link is lost for the
components, and the rows grow linearly with the members.

Components. Alternating large-star and small-star steps on the link table,
written to the shared folder after each round; hub rows are reduced by partial
aggregates. No links or components reach the driver, only counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, spare_name
from tidemark.session import materialize

SHINGLE_WORDS = 4
MAX_BITS = 4
SEGMENTS = 3
BUCKET_LIMIT = 4096
SEED = 42


def simhash(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of one text: words between ASCII white space, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        return digest(joined, seed)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    n = len(words) - shingle_words + 1
    h = np.fromiter(
        (digest(joined[a:z], seed) for a, z in zip(start[:n].tolist(), end[shingle_words - 1 :].tolist())), np.uint64, n
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # bits of a block of hashes at a time
        block = h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """Signed 64-bit SimHash column; a null or empty text has fingerprint 0."""

    @F.arrow_udf("bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            values = (simhash(t.as_buffer().to_pybytes(), shingle_words, seed) if t.is_valid else 0 for t in col)
            yield pa.array(np.fromiter(values, np.uint64, len(col)).view(np.int64), pa.int64())

    return run(text.cast("string"))


def segment_bounds(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of 64 bits, as even as possible."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def ball_masks(width: int, radius: int, shift: int = 0) -> list[int]:
    """All xor masks of at most ``radius`` bits among ``width`` bits, as signed 64-bit values."""
    out = []
    for r in range(radius + 1):
        for bits in combinations(range(width), r):
            v = sum(1 << b for b in bits) << shift
            out.append(v - (1 << 64) if v >= 1 << 63 else v)
    return out


def segment_radii(max_bits: int, segments: int) -> list[int]:
    q, a = divmod(max_bits, segments)
    return [q if i <= a else q - 1 for i in range(segments)]


def _segment(fp: Column, first: int, width: int) -> Column:
    if width == 64:
        return fp
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def _ball(fp: Column, seg: int, first: int, width: int, radius: int) -> Column:
    """array of (seg, val) for the values within ``radius`` bits of the fingerprint's segment."""
    value = _segment(fp, first, width)
    return F.transform(F.lit(ball_masks(width, radius)).cast("array<bigint>"), lambda m: F.struct(F.lit(seg).alias("seg"), value.bitwiseXOR(m).alias("val")))


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a < b) between the distinct values of column ``fp``.

    Contains every pair within ``max_bits`` unless both lie in buckets over
    ``bucket_limit``; those are connected through verified star links, so the connected
    components are exact in every case.
    """
    if max_bits % 2 or not 0 < segments <= 64:
        raise ValueError("max_bits must be even and segments between 1 and 64")
    parts = list(zip(range(segments), segment_bounds(segments), segment_radii(max_bits, segments)))
    table = fps.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), _segment(F.col("fp"), lo, w).alias("val")) for i, (lo, w), r in parts if r >= 0])).alias("k"),
    ).select("fp", "k.seg", "k.val")
    sizes = table.groupBy("seg", "val").agg(F.count("*").alias("n"))
    large = materialize(sizes.where(F.col("n") > bucket_limit).select("seg", "val"), "simhash-large")
    if large.isEmpty():
        small = table
        star = None
    else:
        small = table.join(large, ["seg", "val"], "left_anti")
        hot = table.join(large, ["seg", "val"], "left_semi").select("fp").distinct()
        star = _star_links(hot, max_bits)
    masks = [_ball(F.col("fp"), i, lo, w, r) for i, (lo, w), r in parts if r >= 0]
    probes = fps.select(F.col("fp").alias("q"), F.explode(F.concat(*masks)).alias("k")).select("q", "k.seg", "k.val")
    # With equal radii on both sides a pair is found from either end; from large buckets only one end may see a small one.
    keep = (F.col("q") != F.col("fp")) & (F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= max_bits)
    found = probes.join(small, ["seg", "val"]).where(keep).select(F.least("q", "fp").alias("a"), F.greatest("q", "fp").alias("b"))
    if star is not None:
        found = found.unionByName(star)
    return found.distinct()


def _star_links(hot: DataFrame, max_bits: int) -> DataFrame:
    masks = F.lit(ball_masks(64, max_bits // 2)).cast("array<bigint>")
    keys = hot.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("key"))
    least = keys.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where(F.col("a") < F.col("z"))
    return keys.join(least.select("key", "a"), "key").where(F.col("fp") > F.col("a")).select("a", F.col("fp").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node reachable."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "simhash-edges")
    size = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while True:
        # Large star: every larger neighbour of a node goes to the smallest of the node and its neighbours.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "simhash-low")  # a hub's join can be split
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "simhash-large-star")
        # Small star: a node and its smaller neighbours go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(small, "simhash-small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == size:
            break
        size = now
    # At the fixed point every edge leads straight to the smallest node of its component.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, **search) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): (id, fp) of every row, and (fp, root, component_id) of every distinct fingerprint."""
    ids = materialize(docs.select(quoted(id_col).alias("id"), fingerprint(quoted(text_col), shingle_words).alias("fp")), "simhash-fp")
    members = materialize(ids.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = components(links(members.select("fp"), **search))
    rooted = members.join(roots, members.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # Written, so that the join on the root of a large component can be split.
    best = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    return ids, rooted.join(best, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, **search
) -> DataFrame:
    """One row per row of ``docs``: id, ``fp`` (signed SimHash) and ``component_id``.

    ``component_id`` is the smallest id reachable over links (``search``: see ``links``). Null and
    empty texts have fingerprint 0 and link like any other; repeated rows each return a row; a
    null id takes its component's smallest id, and a component without any id has a null one.
    An empty table returns no rows. Other columns of ``docs`` are not read.
    """
    ids, labels = _labelled(docs, id_col, text_col, shingle_words, **search)
    return ids.join(labels, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, **search
) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest id.

    Rows that repeat an id may be of several components; each component keeps its own. Of the rows of one component
    that repeat its smallest id, and of the rows of a component without any id, the smallest text stays (a null
    text first). All columns of ``docs`` are kept; an empty table returns no rows.
    """
    ids, labels = _labelled(docs, id_col, text_col, shingle_words, **search)
    labels = materialize(labels, "simhash-labels")
    key, fp, root = spare_name(docs, "keep_id"), spare_name(docs, "fp"), spare_name(docs, "root")
    chosen = labels.where("component_id is not null").select(F.col("component_id").alias(key)).distinct()
    again = materialize(ids.where("id is not null").groupBy("id").count().where("count > 1").select(F.col("id").alias(key)), "simhash-again")
    own = docs.join(chosen, quoted(id_col) == quoted(key), "left_semi")
    out = own
    if not again.isEmpty():
        # The id alone does not tell which of its rows is in the component, so the fingerprint is looked at, too.
        rows = own.join(again, quoted(id_col) == quoted(key), "left_semi").withColumn(fp, fingerprint(quoted(text_col), shingle_words))
        at = labels.select(F.col("fp").alias(fp), F.col("root").alias(root), F.col("component_id").alias(key))
        rows = rows.join(at, fp).where(quoted(id_col) == quoted(key))
        out = own.join(again, quoted(id_col) == quoted(key), "left_anti").unionByName(_smallest_text(rows, [root], text_col).select(*map(quoted, docs.columns)))
    no_id = labels.where("component_id is null").select("fp", "root")
    if not ids.where("id is null").isEmpty():
        lone = docs.where(quoted(id_col).isNull()).withColumn(fp, fingerprint(quoted(text_col), shingle_words))
        lone = lone.join(no_id.select(F.col("fp").alias(fp), F.col("root").alias(root)), fp)
        out = out.unionByName(_smallest_text(lone, [root], text_col).select(*map(quoted, docs.columns)))
    return out


def _smallest_text(df: DataFrame, by: list[str], text_col: str) -> DataFrame:
    """One whole row for each value of ``by``: the one of the smallest text."""
    cols = df.columns
    row = F.struct(*[quoted(c).alias(f"c{i}") for i, c in enumerate(cols)])
    best = df.groupBy(*map(quoted, by)).agg(F.min_by(row, F.struct(quoted(text_col).isNotNull(), quoted(text_col))).alias("r"))
    return best.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(cols)])
