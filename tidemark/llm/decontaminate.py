"""Benchmark decontamination by winnowing.

Words of documents and items are hashed; of every window of consecutive k-word
grams the smallest hash is kept. A span of ``span`` words holds
``span - k + 1`` grams, and with windows of that many grams at least one gram of every
shared span is kept on both sides, because the choice depends on the window alone. The
kept grams of documents and items are joined on their hash and every hit is
extended left and right word by word; runs of ``span`` words are occurrences.

Items shorter than ``span`` words are one span of their own length, so each such length
that the benchmark has is winnowed as a class of its own with the same guarantee.

Scale. Documents are fingerprinted in one pass without a shuffle. A Bloom filter of the
benchmark's grams (``BLOOM_BITS`` bits whatever the benchmark's size) keeps those
grams that can match, with the hashes of the neighbouring words that an
extension can reach, so only such grams and one short row per document leave the
scan; false positives fall out in the join. The benchmark side is broadcast
only when counted below ``BROADCAST_ROWS``, else the join shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, byte_table, mix, quoted, span_hashes, spare_name, text_slices, word_spans
from tidemark.session import materialize

SPAN_WORDS = 13
GRAM_WORDS = 8
BLOOM_BITS = 1 << 24
BROADCAST_ROWS = 50_000
MIN_HIT_SHARE = 20  # contaminated when this many times the hit words reach the document's words

#: Bytes between words after A-Z is lower-cased: ASCII but 0-9 and a-z.
GAP = byte_table(bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122)))

_GRAM = np.uint64(0xBF58476D1CE4E5B9)
_SECOND = np.uint64(0x94D049BB133111EB)
HITS = "array<struct<cls:int,pos:int,h:bigint,ctx:array<bigint>>>"


def gram_words(span: int) -> int:
    """Words of a gram for spans of ``span`` words."""
    return min(GRAM_WORDS, span)


def winnow(words: np.ndarray, row: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the grams kept for spans of ``span`` words; rows are winnowed apart."""
    k = gram_words(span)
    w = span - k + 1
    n = len(words) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        grams = grams * _GRAM + words[j : j + len(grams)]
    grams = mix(grams + np.uint64(span))
    whole = row[:n] == row[span - 1 :]
    best = grams[:n].copy()
    at = np.zeros(n, np.int64)
    for j in range(1, w):
        nxt = grams[j : j + n]
        less = nxt < best
        best[less] = nxt[less]
        at[less] = j
    pos = np.unique((np.arange(n) + at)[whole])
    return pos, grams[pos]


def bloom_places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    m = np.uint64(bits - 1)
    return (h & m).astype(np.int64), (mix(h * _SECOND) & m).astype(np.int64)


def grams(text: Column, spans: list[int], bloom: bytes | None = None) -> Column:
    """struct(n_words, hits): the kept grams of a text, each with the words around it.

    ``ctx`` holds the word hashes that a run of ``span`` words around the gram can
    cover; 0 stands for a place outside the text. With ``bloom`` only grams that it may hold.
    """

    @F.arrow_udf(f"n_words bigint, hits {HITS}")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = None if bloom is None else np.unpackbits(np.frombuffer(bloom, np.uint8), bitorder="little").view(bool)
        for col in batches:
            parts = [_grams_of(buf, offs, spans, held) for buf, offs in text_slices(col)]
            yield pa.concat_arrays(parts) if parts else pa.array([], _TYPE)

    return run(text.cast("string"))


_HIT = pa.struct([("cls", pa.int32()), ("pos", pa.int32()), ("h", pa.int64()), ("ctx", pa.list_(pa.int64()))])
_TYPE = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(_HIT))])


def _grams_of(buf: np.ndarray, offs: np.ndarray, spans: list[int], held: np.ndarray | None) -> pa.Array:
    buf = LOWER[buf]
    s, e, row = word_spans(buf, offs, GAP)
    words = span_hashes(buf, s, e)
    rows = len(offs) - 1
    counts = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(counts)])
    got = []
    for span in spans:
        pos, h = winnow(words, row, span)
        if held is not None and len(pos):
            a, b = bloom_places(h, len(held))
            ok = held[a] & held[b]
            pos, h = pos[ok], h[ok]
        if not len(pos):
            continue
        k = gram_words(span)
        at = pos[:, None] + np.arange(k - span, span)[None, :]
        inside = (at >= first[row[pos]][:, None]) & (at < first[row[pos] + 1][:, None])
        ctx = np.where(inside, words[np.clip(at, 0, len(words) - 1)], np.uint64(0))
        got.append((row[pos], np.full(len(pos), span), pos - first[row[pos]], h, ctx))
    if not got:
        empty = pa.array([], _HIT)
        hits = pa.ListArray.from_arrays(pa.array(np.zeros(rows + 1, np.int32)), empty)
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), hits], fields=list(_TYPE))
    of = np.concatenate([g[0] for g in got])
    order = np.argsort(of, kind="stable")
    size = np.concatenate([np.full(len(g[0]), g[4].shape[1]) for g in got])[order]
    flat = [c for g in got for c in g[4]]
    ctx = np.concatenate([flat[i] for i in order]).view(np.int64)
    ctx_list = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(ctx))
    column = lambda i, t: pa.array(np.concatenate([g[i] for g in got])[order].astype(t))
    hit = pa.StructArray.from_arrays(
        [column(1, np.int32), column(2, np.int32), pa.array(np.concatenate([g[3] for g in got])[order].view(np.int64)), ctx_list], fields=list(_HIT)
    )
    ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=rows))]).astype(np.int32)
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), hit)], fields=list(_TYPE))


def _bloom(item_grams: DataFrame, size: int) -> bytes:
    """Filter of ``size`` bits (a power of two from 64) of the items' grams, reduced in Spark to at most size / 64 rows."""

    @F.arrow_udf("array<bigint>")
    def places(h: pa.Array) -> pa.Array:
        a, b = bloom_places(np.asarray(h).view(np.uint64), size)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(a) + 1, 2, dtype=np.int32)), pa.array(np.stack([a, b], 1).ravel()))

    bit = item_grams.select("h").distinct().select(F.explode(places("h")).alias("bit"))
    rows = bit.groupBy(F.expr("bit div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("v")).collect()
    bits = np.zeros(size // 64, np.int64)
    for r in rows:
        bits[r["w"]] = r["v"]
    return bits.tobytes()


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    span_words: int = SPAN_WORDS, bloom_bits: int = BLOOM_BITS, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Per row of ``docs``: id, ``text_hash``, n_words, n_hit, items (sorted array of ids as strings), contaminated.

    A word is hit when it lies in an occurrence of a span of an item; an item shorter than
    ``span_words`` words is one span. ``contaminated``: at least one word in MIN_HIT_SHARE is hit.
    A null or empty text has no words and is clean; repeated rows each return their row; an item
    without words is ignored, one with a null id counts for hits but not among the items. Either table may be empty.
    """
    base = docs.select(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("text_hash"), quoted(text_col).cast("string").alias("t"))
    items = benchmark.select(quoted(item_id).cast("string").alias("item"), grams(quoted(item_text), list(range(1, span_words + 1))).alias("g"))
    items = items.select("item", F.least(F.col("g.n_words"), F.lit(span_words)).alias("span"), F.explode("g.hits").alias("x"))
    items = materialize(items.where("x.cls = span").select("item", F.col("x.cls").alias("cls"), F.col("x.h").alias("h"), F.col("x.ctx").alias("ictx")).distinct(), "winnow-items")
    spans = sorted(r["cls"] for r in items.select("cls").distinct().collect())  # at most span_words values
    found = base.select("id", "text_hash", grams(F.col("t"), spans, _bloom(items, bloom_bits) if spans else b"\0" * 8).alias("g"))
    found = materialize(found.select("id", "text_hash", "g.n_words", "g.hits"), "winnow-docs")
    if items.count() <= broadcast_rows:
        items = F.broadcast(items)
    hits = found.where(F.size("hits") > 0).select("id", "text_hash", F.explode("hits").alias("x")).select("id", "text_hash", F.col("x.cls").alias("cls"), F.col("x.h").alias("h"), F.col("x.pos").alias("pos"), F.col("x.ctx").alias("ctx"))
    hits = hits.join(items, ["cls", "h"])
    side = F.col("cls") - F.least("cls", F.lit(GRAM_WORDS))  # words on either side of the gram
    same = F.zip_with("ctx", "ictx", lambda a, b: (a == b) & (a != 0))
    run = lambda part: F.when(F.array_position(part, F.lit(False)) > 0, F.array_position(part, F.lit(False)) - 1).otherwise(F.size(part))
    hits = hits.withColumn("same", same).withColumn("side", side)
    hits = hits.select(
        "id", "text_hash", "item", "cls", "pos",
        run(F.reverse(F.slice("same", F.lit(1), F.col("side")))).alias("l"),
        run(F.slice("same", F.col("side") + 1, F.size("same"))).alias("r"),
    ).where(F.col("l") + F.col("r") >= F.col("cls")).where(F.col("r") >= F.least("cls", F.lit(GRAM_WORDS)))
    hits = materialize(hits.select("id", "text_hash", "item", (F.col("pos") - F.col("l")).alias("s"), (F.col("pos") + F.col("r")).alias("e")).distinct(), "winnow-hits")
    key = ["id", "text_hash"]
    w = Window.partitionBy(*key).orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    spans_of = hits.select(*key, "s", "e").distinct().withColumn("before", F.coalesce(F.max("e").over(w), F.lit(0)))
    covered = spans_of.groupBy(*key).agg(F.sum(F.greatest(F.lit(0), F.col("e") - F.greatest("s", "before"))).alias("n_hit"))
    named = hits.groupBy(*key).agg(F.sort_array(F.collect_set("item")).alias("items"))
    null_safe = lambda a, b: a["id"].eqNullSafe(b["id"]) & a["text_hash"].eqNullSafe(b["text_hash"])
    marks = materialize(covered.join(named, null_safe(covered, named)).select(covered["id"], covered["text_hash"], "n_hit", "items"), "winnow-marks")
    out = found.join(marks, null_safe(found, marks), "left").select(
        found["id"].alias(id_col), found["text_hash"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * MIN_HIT_SHARE >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` without the contaminated rows; all columns stay, nulls and repeated rows as in ``contamination``."""
    bad = contamination(docs, benchmark, id_col, text_col, **params).where("contaminated")
    a, b = spare_name(docs, "bad_id"), spare_name(docs, "bad_hash")
    bad = bad.select(quoted(id_col).alias(a), F.col("text_hash").alias(b)).distinct()
    return docs.join(bad, quoted(id_col).eqNullSafe(quoted(a)) & F.xxhash64(quoted(text_col)).eqNullSafe(quoted(b)), "left_anti")
