"""Similarity join of documents on the Jaccard coefficient of their word n-grams.

A document's set is its distinct word n-grams (64-bit hashes of the words). Documents with equal
sets are one class; classes whose coefficient is at least ``percent`` / 100 are linked, and a
component is what links connect.

Prefix filter. N-grams stand rare first: by the number of sets that hold them, then by hash. Linked sets
share one of the first ``n - ceil(percent * n / 100) + 1`` n-grams of the larger and of the first
``n - ceil(2 * percent * n / (100 + percent)) + 1`` of the smaller one. An n-gram of a single set matches nothing, so
a class whose prefix holds only such n-grams is out. Most classes are ruled out before any ordering: of any
n-grams of a set a linked set lacks at most ``n * (100 - percent) / 100``, so a class with more single
n-grams than that in a fixed quarter of the hash space has no partner. That takes one aggregate of a quarter of
all n-grams; the whole n-grams are then counted and ordered for the remaining classes alone.

Candidates. Classes meet on prefix n-grams, and the join condition holds the length filter (sizes), the
positional filter (what can still match behind the two positions) and the suffix filter (n-grams behind
the two positions counted in ``SLOTS`` slots: differing counts bound the number of differing n-grams from
below). Each remaining pair is verified once on the whole sets.

Large groups. Pairs within a group of near copies are as many as its square, but components need
only enough links. Each prefix n-gram first links its classes to one pivot, in ``ROUNDS`` rounds with different
pivots. The remaining join then takes, for each n-gram, the classes outside its largest component
against all of its classes and skips pairs of one component. No pair of different components is skipped, so
components are exact; a connected group costs rows in proportion to its classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_SPACE, LOWER, mix, quoted, span_hashes, text_slices, word_spans
from tidemark.llm.simhash import components
from tidemark.session import materialize

SHINGLE_WORDS = 3
PERCENT = 90
SLOTS = 32
ROUNDS = 2
BROADCAST_ROWS = 1 << 20
NO_ID = (1 << 63) - 1


def shingle_sets(buf: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text of a slice, ordered by row and hash."""
    s, e, row = word_spans(LOWER[buf], offs, ASCII_SPACE)
    h = span_hashes(LOWER[buf], s, e)
    rows = len(offs) - 1
    n = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    # A text of fewer words has one shingle: all of them. Hashes are chained word by word.
    size = np.minimum(n, words)
    starts = np.flatnonzero(np.arange(len(row)) - first[row] <= (n - size)[row]) if len(row) else np.zeros(0, np.int64)
    value = mix(size[row[starts]].astype(np.uint64))
    for k in range(words):
        more = k < size[row[starts]]
        at = np.minimum(starts + k, len(h) - 1) if len(h) else starts
        value = np.where(more, mix(value * np.uint64(0x9E3779B97F4A7C15) + h[at]), value)
    doc = row[starts]
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def _lists(doc: np.ndarray, value: np.ndarray, rows: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(rows + 1)).astype(np.int32)), pa.array(value.view(np.int64)))


def _set_columns(rows: DataFrame, words: int, whole: bool) -> DataFrame:
    """``rows`` (all columns, the last one text) with n, c1, c2 (which tell sets apart) and their n-grams in place
    of the text: all of them, or those of a fixed quarter of the hash space."""
    keep = rows.columns[:-1]
    schema = ", ".join(f"{c} bigint" for c in [*keep, "n", "c1", "c2"]) + ", grams array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = 0
            for buf, offs in text_slices(batch.column(len(keep))):
                k = len(offs) - 1
                doc, value = shingle_sets(buf, offs, words)
                sums = [np.zeros(k, np.uint64), np.zeros(k, np.uint64)]
                for j, total in enumerate(sums):
                    np.add.at(total, doc, mix(value + np.uint64(j)))
                few = slice(None) if whole else value & np.uint64(3) == 0
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, k) for c in range(len(keep))), pa.array(np.bincount(doc, minlength=k)),
                     *(pa.array(t.view(np.int64)) for t in sums), _lists(doc[few], value[few], k)],
                    [*keep, "n", "c1", "c2", "grams"],
                )
                i += k

    return rows.mapInArrow(run, schema)


def spare(n: str, percent: int) -> str:
    """SQL: how many n-grams of a set of ``n`` a linked set can lack."""
    return f"({n} * {100 - percent} div 100)"


def _prefix_rows(lists: DataFrame, percent: int) -> DataFrame:
    """(gram, cls, n, pos, short, after): a row for each shared n-gram in the larger prefix of a class.

    ``pos`` is the n-gram's place in the set, ``short`` tells whether the smaller prefix holds it too, and
    ``after`` counts the n-grams behind it by slot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cls, n, grams in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                g = grams.values.to_numpy()
                single = n - len(g)
                k = n * (100 - percent) // 100 + 1 - single
                pos = single + np.arange(k)
                slot = (g >> 8) & (SLOTS - 1)
                held = np.cumsum(slot[:k, None] == np.arange(SLOTS), axis=0)
                after = (np.bincount(slot, minlength=SLOTS) - held).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(g[:k]), pa.array(np.full(k, cls)), pa.array(np.full(k, n)), pa.array(pos), pa.array(pos < n - (-(-2 * percent * n // (100 + percent))) + 1),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, k * SLOTS + 1, SLOTS, dtype=np.int32)), pa.array(after.ravel())),
                ], ["gram", "cls", "n", "pos", "short", "after"])

    return lists.select("cls", "n", "grams").mapInArrow(run, "gram bigint, cls bigint, n bigint, pos bigint, short boolean, after array<int>")


def _may_link(a: str, b: str, percent: int) -> Column:
    """Length, positional and suffix filter of two prefix rows of one n-gram.

    A linked pair passes at the first n-gram that the two share, which is in both prefixes."""
    least = F.expr(f"(({a}.n + {b}.n) * {percent} + {99 + percent}) div {100 + percent}")  # n-grams that must be shared
    sizes = F.expr(f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)")
    smaller = F.expr(f"CASE WHEN {a}.n < {b}.n OR ({a}.n = {b}.n AND {a}.cls < {b}.cls) THEN {a}.short ELSE {b}.short END")
    behind = F.expr(f"least({a}.n - {a}.pos, {b}.n - {b}.pos)")
    differ = F.aggregate(F.zip_with(f"{a}.after", f"{b}.after", lambda x, y: F.abs(x - y)), F.lit(0), lambda x, y: x + y)
    return sizes & smaller & (behind >= least) & (F.col(f"{a}.pos") + F.col(f"{b}.pos") + differ <= F.expr(f"{a}.n + {b}.n") - 2 * least)


def _verified(pairs: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """The pairs (a < b) whose whole sets reach the threshold; each is looked at once."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = lambda c: lists.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("grams").alias(f"g_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("shared", F.size(F.array_intersect("g_a", "g_b")))
    return both.where(F.expr(f"100 * shared >= {percent} * (n_a + n_b - shared)")).select("a", "b")


def _with_component(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    if links is None:
        return rows.withColumn("comp", F.col("cls"))
    roots = components(links).select(F.col("node").alias("cls"), "root")
    return rows.join(roots, "cls", "left").withColumn("comp", F.coalesce("root", "cls")).drop("root")


def _links(lists: DataFrame, percent: int, rounds: int) -> DataFrame:
    """Verified links (a < b) between classes with the components of all links."""
    rows = materialize(_prefix_rows(lists, percent), "jaccard-prefix")
    links = None
    for r in range(rounds):
        with_comp = _with_component(rows, links)
        # The first pivot of an n-gram has the fewest rarer ones before it: of near copies, the one they were made from.
        rank = F.struct("pos", "n", "cls") if r == 0 else F.struct(F.xxhash64("cls", F.lit(r)).alias("h"), F.col("n"), F.col("cls"))
        row = F.struct("cls", "n", "pos", "short", "after", "comp")
        pivots = with_comp.groupBy("gram").agg(F.min_by(row, rank).alias("p"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        pivots = materialize(pivots.where("low <> high").select("gram", "p.*"), "jaccard-pivots")
        met = with_comp.alias("x").join(pivots.alias("y"), (F.col("x.gram") == F.col("y.gram")) & (F.col("x.comp") != F.col("y.comp")) & _may_link("x", "y", percent))
        found = _verified(met.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")), lists, percent)
        links = materialize(found if links is None else links.unionByName(found), "jaccard-links")
    rows = materialize(_with_component(rows, links), "jaccard-components")
    held = rows.groupBy("gram", "comp").agg(F.count("*").alias("held"))
    main = held.groupBy("gram").agg(F.max_by("comp", F.struct("held", "comp")).alias("main"), F.count("*").alias("kinds")).where("kinds > 1").select("gram", "main")
    main = materialize(main, "jaccard-main")
    mixed = materialize(rows.join(main, "gram"), "jaccard-mixed")
    rest = mixed.where("comp <> main")
    once = (F.col("y.comp") == F.col("y.main")) | (F.col("x.cls") < F.col("y.cls"))
    met = rest.alias("x").join(mixed.alias("y"), (F.col("x.gram") == F.col("y.gram")) & (F.col("x.comp") != F.col("y.comp")) & once & _may_link("x", "y", percent))
    found = _verified(met.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")), lists, percent)
    return found if links is None else links.unionByName(found)


def similar_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT, rounds: int = ROUNDS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles and component_id, the smallest id reachable over links.

    Words are maximal runs of other than ASCII white space, A-Z lower-cased. A text of fewer words than
    ``words`` is one n-gram of them all. A text without words and a null one have an empty set, which is
    linked with nothing, not even its copies. Repeated rows each return a row; a null id
    takes its component's smallest id, and a component without any id has a null one. An empty table
    returns no rows. Other columns of ``docs`` are not read.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    base = docs.select(F.coalesce(quoted(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), F.xxhash64(quoted(text_col)).alias("key"), quoted(text_col).cast("string").alias("text"))
    found = materialize(_set_columns(base, words, whole=False), "jaccard-sets")
    same = ["n", "c1", "c2"]
    classes = found.where("n > 0").groupBy(*same).agg(F.min("id").alias("id"), F.min_by("key", "id").alias("key"))
    classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()), "jaccard-classes")

    # Sampled n-grams of one class alone; c1 stands for the class.
    one = found.select("c1", F.explode("grams").alias("gram")).groupBy("gram").agg(F.min("c1").alias("c1"), F.max("c1").alias("z")).where("c1 = z")
    singles = one.groupBy("c1").agg(F.count("*").alias("single"))
    alive = classes.join(singles, "c1", "left").where(f"coalesce(single, 0) <= {spare('n', percent)}").select(*same, "cls", "id", "key")
    alive = materialize(alive, "jaccard-alive")

    keys = alive.select("id", "key", "cls")
    if alive.count() <= broadcast_rows:
        keys = F.broadcast(keys)
    texts = base.join(keys, ["id", "key"]).select("cls", "text")
    sets = _set_columns(texts, words, whole=True).groupBy("cls", "n").agg(F.first("grams").alias("grams"))  # equal for repeated rows
    sets = materialize(sets, "jaccard-alive-sets")
    grams = sets.select("cls", "n", F.explode("grams").alias("gram"))
    often = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    often = materialize(often, "jaccard-often")  # a written side lets Spark split the join at a frequent n-gram
    ordered = grams.join(often, "gram").groupBy("cls", "n").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("o"))
    lists = ordered.select("cls", "n", F.col("o.gram").alias("grams")).where(f"n - size(grams) <= {spare('n', percent)}")
    lists = materialize(lists, "jaccard-lists")

    roots = components(_links(lists, percent, rounds)).select(F.col("node").alias("cls"), "root")
    rooted = classes.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    labels = rooted.join(least, "root").select(*same, "component_id")
    full = found.select("id", *same).join(labels, same, "left")
    no_null = lambda c: F.when(c != NO_ID, c)
    return full.select(
        no_null(F.col("id")).alias(id_col), F.col("n").alias("n_shingles"), no_null(F.coalesce("component_id", "id")).alias("component_id")
    )
