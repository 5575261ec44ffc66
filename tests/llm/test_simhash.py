import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA, awkward, awkward_rows, words_ascii  # noqa: F401
from tidemark.llm import simhash


def brute_fingerprint(text):
    w = words_ascii(text)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_components(fps, bits=4):
    """Root of every distinct fingerprint by a plain search over all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def brute(rows):
    fp = [brute_fingerprint(t) for _, t in rows]
    root = brute_components(fp)
    least = {}
    for (i, _), f in zip(rows, fp):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f, least.get(root[f])) for (i, _), f in zip(rows, fp)), key=str)


def result(df):
    return sorted(((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in df.collect()), key=str)


def test_awkward_rows_match_brute_force(awkward):  # noqa: F811
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert result(simhash.near_duplicates(awkward)) == brute(rows)


def _clusters(n, seed):
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            f = centre
            for b in rng.sample(range(64), rng.randint(0, 6)):
                f ^= 1 << b
            out.append(f)
    return out[:n]


@pytest.mark.parametrize("segments,limit", [(2, 4096), (3, 4096), (4, 4096), (3, 1), (3, 3), (4, 2)])
def test_links_give_the_exact_components(spark, segments, limit):
    if segments == 2 and limit == 4096:
        fps = _clusters(60, 2)
    else:
        fps = _clusters(150, segments + limit)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in sorted(set(fps))]
    df = spark.createDataFrame(signed, "fp bigint")
    found = simhash.links(df, 4, segments, limit)
    pairs = [(r["a"], r["b"]) for r in found.collect()]
    assert all(0 < ((a ^ b) & (1 << 64) - 1).bit_count() <= 4 and a < b for a, b in pairs)
    roots = {r["node"]: r["root"] for r in simhash.components(found).collect()}
    got = {}
    for (f,) in signed:
        got.setdefault(roots.get(f, f), set()).add(f & (1 << 64) - 1)
    want = {}
    for f, r in brute_components(fps).items():
        want.setdefault(r, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_without_large_buckets_all_links_are_found(spark):
    fps = sorted(set(_clusters(120, 9)))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    got = {frozenset((r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1)) for r in simhash.links(df).collect()}
    assert got == {frozenset((a, b)) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 4}


def test_long_chain_is_one_component(spark):
    chain = [(i, i + 1) for i in range(200)]
    random.Random(3).shuffle(chain)
    got = simhash.components(spark.createDataFrame(chain + [(500, 501), (7, 7)], "a bigint, b bigint")).collect()
    assert {(r["node"], r["root"]) for r in got} == {(i, 0) for i in range(1, 201)} | {(501, 500)}


def test_drop_keeps_one_row_per_component(awkward):  # noqa: F811
    kept = simhash.drop_near_duplicates(awkward.withColumn("fp", F.lit("x")).withColumn("KEEP_ID", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp", "KEEP_ID"]
    rows = kept.collect()
    want = brute([(r[0], r[1]) for r in awkward_rows()])
    root = brute_components([w[1] for w in want])
    got = [root[brute_fingerprint(r["text"])] for r in rows]
    assert sorted(got) == sorted(set(root.values()))
    component = {f: c for _, f, c in want}
    assert len(got) == len(set(got))
    assert all(r["doc_id"] == component[brute_fingerprint(r["text"])] for r in rows)


def test_an_id_of_several_components_keeps_one_row_of_each(spark):
    a, b = "one two three four five six seven eight nine ten", "quite another text that shares no word with the first"
    df = spark.createDataFrame([(7, a), (3, a), (7, b), (7, b), (9, b), (7, None), (8, "")], "doc_id bigint, text string")
    assert sorted(map(str, map(tuple, simhash.drop_near_duplicates(df).collect()))) == sorted(map(str, [(3, a), (7, b), (7, None)]))


def test_components_without_ids_and_empty_table(spark):
    same = "one two three four five six seven"
    df = spark.createDataFrame([(None, same, "a"), (None, same, "b"), (None, "lone text", None), (4, "with id here", "c")], "doc_id bigint, text string, lang string")
    rows = simhash.drop_near_duplicates(df).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in rows) == [("4", "with id here"), ("None", "lone text"), ("None", same)]
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


def test_radii_cover_the_distance():
    for bits in range(0, 9, 2):
        for m in range(1, 9):
            r = simhash.segment_radii(bits, m)
            assert sum(x + 1 for x in r) > bits  # all segments above their radius exceed the distance
    assert len(simhash.ball_masks(21, 1)) == 22 and len(set(simhash.ball_masks(64, 2))) == 2081
