import random
import re

import pytest

from tests.llm.helpers import awkward, awkward_rows, prose  # noqa: F401
from tidemark.llm import decontaminate

GAP = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return GAP.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, span=13):
    spans = {}
    for item, text in items:
        w = words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            spans.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(s) for s in spans}:
            for i in range(len(w) - n + 1):
                if (own := spans.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((doc, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in df.collect()), key=str)


def benchmark_rows():
    rng = random.Random(11)
    items = [(i, prose(rng, n)) for i, n in enumerate([40, 13, 14, 12, 7, 3, 1, 25, 60, 13])]
    return items + [(20, items[0][1]), (21, None), (22, ""), (23, "..!!"), (None, prose(rng, 30)), (20, items[0][1]), (-5, "Exactly the river of stone the of and.")]


def planted():
    rng = random.Random(12)
    items = [t for _, t in benchmark_rows() if t]
    rows = []
    for i in range(60):
        w = prose(rng, rng.randint(5, 300)).split()
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(items).upper().split() if i % 2 else rng.choice(items).split()
            a = rng.randint(0, max(0, len(part) - 13))
            cut = part[a : a + rng.randint(10, 30)]
            at = rng.randint(0, len(w))
            w[at:at] = cut
        rows.append((1000 + i, "  ".join(w), "en", "s", 1))
    return rows


def test_matches_brute_force(spark, awkward):  # noqa: F811
    docs = awkward_rows() + planted() + planted()[:3]
    df = spark.createDataFrame(docs, awkward.schema).repartition(4)
    items = spark.createDataFrame(benchmark_rows(), "item_id bigint, text string")
    got = result(decontaminate.contamination(df, items))
    assert got == brute([(d[0], d[1]) for d in docs], benchmark_rows())
    assert sum(r[4] for r in got) > 20 and any(r[2] and not r[4] for r in got)
    kept = decontaminate.drop_contaminated(df.withColumnRenamed("n_chars", "BAD_ID"), items)
    assert kept.columns == ["doc_id", "text", "lang", "source", "BAD_ID"]
    assert kept.count() == sum(not r[4] for r in got)


def test_shuffle_join_and_small_filter_give_the_same(spark):
    df = spark.createDataFrame([r[:2] for r in planted()], "doc_id bigint, text string")
    items = spark.createDataFrame(benchmark_rows(), "item_id bigint, text string")
    want = brute([r[:2] for r in planted()], benchmark_rows())
    # A filter of 64 bits is full and lets every gram pass to the join.
    assert result(decontaminate.contamination(df, items, bloom_bits=64, broadcast_rows=-1)) == want


@pytest.mark.parametrize("docs,items", [([], benchmark_rows()), ([(1, "a b c")], []), ([(1, "a b c")], [(1, None)]), ([], [])])
def test_empty_tables(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    assert result(decontaminate.contamination(d, b)) == brute(docs, items)
