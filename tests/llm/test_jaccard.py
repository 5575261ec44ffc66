import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA, awkward, awkward_rows, words_ascii  # noqa: F401
from tidemark.llm import jaccard


def grams(text, k):
    w = words_ascii(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, percent=90, k=3):
    sets = [grams(t, k) for _, t in rows]
    root = {s: s for s in sets if s}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    kinds = list(root)
    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                root[find(a)] = find(b)
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            least[find(s)] = min(i, least.get(find(s), i))
    return sorted(((i, len(s), least.get(find(s)) if s else i) for (i, _), s in zip(rows, sets)), key=str)


def result(df, **kw):
    return sorted((tuple(r) for r in jaccard.similar_components(df, **kw).collect()), key=str)


def test_awkward_rows_match_brute_force(awkward):  # noqa: F811
    df = awkward.withColumn("cls", F.lit("x")).withColumn("GRAMS", F.lit(1)).withColumn("n", F.lit(None))
    assert result(df) == brute([(r[0], r[1]) for r in awkward_rows()])


def near_copies(seed):
    """Groups of edited copies: whole groups without their base, chains, and copies that do not reach the threshold."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    texts = []
    for group in range(14):
        base = [rng.choice(vocab) for _ in range(rng.randint(2, 160))]
        for _ in range(rng.randint(1, 25)):
            text = list(base)
            for _ in range(rng.randint(0 if group % 2 else 1, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocab)
            texts.append(rng.choice([" ", "  ", "\n"]).join(text))
            if group == 3:
                base = text
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("kw", [{}, {"percent": 80, "rounds": 0}, {"percent": 60, "words": 2}, {"percent": 100}, {"percent": 70, "words": 1, "broadcast_rows": 0}])
def test_near_copies_match_brute_force(spark, kw):
    rows = near_copies(len(str(kw)))
    got = result(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), **kw)
    assert got == brute(rows, kw.get("percent", 90), kw.get("words", 3))


def test_a_group_of_near_copies_is_one_component_by_few_rows(spark):
    """300 copies of one text, each with one other word, all linked with the text: the join behind the pivots is empty."""
    base = [f"b{i}" for i in range(80)]
    rows = [(0, " ".join(base))] + [(i, " ".join(base[:k] + [f"new{i}"] + base[k + 1 :])) for i, k in ((i, i % 80) for i in range(1, 301))]
    assert {r[2] for r in result(spark.createDataFrame(rows, "doc_id bigint, text string"))} == {0}


def test_empty_table(spark):
    assert jaccard.similar_components(spark.createDataFrame([], SCHEMA)).count() == 0
