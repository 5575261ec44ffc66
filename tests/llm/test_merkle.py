import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA, awkward, awkward_rows  # noqa: F401
from tidemark.llm import merkle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def claim():
    lower = F.translate("text", UPPER, LOWER)
    return {"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, lower).otherwise(F.col("text"))}


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute(rows, fanout):
    """The contract in plain Python: rows are (doc_id, text, lang, source, n_chars)."""

    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], r[1])))

    def claimed(r):
        if r[0] is None or r[1] is None or zlib.crc32(str(r[0]).encode()) % 5:
            return r
        return (r[0], r[1].translate(str.maketrans(UPPER, LOWER)), *r[2:])

    def tree(level):
        out = [level]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
        return out

    def path(levels, i):
        for row in levels[:-1]:
            a = i - i % fanout
            yield "".join(row[a:i]), "".join(row[i + 1 : a + fanout])
            i //= fanout

    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r), leaf(claimed(r)), r[0]))
    names = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: tree([x[2] for x in sorted(by[k], key=lambda x: x[:4])]) for k in names}
    top = tree([trees[k][-1][0] for k in names])
    out = []
    for j, k in enumerate(names):
        for i, x in enumerate(sorted(by[k], key=lambda x: x[:4])):
            steps, node = [*path(trees[k], i), *path(top, j)], x[3]
            for left, right in steps:
                node = sha(left + node + right)
            out.append((x[4], x[2], trees[k][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), node, node == top[-1][0]))
    return sorted(out, key=str)


def result(df, **kw):
    return sorted((tuple(r) for r in merkle.manifest(df, claimed=claim(), **kw).collect()), key=str)


@pytest.mark.parametrize("fanout,levels", [(16, 2), (2, 1)])
def test_awkward_rows_match_brute_force(awkward, fanout, levels):  # noqa: F811
    df = awkward.withColumn("leaf", F.lit("x")).withColumn("PART", F.lit(1)).withColumn("at", F.lit(None))
    assert result(df, fanout=fanout, levels=levels) == brute(awkward_rows(), fanout)


@pytest.mark.parametrize("fanout,levels", [(2, 2), (3, 1), (4, 2)])
def test_hot_source_many_rounds_and_repeated_rows(spark, fanout, levels):
    rng = random.Random(fanout)
    rows = [(i if rng.random() > 0.02 else None, rng.choice(["Text A", "b", None, ""]), None, rng.choice(["hot"] * 5 + ["b", None, "ü", "z"]), 1) for i in range(400)]
    rows += [(5, "Same Row", "en", "hot", 1)] * 60 + [(9001, None, None, "alone", None)]
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5), fanout=fanout, levels=levels) == brute(rows, fanout)


def test_untampered_rows_verify_and_a_changed_row_does_not(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert all(r["verified"] for r in merkle.manifest(df).collect())
    changed = {"n_chars": F.when(F.col("doc_id") == 7, 0).otherwise(F.col("n_chars"))}
    assert [r["doc_id"] for r in merkle.manifest(df, claimed=changed).collect() if not r["verified"]] == [7]


def test_large_ids_beside_a_null_stay_exact(spark):
    rows = [(9007199254740993, "a", "en", "s", 1), (-9223372036854775807, "b", "en", "s", 1), (None, "c", "en", "s", 1)]
    assert result(spark.createDataFrame(rows, SCHEMA).coalesce(1)) == brute(rows, 16)


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
