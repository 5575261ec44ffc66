import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA, awkward, awkward_rows  # noqa: F401
from tidemark.llm import mixing


def u(*parts):
    h = hashlib.md5("|".join(["17", *["-" if p is None else str(p) for p in parts]]).encode()).hexdigest()
    return (int(h[:13], 16) + 0.5) / (1 << 52)


def poisson(rate, doc_id, text):
    pieces = max(1, math.ceil(rate / 32))
    count = 0
    for i in range(1, pieces + 1):
        p = math.exp(-rate / pieces)
        c, k, x = p, 0, u(doc_id, hashlib.md5((text or "").encode()).hexdigest(), i)
        while c <= x:
            k += 1
            p *= rate / pieces / k
            c += p
        count += k
    return count


def brute(rows, weight, budget=1.0):
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1] or "") + 1
    w = {s: weight(s, n) for s, n in size.items()}
    whole, scale = sum(size.values()) * budget, sum(w.values())
    out = Counter()
    for r in rows:
        for copy in range(1, poisson(w[r[3]] / scale * whole / size[r[3]], r[0], r[1]) + 1):
            out[(r[0], r[1], r[2], r[3], copy)] += 1
    return out


def result(df):
    return Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["copy"]) for r in df.collect())


def test_default_weights_match_brute_force(awkward):  # noqa: F811
    assert result(mixing.mix(awkward)) == brute(awkward_rows(), lambda s, n: math.sqrt(n))


@pytest.mark.parametrize("limit", [mixing.BROADCAST_SOURCES, -1])
def test_given_weights_and_large_rates(spark, awkward, monkeypatch, limit):  # noqa: F811
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", limit)
    weights = spark.createDataFrame([("src0", 1.0), ("src1", 0.0), ("src2", 200.0), ("none", 5.0), ("src0", 1.0)], "source string, weight double")
    own = {"src0": 1.0, "src2": 200.0}
    got = result(mixing.mix(awkward, weights, budget=50.0))
    assert got == brute(awkward_rows(), lambda s, n: own.get(s, 0.0), 50.0)
    assert max(k[4] for k in got) > 100


def test_shares_follow_the_weights(spark):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.when(F.col("id") % 3 > 0, "big").otherwise("small").alias("source"))
    weights = spark.createDataFrame([("big", 0.5), ("small", 0.5)], "source string, weight double")
    n = Counter({r["source"]: r["count"] for r in mixing.mix(df, weights).groupBy("source").count().collect()})
    assert abs(n["big"] / 15_000 - 1) < 0.03 and abs(n["small"] / 15_000 - 1) < 0.03


def test_order_is_shuffled_and_repeatable(awkward):  # noqa: F811
    a = [(r["doc_id"], r["copy"]) for r in mixing.mix(awkward).orderBy("shuffle_key", "doc_id").collect()]
    b = [(r["doc_id"], r["copy"]) for r in mixing.mix(awkward.repartition(7)).orderBy("shuffle_key", "doc_id").collect()]
    assert a == b and a != sorted(a, key=str)


def test_empty_and_clashing_columns(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(i, "a", "s", "mine", 2.0, 3) for i in range(20)], "doc_id int, text string, source string, mix_source string, RATE double, mix_cdf int")
    got = mixing.mix(df)
    assert got.columns == ["doc_id", "text", "source", "mix_source", "mix_cdf", "rate", "n_copies", "copy", "shuffle_key"]
    assert {r["rate"] for r in got.collect()} == {1.0}
    none = spark.createDataFrame([], "source string, weight double")
    assert mixing.mix(df, none).count() == 0


def test_no_python_in_the_plan(awkward):  # noqa: F811
    plan = mixing.mix(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
