import math
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.helpers import SCHEMA, awkward  # noqa: F401
from tests.llm.test_decontaminate import brute as brute_contamination
from tests.llm.test_mixing import brute as brute_mix
from tests.llm.test_simhash import brute as brute_near
from tidemark.llm import quality
from tidemark.llm.common import read

SF = "/root/testdata/sf0.001"


def test_stages_are_the_five_operators_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_matches_brute_force_of_each_stage(spark):
    docs = read(spark, SF, "documents")
    rows = {r["doc_id"]: tuple(r) for r in docs.collect()}
    good = {r["doc_id"] for r in quality.classify(docs, read(spark, SF, "labels")).collect() if r["predicted"]}
    assert len(good) > 0.7 * len(rows)
    near = brute_near([(i, rows[i][1]) for i in good])
    single = sorted({c for _, _, c in near})
    items = [(r["item_id"], r["text"]) for r in read(spark, SF, "benchmark").collect()]
    bad = {r[0] for r in brute_contamination([(i, rows[i][1]) for i in single], items) if r[4]}
    clean = [rows[i] for i in single if i not in bad]
    assert bad and len(single) < len(good)
    copies = brute_mix(clean, lambda s, n: math.sqrt(n))
    want = Counter()
    for (doc_id, text, lang, source, _), n in copies.items():
        want[(doc_id, text, lang, source)] += n
    out = corpus_pipeline.run(spark, SF)
    assert set(docs.columns) <= set(out.columns)
    got = out.collect()
    assert Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in got) == want
    loads, places = Counter(), {}
    for r in got:
        loads[r["shard"]] += len(r["text"].encode()) + 1
        places.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    largest = max(n * (len(k[1].encode()) + 1) for k, n in want.items())
    assert max(loads.values()) - min(loads.values()) <= largest


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_awkward_and_empty_documents(spark, awkward, stage):  # noqa: F811
    name, fn = corpus_pipeline.STAGES[stage]
    cols = SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")
    out = fn(spark, awkward, SF)
    assert set(cols) <= set(out.columns) if name == "sharding" else out.columns == cols
    assert out.count() > 0
    assert fn(spark, awkward.limit(0), SF).count() == 0
