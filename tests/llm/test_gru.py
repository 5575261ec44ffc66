import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA, awkward, awkward_rows, words_ascii  # noqa: F401
from tidemark.llm import gru
from tidemark.llm.common import text_slices

END = object()


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def brute_base(rows):
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update([*words_ascii(t), END])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = [*words_ascii(t), END]
        out.append((i, held(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)))
    return out


@pytest.mark.parametrize("head", [gru.HEAD_WORDS, 5])
def test_base_matches_brute_force(awkward, head):  # noqa: F811
    rows = [(r[0], r[1]) for r in awkward_rows()]
    got = gru.score_texts(awkward.withColumn("row", F.lit(1)), head_words=head).collect()
    key = lambda r: tuple(map(str, r[:5]))
    a = sorted([(g["doc_id"], g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"], g["base_score"]) for g in got], key=key)
    b = sorted(brute_base(rows), key=key)
    assert [x[:5] for x in a] == [x[:5] for x in b]
    assert sorted(round(x[5], 6) for x in a) == sorted(round(x[5], 6) for x in b)
    assert all(g["score"] < 0 and math.isfinite(g["score"]) for g in got)


def setup(n=60, words=None):
    texts = pa.array([r[1] for r in awkward_rows()][:n])
    hashes, rows = zip(*((h, np.bincount(r, minlength=len(o) - 1)) for (h, r), o in ((gru.tokens(b, o), o) for b, o in text_slices(texts))))
    h, sizes = np.concatenate(hashes), np.concatenate(rows)
    u, c = np.unique(h, return_counts=True)
    o = np.argsort(-c, kind="stable")[:words]
    vocab = gru.Vocabulary(u[o], c[o], int(c.sum()), len(u))
    return vocab, gru.Texts(vocab.ranks(h), sizes, vocab)


def test_probabilities_sum_to_one():
    vocab, _ = setup(words=40)
    rng = np.random.default_rng(2)
    p = gru.unpacked(gru.initial(vocab) + rng.normal(0, 0.05, gru.PARAMETERS).astype(np.float32))
    h = rng.normal(0, 1, (1, gru.HIDDEN)).astype(np.float32)
    k = len(vocab.classes)
    words = np.arange(k)
    first = np.repeat(h, k, axis=0)
    logs = gru.token_log_probs(p, first, vocab.classes, np.where(vocab.classes < gru.WORDS // gru.CLASS_WORDS, vocab.inputs, -1)) + vocab.fixed
    rare = gru.token_log_probs(p, h, np.array([gru.RARE]), np.array([-1]))
    assert len(words) == 40 and abs(np.exp(logs).sum() + np.exp(rare).sum() - 1) < 0.02  # bins hold a half count for words unseen


def test_state_is_carried_and_batches_do_not_matter(monkeypatch):
    vocab, texts = setup()
    flat = gru.initial(vocab) + np.random.default_rng(1).normal(0, 0.2, gru.PARAMETERS).astype(np.float32)
    whole = gru.log_likelihoods(flat, texts)
    monkeypatch.setattr(gru, "WINDOW", 3)
    assert np.allclose(gru.log_likelihoods(flat, texts), whole, atol=1e-3)
    # One text alone has the values it has among others.
    i = int(np.argmax(texts.size < 50))
    begin, size = texts.begin[i], texts.size[i]
    alone = gru.Texts.__new__(gru.Texts)
    alone.size, alone.falling, alone.begin = np.array([size]), np.array([-size]), np.array([0])
    for name in ("cls", "word", "fixed", "inp"):
        setattr(alone, name, getattr(texts, name)[begin : begin + size])
    assert np.allclose(gru.log_likelihoods(flat, alone), whole[begin : begin + size], atol=1e-3)


def plain_log_probs(p, inp, cls, word):
    """One text token by token in float64: update and reset gate, candidate, class, word."""
    p = {k: v.astype(np.float64) for k, v in p.items()}
    h, out = np.zeros(gru.HIDDEN), []
    for i, c, w in zip(inp, cls, word):
        z, r = (1 / (1 + np.exp(-(p["x"][j, i] + h @ p["u"][j + 1]))) for j in (0, 1))
        new = np.tanh(p["x"][2, i] + r * (h @ p["u"][0]))
        h = z * h + (1 - z) * new
        v = h @ p["wc"] + p["bc"]
        out.append(v[c] - np.log(np.exp(v).sum()))
        if w >= 0:
            v = h @ p["ww"][c] + p["bw"][c]
            out[-1] += v[w % gru.CLASS_WORDS] - np.log(np.exp(v).sum())
    return np.array(out)


@pytest.mark.parametrize("rows", [gru.ROWS, 7])
def test_scores_equal_a_plain_network_in_blocks_of_any_size(monkeypatch, rows):
    monkeypatch.setattr(gru, "ROWS", rows)
    monkeypatch.setattr(gru, "STATES", 300)
    vocab, texts = setup(words=600)
    flat = gru.initial(vocab) + np.random.default_rng(4).normal(0, 0.3, gru.PARAMETERS).astype(np.float32)
    got = gru.log_likelihoods(flat, texts)
    for begin, size in zip(texts.begin.tolist(), texts.size.tolist()):
        own = slice(begin, begin + min(size, 200))
        want = plain_log_probs(gru.unpacked(flat), texts.inp[own], texts.cls[own], texts.word[own]) + texts.fixed[own]
        assert np.allclose(got[own], want, atol=2e-3)


def test_scoring_and_a_window_stay_small_whatever_the_group():
    # A step's and a window's arrays follow ROWS, not the number of texts of the group.
    vocab, _ = setup()
    n, size = 20_000, 40
    ranks = np.random.default_rng(6).integers(0, len(vocab.counts), n * size).astype(np.int32)
    texts = gru.Texts(ranks, np.full(n, size), vocab)
    tracemalloc.start()
    out = gru.log_likelihoods(gru.initial(vocab), texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == n * size and peak < 40 << 20  # before the blocks of texts: 322 MB


def test_gradient_matches_differences():
    vocab, texts = setup(n=6)
    rng = np.random.default_rng(3)
    flat = gru.initial(vocab) + rng.normal(0, 0.1, gru.PARAMETERS).astype(np.float32)
    k = int(min(texts.size.max(), gru.WINDOW))

    def loss(v):
        ll = gru.log_likelihoods(v.astype(np.float32), texts) - texts.fixed
        own = np.concatenate([texts.begin[: texts.running(t)] + t for t in range(k)])
        return -ll[own].mean()

    trainer = gru.Trainer(flat, 0.0)
    trainer._window(texts, np.zeros((len(texts.size), gru.HIDDEN), np.float32), 0, k)
    grad = trainer.m / 0.1
    norm = 1.0
    big = np.argsort(-np.abs(grad))[[0, 3, 10, 40, 200]]
    ratio = []
    for i in big:
        a, b = flat.astype(np.float64).copy(), flat.astype(np.float64).copy()
        a[i] += 1e-2
        b[i] -= 1e-2
        ratio.append((loss(a) - loss(b)) / 2e-2 / grad[i])
    # Gradients over length 1 are scaled down by one factor for all.
    norm = ratio[0]
    assert norm >= 0.95 and np.allclose(ratio, norm, rtol=0.08)


def test_training_beats_the_counts_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = gru.score_texts(docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 10_000_000)).unionByName(docs.withColumn("doc_id", F.col("doc_id") + 20_000_000)))
    r = got.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_scores_do_not_depend_on_the_layout_and_beat_the_counts_without_copies(spark, monkeypatch):
    monkeypatch.setattr(gru, "SHARD_TOKENS", 40_000)  # three shards a round
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    taught = docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 1).select("text").distinct()
    runs = []
    for parts in (1, 8):
        got = gru.score_texts(docs.orderBy("text" if parts == 1 else "doc_id").repartition(parts)).where("held_out")
        runs.append({r["doc_id"]: r for r in got.join(docs.join(taught, "text", "left_anti").select("doc_id"), "doc_id").collect()})
    one, eight = runs
    assert len(one) > 100 and one.keys() == eight.keys()
    assert all(math.isclose(one[i]["score"], eight[i]["score"], rel_tol=1e-4) for i in one)
    assert sum(r["score"] for r in one.values()) > sum(r["base_score"] for r in one.values())


def test_rounds_cover_every_training_document_once(awkward, monkeypatch):  # noqa: F811
    rounds = []

    def spy(docs, vocab, flat, *_):
        rounds.append([(r["id"], r["text"]) for r in docs.collect()])
        return flat

    monkeypatch.setattr(gru, "train_round", spy)
    copies = awkward.sparkSession.createDataFrame([(1000 + i, "one text of many ids", "en", "s", 1) for i in range(60)], SCHEMA)
    gru.score_texts(awkward.unionByName(copies))
    want = [(r[0], r[1]) for r in awkward_rows()] + [(1000 + i, "one text of many ids") for i in range(60)]
    key = lambda r: tuple(map(str, r))
    assert sorted(sum(rounds, []), key=key) == sorted([r for r in want if not held(r[0])], key=key)
    assert all(any(t == "one text of many ids" for _, t in r) for r in rounds)


def test_empty_tables_and_no_training_rows(spark):
    assert gru.score_texts(spark.createDataFrame([], SCHEMA)).count() == 0
    i = next(i for i in range(100) if held(i))
    rows = gru.score_texts(spark.createDataFrame([(i, "a b", "en", "s", 1), (i, None, None, None, None)], SCHEMA)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) for r in rows) == [(1, 0, 0, True), (3, 0, 0, True)]
    assert all(math.isfinite(r["score"]) and r["base_score"] == 0.0 for r in rows)


def test_average_of_partitions_without_texts(spark):
    vocab, _ = setup()
    flat = gru.initial(vocab)
    assert np.array_equal(gru.train_round(spark.createDataFrame([], SCHEMA), vocab, flat, 0.01), flat)
