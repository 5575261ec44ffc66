import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA, awkward, awkward_rows  # noqa: F401
from tidemark.llm import align


@pytest.fixture(scope="module")
def models():
    return align.ByteLevel(align.tokenizer_path("byte_bpe_50k.json")), align.Pieces(align.tokenizer_path("piece_bpe_32k.model"))


def test_plain_files_give_the_ids_of_the_tokenizer_library(models):
    path = align.tokenizer_path("byte_bpe_50k.json")
    texts = [r[1] or "" for r in awkward_rows()] + [t for _, t in SPECIAL]
    texts += [f" a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)}'{chr(c)}s  {chr(c)}\n" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for got, want in zip(align.ByteLevel(path).encode(texts), align.ByteLevel(path, plain=False).encode(texts)):
        assert np.array_equal(got, want)


def spans(model, text, prefix):
    """(start, end, id) of the tokens, or None if their bytes are not the text's."""
    out, at = [], 0
    want = (" " + text).encode()
    for i in model.encode([text])[0].tolist():
        token = model.vocab.data[model.vocab.start[i] : model.vocab.start[i] + model.vocab.size[i]].tobytes()
        if want[at : at + len(token)] != token:
            return None
        out.append((at, at + len(token), i))
        at += len(token)
    return out if at == len(want) else None


def brute(rows, models):
    per, held = [], Counter()
    for _, text in rows:
        a, b = (spans(m, text, i) if text else None for i, m in enumerate(models))
        if a is None or b is None:
            per.append(None)
            continue
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        cuts = [0, *sorted({x[1] for x in a} & {y[1] for y in b})]
        parts = ["|".join(",".join(str(t[2]) for t in side if p < t[1] <= q) for side in (a, b)) for p, q in zip(cuts, cuts[1:])]
        per.append((len(a), len(b), len(parts), links, hashlib.sha256(";".join(parts).encode()).hexdigest()))
        held.update(set(links))
    most = {}
    for (a, _), n in held.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for (i, _), p in zip(rows, per):
        if p is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((i, p[0], p[1], p[2], len(p[3]), sum(held[x] == most[x[0]] for x in p[3]), sum(held[x] for x in p[3]), p[4]))
    return sorted(out, key=str)


SPECIAL = [
    (1, "<|endoftext|> <s>[INST] </s> <unk> <0x41>"), (2, "  two  spaces \n\n and\ttabs "), (3, "▁ a real lower block ▁▁"), (4, "日本語のテキスト مرحبا 😀 naïve"),
    (5, "x" * 300), (6, "  odd   spaces \x00 nul"), (7, "é combining"), (8, "a"), (9, " "),
]


@pytest.mark.parametrize("limit", [align.BROADCAST_ROWS, 200, 0])
def test_rows_match_brute_force(spark, models, limit):
    rows = [(r[0], r[1]) for r in awkward_rows() if r[1] is None or len(r[1]) < 5_000] + SPECIAL
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumn("id", F.lit("x")).withColumn("PAIRS", F.lit(1))
    got = align.align(df, broadcast_rows=limit)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, models)


def test_long_text(awkward, models):  # noqa: F811
    row = next(r for r in align.align(awkward).collect() if r["doc_id"] == 106)
    text = next(r[1] for r in awkward_rows() if r[0] == 106)
    assert (row["n_a"], row["n_b"]) == tuple(len(m.encode([text])[0]) for m in models) and row["n_a"] > 20_000


def test_a_chain_without_a_common_cut_is_one_group():
    end_a, end_b = np.arange(2, 2_001, 2), np.append(np.arange(1, 2_000, 2), 2_000)
    a, b = align.group_ends(end_a, end_b)
    assert set(a) | set(b) == {len(end_a) - 1}


def test_empty_table(spark):
    assert align.align(spark.createDataFrame([], SCHEMA)).count() == 0
