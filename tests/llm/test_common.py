import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import awkward_rows, words_ascii
from tidemark.llm import common


def test_words_and_hashes_match_python():
    texts = [r[1] for r in awkward_rows()]
    seen = {}
    got = []
    for max_bytes in (1, 300, 1 << 18):
        per_row = []
        for buf, offs in common.text_slices(pa.array(texts), max_bytes):
            low = common.LOWER[buf]
            s, e, row = common.word_spans(low, offs, common.ASCII_SPACE)
            h = common.span_hashes(low, s, e)
            for r in range(len(offs) - 1):
                own = [bytes(low[a:z]).decode() for a, z, q in zip(s, e, row) if q == r]
                per_row.append(own)
            for a, z, v in zip(s, e, h):
                seen.setdefault(bytes(low[a:z]), set()).add(int(v))
        got.append(per_row)
    want = [words_ascii(t) for t in texts]
    assert got[0] == got[1] == got[2] == want
    assert all(len(v) == 1 for v in seen.values())
    assert len({next(iter(v)) for v in seen.values()}) == len(seen)
    assert all(common.hash_word(w) == next(iter(v)) for w, v in list(seen.items())[:50])


def test_rows_that_touch_do_not_share_words():
    (buf, offs), = common.text_slices(pa.array(["ab", "cd", "", "e f", None, "g"]))
    s, e, row = common.word_spans(buf, offs, common.ASCII_SPACE)
    assert [(bytes(buf[a:z]).decode(), int(r)) for a, z, r in zip(s, e, row)] == [("ab", 0), ("cd", 1), ("e", 3), ("f", 3), ("g", 5)]


def test_sliced_and_empty_arrays():
    a = pa.array(["x", "yy", None, "zzz"]).slice(1)
    assert [bytes(b) for b, _ in common.text_slices(a)] == [b"yyzzz"]
    assert list(common.text_slices(pa.array([], pa.string()))) == []
    assert len(common.per_slice(lambda b, o: np.diff(o).astype(float), pa.array([], pa.string()))) == 0


def test_powers_grow():
    rng = random.Random(1)
    b = np.frombuffer(bytes(rng.randrange(256) for _ in range(5000)), np.uint8)
    h = common.span_hashes(b, np.array([0, 4000]), np.array([1000, 5000]))
    assert int(h[1]) == int(common.span_hashes(b[4000:], np.array([0]), np.array([1000]))[0])


@pytest.mark.parametrize("taken,want", [(["x"], "y"), (["Y", "_y"], "__y")])
def test_spare_name(spark, taken, want):
    df = spark.createDataFrame([(1,) * len(taken)], taken)
    assert common.spare_name(df, "y") == want
