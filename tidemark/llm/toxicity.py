"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

N-grams of ``SIZES`` code points of the lower-cased text (A-Z), white space runs as
one space, are presence indicators scaled by the log-count ratio of toxic against other texts; n-grams
with a ratio near zero say nothing and are left out. The linear model is fitted on
a bounded sample of labelled rows (``linear.PER_CLASS`` of each class) and calibrated by a sigmoid. Rows are not
brought to unit length, so a short insult counts as much in a long text as in a short one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import linear
from tidemark.llm.common import ASCII_SPACE, LOWER, fold, quoted

SIZES = (4, 5, 6)
BITS = 20
COST = 0.1
PASSES = 15
MIN_RATIO = 0.7
HELD_OUT_FOLD, FOLDS = 0, 5

_NEXT = np.uint32(0x9E3779B1)
_LAST = np.uint32(0x85EBCA77)


def _hashed(buf: np.ndarray, offs: np.ndarray, used: np.ndarray | None = None):
    """Yield (row, feature) of all n-grams, repeats included, one size at a time; with ``used`` only of those it flags."""
    low = LOWER[buf].copy()
    gap = ASCII_SPACE[low]
    low[gap] = 32
    again = np.zeros(len(low), bool)
    again[1:] = gap[1:] & gap[:-1]
    starts = offs[:-1][offs[:-1] < len(low)]
    again[starts] = False
    kept = np.concatenate([[0], np.cumsum(~again)])
    low, offs = low[~again], kept[offs]
    lead = (low & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(lead)])
    chars = np.frombuffer(low.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(chars) != at[-1]:  # ill-formed bytes: read as single characters
        chars, at = low, np.arange(len(low) + 1)
    ends = at[offs]
    row = np.repeat(np.arange(len(offs) - 1), np.diff(ends))
    left = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(chars))
    chars = chars.astype(np.uint32) + np.uint32(1)
    for n in SIZES:
        if len(chars) < n:
            continue
        h = chars[: len(chars) - n + 1] + np.uint32(n << 24)
        for j in range(1, n):
            h *= _NEXT
            h += chars[j : len(chars) - n + 1 + j]
        h *= _LAST
        h ^= h >> np.uint32(15)
        h *= _NEXT
        h >>= np.uint32(32 - BITS)
        ok = np.flatnonzero(left[: len(h)] >= n) if used is None else np.flatnonzero(used[h])
        ok = ok[left[ok] >= n]
        yield row[ok], h[ok].astype(np.int64)


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs of the texts' n-grams, unique and sorted."""
    return linear.unique_pairs(_hashed(buf, offs), BITS)


def train(docs: DataFrame, labels: DataFrame, keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> linear.Model:
    """Fit on the labelled rows that ``keep`` (a condition on ``labels``) admits, by default all but the held-out fold."""
    if keep is None:
        keep = fold(F.col(id_col), FOLDS) != HELD_OUT_FOLD
    x, y, weight = linear.training_rows(docs, labels, label, keep, features, id_col, text_col)
    return linear.fit(x, y, weight, 1 << BITS, unit=False, cost=COST, passes=PASSES, min_ratio=MIN_RATIO)


def score(model: linear.Model, text: Column) -> Column:
    return linear.score(model, linear.Used(_hashed, model, BITS), text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted per row of ``docs``.

    Null and empty texts get the score of a text without n-grams; repeated rows get equal scores; a null id is never held
    out; an empty table returns no rows, and without labels of both classes every score is the share of class 1.
    """
    model = train(docs, labels, None, id_col, text_col)
    scored = docs.select(quoted(id_col).alias(id_col), score(model, quoted(text_col)).alias("score"))
    return scored.select(id_col, (fold(F.col(id_col), FOLDS) == HELD_OUT_FOLD).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
