"""Quality classifier: naive Bayes support vectors over n-gram indicators.

N-grams run over two readings of a text: its words (a word that repeats the one before
is the symbol "again"), and the words' shapes (letters and digits reduced to runs of upper case,
lower case and digits, other characters as they are). Presence indicators are scaled by
the naive Bayes log-count ratio of the classes, rows have unit length, and a linear
hinge-loss model is fitted by dual coordinate descent on a bounded sample of labelled rows
(``linear.PER_CLASS`` of each class). A sigmoid on held-out margins makes the
score a probability at the classes' shares in all labelled rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import linear
from tidemark.llm.common import ASCII_SPACE, fold, mix, quoted, span_hashes, spare_name, word_spans

BITS = 19
COST = 1.0
PASSES = 12
MIN_RATIO = 0.5  # an n-gram about as frequent in both classes is left out
THRESHOLD = 0.7
HELD_OUT_FOLD, FOLDS = 2, 4

#: Character class of each byte: upper case A, lower case and letters beyond ASCII a, digits 0, others themselves.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91] = 65
SHAPE[97:123] = 97
SHAPE[128:] = 97
SHAPE[48:58] = 48
#: Classes of which every character is written, not one for a run.
SINGLE = np.ones(256, bool)
SINGLE[[65, 97, 48]] = False

_AGAIN = np.uint64(0xA5A5A5A5DEADBEEF)
_NEXT = np.uint64(0xBF58476D1CE4E5B9)
_KIND = [np.uint64(k * 0x632BE59BD9B4E019 % (1 << 64)) for k in range(1, 6)]


def _hashed(buf: np.ndarray, offs: np.ndarray, used: np.ndarray | None = None):
    """Yield (row, feature) of all word 1- and 2-grams and shape 1- to 3-grams, repeats included; with ``used`` only of those it flags."""
    s, e, row = word_spans(buf, offs, ASCII_SPACE)
    if not len(s):
        return
    word = span_hashes(buf, s, e)
    same = row[1:] == row[:-1]
    word[1:][same & (word[1:] == word[:-1])] = _AGAIN
    kind = SHAPE[buf]
    keep = np.empty(len(buf), bool)
    keep[0] = True
    keep[1:] = (kind[1:] != kind[:-1]) | SINGLE[kind[1:]]
    keep[s] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    shape = span_hashes(kind[keep], at[s], at[e])
    third = same[1:] & same[:-1]
    grams = [
        (row, word + _KIND[0]),
        (row[1:][same], (word[:-1] * _NEXT + word[1:] + _KIND[1])[same]),
        (row, shape + _KIND[2]),
        (row[1:][same], (shape[:-1] * _NEXT + shape[1:] + _KIND[3])[same]),
        (row[2:][third], ((shape[:-2] * _NEXT + shape[1:-1]) * _NEXT + shape[2:] + _KIND[4])[third]),
    ]
    for r, h in grams:
        f = (mix(h) >> np.uint64(64 - BITS)).astype(np.int64)
        ok = slice(None) if used is None else used[f]
        yield r[ok], f[ok]


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, unique and sorted."""
    return linear.unique_pairs(_hashed(buf, offs), BITS)


def train(docs: DataFrame, labels: DataFrame, keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label: str = "quality") -> linear.Model:
    """Fit on the labelled rows that ``keep`` (a condition on ``labels``) admits, by default all but the held-out fold."""
    if keep is None:
        keep = fold(F.col(id_col), FOLDS) != HELD_OUT_FOLD
    x, y, weight = linear.training_rows(docs, labels, label, keep, features, id_col, text_col)
    return linear.fit(x, y, weight, 1 << BITS, unit=True, cost=COST, passes=PASSES, min_ratio=MIN_RATIO)


def score(model: linear.Model, text: Column) -> Column:
    return linear.score(model, linear.Used(_hashed, model, BITS), text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted per row of ``docs``.

    Null and empty texts get the score of a text without n-grams; repeated rows get equal scores; a null id is never held
    out; an empty table returns no rows, and without labels of both classes every score is the share of class 1.
    """
    model = train(docs, labels, None, id_col, text_col)
    scored = docs.select(quoted(id_col).alias(id_col), score(model, quoted(text_col)).alias("score"))
    return scored.select(id_col, (fold(F.col(id_col), FOLDS) == HELD_OUT_FOLD).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score is under ``threshold``; all columns stay."""
    model = train(docs, labels, None, id_col, text_col)
    col = spare_name(docs, "quality_score")
    return docs.withColumn(col, score(model, quoted(text_col))).where(quoted(col) >= threshold).select(*map(quoted, docs.columns))
