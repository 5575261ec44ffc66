"""Linear models over hashed n-gram indicators scaled by naive Bayes log-count ratios.

Used by the quality and toxicity classifiers. Training takes a bounded sample of the
labelled rows (``PER_CLASS`` of each class and ``MAX_BYTES`` of feature sets, those with the smallest hashed id); the texts of the
sample are reduced to feature sets in Spark tasks. Spark counts the rows of each feature, and only features of ``MIN_ROWS`` rows or more
reach the driver, where the model is fitted; the others have ratio 0 and would not change it. Scoring is one Arrow UDF over whole texts with a weight table of fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_slice, quoted, text_slices
from tidemark.session import materialize

PER_CLASS = 2500  # most training rows of each class
MAX_BYTES = 256 << 20  # most bytes of feature sets (4 a feature) that the driver takes, half of them for each class
MIN_ROWS = 3  # an n-gram of fewer training texts has ratio 0

#: (bytes, row offsets) -> (row, feature) pairs, unique and sorted by row.
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def unique_pairs(pairs, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs, sorted by row."""
    pairs = list(pairs)
    if not pairs:
        z = np.zeros(0, np.int64)
        return z, z
    key = np.unique(np.concatenate([(r << bits) | f for r, f in pairs]))
    return key >> bits, key & ((1 << bits) - 1)


class Used:
    """The features of a text that a model knows; the others add nothing to a score and are not sorted."""

    def __init__(self, hashed: Callable, model: "Model", bits: int):
        self.hashed, self.bits = hashed, bits
        self.used = model.weight != 0 if model.square is None else model.square != 0

    def __call__(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return unique_pairs(self.hashed(buf, offs, self.used), self.bits)


#: Feature numbers of each row (uint32 views of the collected Arrow buffers; never joined into one array).
Rows = list[np.ndarray]


def sums(rows: Rows, values: np.ndarray) -> np.ndarray:
    return np.array([values[r].sum(dtype=np.float64) for r in rows])


@dataclass
class Model:
    """score = sigmoid(a * margin + b); margin = (sum of weight + bias) / norm."""

    weight: np.ndarray
    square: np.ndarray | None  # squared ratios, for unit-length rows
    bias: float
    a: float
    b: float

    def margins(self, weight: np.ndarray, square: np.ndarray | float) -> np.ndarray:
        m = weight + self.bias
        return m / np.sqrt(square + 1.0) if self.square is not None else m

    def scores(self, margin: np.ndarray) -> np.ndarray:
        return sigmoid(self.a * margin + self.b)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def log_count_ratios(rows: Rows, y: np.ndarray, dims: int, min_rows: int = MIN_ROWS) -> np.ndarray:
    """log(p / q) with p and q the shares of the texts of class 1 and 0 that have the n-gram (one text and one without added)."""
    counts = np.zeros((2, dims), np.int32)
    for r, c in zip(rows, y):
        counts[c][r] += 1  # a row has each feature once
    neg, pos = counts
    ratio = np.log((pos + 1.0) / ((y == 1).sum() + 2)) - np.log((neg + 1.0) / ((y == 0).sum() + 2))
    ratio[pos + neg < min_rows] = 0.0
    return ratio


def dual_coordinate_descent(x: Rows, y: np.ndarray, ratio: np.ndarray, unit: bool, cost: float, passes: int, seed: int = 1) -> tuple[np.ndarray, float]:
    """Hinge-loss linear model of the scaled rows; returns the weights of the scaled features and the bias.

    One dual variable per row, visited in random order; ``cost`` bounds them, divided evenly between the classes.
    """
    w, bias = np.zeros(len(ratio)), 0.0
    sign = np.where(y == 1, 1.0, -1.0)
    share = np.where(y == 1, len(y) / max(1, 2 * (y == 1).sum()), len(y) / max(1, 2 * (y == 0).sum()))
    top = cost * share
    dual = np.zeros(len(y))
    rows = []
    for f in x:
        f = f[ratio[f] != 0]
        v = ratio[f].astype(np.float32)
        square = float(np.square(v, dtype=np.float64).sum()) + 1.0
        scale = 1.0 / np.sqrt(square) if unit else 1.0
        rows.append((f, v * np.float32(scale), scale, square * scale * scale))
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        for i in rng.permutation(len(y)):
            f, v, one, q = rows[i]
            slope = sign[i] * (w[f] @ v + bias * one) - 1.0
            new = min(max(dual[i] - slope / q, 0.0), top[i])
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                w[f] += step * v
                bias += step * one
                dual[i] = new
    return w, bias


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Sigmoid through held-out margins by Newton steps; ``weight`` restores the classes' true shares."""
    n1, n0 = weight[y == 1].sum(), weight[y == 0].sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, float(np.log((n1 + 1) / (n0 + 1)))

    def loss(a: float, b: float) -> float:
        z = a * margin + b
        return float((weight * (np.logaddexp(0, z) - target * z)).sum() + 1e-3 * a * a)

    now = loss(a, b)
    for _ in range(100):
        p = sigmoid(a * margin + b)
        g, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-12)
        ga, gb = (g * margin).sum() + 2e-3 * a, g.sum()
        haa, hab, hbb = (h * margin * margin).sum() + 2e-3, (h * margin).sum(), h.sum() + 1e-9
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = 1.0
        while step > 1e-6 and (new := loss(a - step * da, b - step * db)) > now:
            step /= 2
        if step <= 1e-6:
            break
        a, b = a - step * da, b - step * db
        if now - new < 1e-10 * abs(now):
            break
        now = new
    return float(a), float(b)


def fit(x: Rows, y: np.ndarray, row_weight: np.ndarray, dims: int, unit: bool, cost: float, passes: int, min_ratio: float = 0.0, folds: int = 3) -> Model:
    """Model of the rows; the sigmoid is fitted on margins of rows that the model of their fold has not seen.

    Without rows of both classes the score is the share of class 1 for every text (one half without any row).
    """
    if len(y) == 0 or (y == 1).all() or (y == 0).all():
        share = float((row_weight[y == 1].sum() + 0.5) / (row_weight.sum() + 1.0))
        return Model(np.zeros(dims, np.float32), np.zeros(dims, np.float32) if unit else None, 0.0, 0.0, float(np.log(share / (1 - share))))

    def train(rows: np.ndarray) -> Model:
        part = [x[i] for i in rows]
        r = log_count_ratios(part, y[rows], dims)
        r[np.abs(r) < min_ratio] = 0.0
        w, bias = dual_coordinate_descent(part, y[rows], r, unit, cost, passes)
        return Model((w * r).astype(np.float32), (r * r).astype(np.float32) if unit else None, bias, 1.0, 0.0)

    part = np.empty(len(y), np.int64)
    for c in (0, 1):  # every fold gets its share of each class
        own = np.flatnonzero(y == c)
        part[own] = np.arange(len(own)) % folds
    margin = np.zeros(len(y))
    for k in range(folds):
        own = np.flatnonzero(part == k)
        rest = np.flatnonzero(part != k)
        if len(own) and len(set(y[rest])) == 2:
            m, s = train(rest), [x[i] for i in own]
            margin[own] = m.margins(sums(s, m.weight), sums(s, m.square) if unit else 0.0)
    model = train(np.arange(len(y)))
    model.a, model.b = platt(margin, y, row_weight)
    return model


def frequent(sets: DataFrame, min_rows: int = MIN_ROWS) -> np.ndarray:
    """Flags of the features that ``min_rows`` rows or more of ``sets`` (binary column ``f``) have, as far as the last such feature."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for one in batch.column(0):
                f = np.frombuffer(one.as_buffer(), np.uint32)
                if len(f):
                    total = np.pad(total, (0, max(0, int(f.max()) + 1 - len(total))))
                    total[f] += 1  # a row has each feature once
        at = np.flatnonzero(total)
        for i in range(0, len(at), 1 << 16):
            part = at[i : i + (1 << 16)]
            yield pa.record_batch([pa.array(part, pa.int64()), pa.array(total[part], pa.int64())], names=["feature", "n"])

    counts = sets.select("f").mapInArrow(counted, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= min_rows).select("feature").toArrow()["feature"].to_numpy()
    used = np.zeros(int(found.max()) + 1 if len(found) else 0, bool)
    used[found] = True
    return used


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, features: Features, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES
) -> tuple[Rows, np.ndarray, np.ndarray]:
    """Feature sets, classes and weights of the sample: of each class the ``per_class`` smallest hashed ids that ``keep`` admits.

    An id labelled twice has its larger label; a null id or label is left out; an id that several rows share brings the one
    with the smallest hashed text, so at most ``per_class`` rows of a class reach the driver. The sets hold the features of
    ``MIN_ROWS`` sample rows or more. Where those of a class exceed half of ``max_bytes``, its sample ends before (one row stays).
    """
    ids = labels.where(keep & F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(id_col).agg(F.max(label).cast("int").alias("y"))
    totals = {r["y"]: r["n"] for r in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}
    hashed = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 52))

    def smallest(y: int) -> DataFrame:
        # Hashes above this bound are far from the smallest ones; without them tasks sort and send only their share of the sample.
        bound = int((1 << 52) * min(1.0, (1.25 * per_class + 200) / max(1, totals.get(y, 0))))
        return ids.where((F.col("y") == y) & (hashed < bound)).orderBy(hashed, id_col).limit(per_class)

    sample = smallest(1).unionByName(smallest(0)).select(F.col(id_col).alias("sample_id"), "y", hashed.alias("place"))

    @F.arrow_udf("binary")
    def encode(col: pa.Array) -> pa.Array:
        out = []
        for buf, offs in text_slices(col):
            row, feature = features(buf, offs)
            cuts = np.searchsorted(row, np.arange(len(offs)))
            feature = feature.astype(np.uint32)
            out += [feature[a:z].tobytes() for a, z in zip(cuts, cuts[1:])]
        return pa.array(out, pa.binary())

    rows = docs.select(quoted(id_col).alias("sample_id"), quoted(text_col).cast("string").alias("t")).join(F.broadcast(sample), "sample_id")
    rows = rows.groupBy("sample_id", "y", "place").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    rows = materialize(rows.select("sample_id", "y", "place", encode("t").alias("f")), "linear-sample")
    used = frequent(rows)

    @F.arrow_udf("binary")
    def reduced(col: pa.Array) -> pa.Array:
        sets = [np.frombuffer(one.as_buffer(), np.uint32) for one in col]
        sets = [f[f < len(used)] for f in sets]
        return pa.array([f[used[f]].tobytes() for f in sets], pa.binary())

    rows = materialize(rows.select("sample_id", "y", "place", reduced("f").alias("f")), "linear-sets")
    sizes = sorted(map(tuple, rows.select("y", "place", F.length("f")).collect()))
    admitted = F.lit(False)
    for c in (0, 1):
        own = [(place, size) for y, place, size in sizes if y == c]
        if own:
            fits = int(np.searchsorted(np.cumsum([size for _, size in own]), max_bytes // 2, "right"))
            admitted = admitted | ((F.col("y") == c) & (F.col("place") <= own[max(1, fits) - 1][0]))
    got = rows.where(admitted).select("sample_id", "y", "f").toArrow()
    buffers = [f.as_buffer() for f in got["f"]]
    ids = got["sample_id"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], xxhash.xxh64_intdigest(buffers[i])))
    y = np.array(got["y"].to_pylist(), np.int64)[order]
    sets = [np.frombuffer(buffers[i], np.uint32) for i in order]
    seen = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.array([totals.get(int(c), 0) / seen[int(c)] for c in y])
    return sets, y, weight


def score(model: Model, features: Features, text: Column) -> Column:
    """Probability of class 1 for every text; a null or empty text has no n-gram but the bias."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def one(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
            row, feature = features(buf, offs)
            n = len(offs) - 1
            weight = np.bincount(row, weights=model.weight[feature], minlength=n)
            square = np.bincount(row, weights=model.square[feature], minlength=n) if model.square is not None else 0.0
            return model.scores(model.margins(weight, square))

        for col in batches:
            yield pa.array(per_slice(one, col), pa.float64())

    return run(text.cast("string"))
