"""Language-model scoring with a gated recurrent network.

Tokens are the words of a text (A-Z lower-cased) and one end. Spark counts every token of the training documents; these counts give the
base score and the vocabulary. The network predicts a token in two factors: its class,
then the token within the class. The ``WORDS`` most frequent tokens form classes with a softmax of their own;
less frequent words lie in frequency bins, and all words beyond the ``HEAD_WORDS`` most frequent in one rare
class, where the second factor is the word's share of the class's count (an unseen word counts as one half).

Training is data-parallel: in every round each task runs truncated back-propagation in numpy over one shard of the
round's training documents, and the parameters are averaged in Spark, weighted by tokens. Hashes of id and text deal
the training documents to the ``ROUNDS`` rounds, to shards of about ``SHARD_TOKENS`` tokens and to their order there. So each is trained on once, copies are spread, and
the model does not depend on files, partitions or cores. Scoring runs ``ROWS`` texts of a batch in step, longest first, in windows;
the state is carried from window to window, so the score is that of the complete text.

Counts of rare words are joined by shuffle: each text sends its distinct words beyond the broadcast
head (at most HEAD_WORDS entries of 16 bytes), whatever the size of the corpus's vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_SPACE, LOWER, fold, quoted, span_hashes, text_slices, word_spans
from tidemark.session import materialize

HIDDEN = 16
WORDS = 512
CLASS_WORDS = 16
BINS = 7
HEAD_WORDS = 1 << 18
ROUNDS = 3  # together they train on every training document once
SHARD_TOKENS = 1 << 20  # training tokens of a shard, of which a round has as many as the corpus fills
RATE = 0.01
WINDOW = 32
BATCH = 96
GROUP_TOKENS = 1 << 21  # tokens of the texts scored in step
ROWS = 1024  # texts scored in step at a time
STATES = 1 << 15  # states kept before their tokens are scored, if a window of ROWS texts has no more
PENDING = 1 << 20  # distinct words a task holds before it sends their counts
HELD_OUT_FOLD, FOLDS = 1, 5

END = np.uint64(0)  # the end's place among the word hashes
CLASSES = WORDS // CLASS_WORDS + BINS + 1
RARE = CLASSES - 1
START = WORDS + BINS + 1  # input id after which a text begins; bins and the rare class have one input id each
INPUTS = START + 1
NEVER = -1e4


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of all tokens of the slice in order: words, then one end for each row."""
    buf = LOWER[buf]
    s, e, row = word_spans(buf, offs, ASCII_SPACE)
    h = span_hashes(buf, s, e)
    h[h == END] = np.uint64(1)
    n = len(offs) - 1
    ends = np.cumsum(np.bincount(row, minlength=n))
    return np.insert(h, ends, END), np.insert(row, ends, np.arange(n))


def count_tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(h, n): count of every token of all texts; tasks send distinct tokens with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            u, inv = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return u, np.bincount(inv, weights=np.concatenate([h[1] for h in held])).astype(np.int64)

        def sent(u: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(u), 1 << 16):
                yield pa.record_batch([pa.array(u[i : i + (1 << 16)].view(np.int64)), pa.array(n[i : i + (1 << 16)])], names=["h", "n"])

        for batch in batches:
            for buf, offs in text_slices(batch.column(0)):
                held.append(np.unique(tokens(buf, offs)[0], return_counts=True))
                size += len(held[-1][0])
                if size > 2 * PENDING:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > PENDING:
                        yield from sent(*held[0])
                        held, size = [], 0
        if held:
            yield from sent(*merged())

    return docs.select(quoted(text_col).cast("string").alias("t")).mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The head of the vocabulary by falling count, and what the counts say of the rest."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        self.total, self.distinct = total, distinct
        self.counts = counts.astype(np.float64)
        order = np.argsort(hashes)
        self.sorted, self.rank = hashes[order], order.astype(np.int32)
        k = len(hashes)
        cut = min(WORDS, k)
        # Bins of growing rank ranges, each about twice the one before.
        edges = cut + np.round((k - cut) * (2.0 ** np.arange(BINS + 1) - 1) / (2.0**BINS - 1)).astype(np.int64)
        which = np.clip(np.searchsorted(edges, np.arange(cut, k), side="right") - 1, 0, BINS - 1)
        self.classes = np.concatenate([np.arange(cut) // CLASS_WORDS, WORDS // CLASS_WORDS + which]).astype(np.uint8)
        self.inputs = np.concatenate([np.arange(cut), WORDS + which]).astype(np.int16)
        self.rare_total, self.rare_distinct = total - counts.sum(), distinct - k
        mass = np.bincount(self.classes, weights=self.counts, minlength=CLASSES)
        kinds = np.bincount(self.classes, minlength=CLASSES)
        mass[RARE] = self.rare_total + 1
        self.class_mass = mass
        self.fixed = np.zeros(k)  # log of the share within a bin
        own = np.arange(cut, k)
        c = self.classes[own]
        self.fixed[own] = np.log((self.counts[own] + 0.5) / (mass[c] + 0.5 * kinds[c]))
        self.fixed = self.fixed.astype(np.float32)

    def ranks(self, h: np.ndarray) -> np.ndarray:
        """Rank of each hash, -1 beyond the head."""
        if not len(self.sorted):
            return np.full(len(h), -1, np.int32)
        u, inv = np.unique(h, return_inverse=True)
        i = np.minimum(np.searchsorted(self.sorted, u), len(self.sorted) - 1)
        return np.where(self.sorted[i] == u, self.rank[i], np.int32(-1))[inv]


# The cell's parts one after the other, each a matrix of its own: of ``x`` update, reset, candidate; of ``u`` candidate, update, reset.
# So the gradients of both are neighbouring matrices of one array.
SHAPES = {
    "x": (3, INPUTS, HIDDEN), "u": (3, HIDDEN, HIDDEN), "wc": (HIDDEN, CLASSES), "bc": (CLASSES,),
    "ww": (WORDS // CLASS_WORDS, HIDDEN, CLASS_WORDS), "bw": (WORDS // CLASS_WORDS, CLASS_WORDS),
}
PARAMETERS = sum(int(np.prod(s)) for s in SHAPES.values())
X_SIGNS, U_SIGNS = (np.array(f, np.float32)[:, None, None] for f in ((-1, -1, 1), (1, -1, -1)))  # sigmoid(v) = 1 / (1 + exp(-v))
ONE = np.float32(1)


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the parameters by name."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def initial(vocab: Vocabulary) -> np.ndarray:
    """Small random weights; biases that make the untrained network the unigram model of the counts."""
    rng = np.random.default_rng(7)
    flat = np.zeros(PARAMETERS, np.float32)
    p = unpacked(flat)
    p["x"][:] = rng.normal(0, 0.1, (INPUTS, 3, HIDDEN)).transpose(1, 0, 2)
    p["u"][[1, 2, 0]] = rng.normal(0, 0.5 / np.sqrt(HIDDEN), (HIDDEN, 3, HIDDEN)).transpose(1, 0, 2)
    p["wc"][:] = rng.normal(0, 0.02, p["wc"].shape)
    p["ww"][:] = rng.normal(0, 0.02, (HIDDEN, WORDS // CLASS_WORDS, CLASS_WORDS)).transpose(1, 0, 2)
    p["bc"][:] = np.where(vocab.class_mass > 0, np.log(np.maximum(vocab.class_mass, 1e-9) / max(1.0, vocab.class_mass.sum())), NEVER)
    cut = min(WORDS, len(vocab.counts))
    p["bw"][:] = NEVER
    p["bw"].reshape(-1)[:cut] = np.log(vocab.counts[:cut] / np.maximum(vocab.class_mass[vocab.classes[:cut]], 1))
    return flat


def _log_total(x: np.ndarray) -> np.ndarray:
    """log of the sum of exponentials of each row."""
    top = max(0.0, float(x.max()) - 60.0) if x.size else 0.0  # of use only for weights that have run away
    return np.log(np.exp(x - top if top else x) @ np.ones(x.shape[1], x.dtype)) + top


def _softmax(x: np.ndarray, of: int) -> np.ndarray:
    """Softmax of each row in place, divided by ``of``."""
    top = max(0.0, float(x.max()) - 60.0) if x.size else 0.0
    if top:
        x -= top
    np.exp(x, out=x)
    x *= (1 / (x @ np.full(x.shape[1], of, x.dtype)))[:, None]
    return x


class Texts:
    """Texts of a group in step order: longest first, so those that run at a step are the first rows."""

    def __init__(self, ranks: np.ndarray, sizes: np.ndarray, vocab: Vocabulary):
        self.order = np.argsort(-sizes, kind="stable")
        self.size = sizes[self.order]
        self.falling = -self.size
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.begin = begin[self.order]
        known = ranks >= 0
        at = np.where(known, ranks, np.int32(0))
        empty = not len(vocab.classes)
        # Narrow types: a group holds up to GROUP_TOKENS tokens.
        self.cls = np.full(len(ranks), RARE, np.uint8) if empty else np.where(known, vocab.classes[at], np.uint8(RARE))
        ids = np.full(len(ranks), WORDS + BINS, np.int16) if empty else np.where(known, vocab.inputs[at], np.int16(WORDS + BINS))
        self.word = np.where(self.cls < WORDS // CLASS_WORDS, ids, np.int16(-1))
        self.fixed = np.zeros(len(ranks), np.float32) if empty else np.where(known, vocab.fixed[at], np.float32(0))
        self.inp = np.empty(len(ranks), np.int16)
        self.inp[1:] = ids[:-1]
        self.inp[begin] = START

    def running(self, t: int) -> int:
        return int(np.searchsorted(self.falling, -t, side="left"))

    def steps(self, start: int, stop: int, first: int = 0, most: int | None = None) -> tuple[np.ndarray, list[int]]:
        """Tokens of the steps from ``start`` to ``stop``, one step after the other, of at most ``most`` texts from ``first``; and where each step begins."""
        runs = np.searchsorted(self.falling, -np.arange(start, stop), side="left") - first
        runs = np.minimum(runs[runs > 0], len(self.falling) if most is None else most)
        ends = np.cumsum(runs)
        row = np.arange(ends[-1]) - np.repeat(ends - runs, runs)
        return self.begin[first:].take(row) + np.repeat(np.arange(start, start + len(runs)), runs), [0, *ends.tolist()]


def _step(h: np.ndarray, u: np.ndarray, x: np.ndarray, g: np.ndarray, new: np.ndarray, fall: np.ndarray, out: np.ndarray) -> None:
    """One step of the cell for all rows, from state ``h`` to ``out``; ``u`` and ``x`` have the signs above. ``g`` keeps the candidate's share of ``h`` and both gates."""
    np.matmul(h, u, out=g)
    gates = g[1:]
    gates += x[:2]
    np.exp(gates, out=gates)
    gates += ONE
    np.reciprocal(gates, out=gates)
    np.multiply(g[2], g[0], out=new)
    new += x[2]
    np.tanh(new, out=new)
    np.subtract(h, new, out=fall)
    np.multiply(fall, g[1], out=out)
    out += new


def _own_words(p: dict[str, np.ndarray], h: np.ndarray, cls: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]], np.ndarray]:
    """Of the words with a softmax of their own, by class: token numbers, states, (class, begin, end) of each class that occurs, and logits."""
    own = np.flatnonzero(word >= 0)
    c = cls[own]
    order = np.argsort(c, kind="stable")
    own, c = own[order], c[order]
    sizes = np.bincount(c, minlength=WORDS // CLASS_WORDS)
    ends = np.cumsum(sizes)
    parts = [(k, int(ends[k] - sizes[k]), int(ends[k])) for k in np.flatnonzero(sizes).tolist()]
    hw, x = h.take(own, axis=0), np.empty((len(own), CLASS_WORDS), np.float32)
    for k, a, b in parts:
        np.matmul(hw[a:b], p["ww"][k], out=x[a:b])
    x += p["bw"].take(c, axis=0)
    return own, hw, parts, x


def token_log_probs(p: dict[str, np.ndarray], h: np.ndarray, cls: np.ndarray, word: np.ndarray) -> np.ndarray:
    """log p(class | state), plus log p(word | class, state) for words with a softmax of their own."""
    out = np.empty(len(cls))
    for a in range(0, len(cls), ROWS):
        x, c = h[a : a + ROWS] @ p["wc"], cls[a : a + ROWS]
        x += p["bc"]
        out[a : a + ROWS] = x[np.arange(len(c)), c] - _log_total(x)
    own, _, _, x = _own_words(p, h, cls, word)
    out[own] += x[np.arange(len(own)), word[own] % CLASS_WORDS] - _log_total(x)
    return out


@np.errstate(over="ignore")  # exp(-v) may be infinite: its gate is 0
def log_likelihoods(flat: np.ndarray, texts: Texts) -> np.ndarray:
    """Natural log probability of every token of the group (rare words: of their class only)."""
    p = unpacked(flat)
    xs, u = p["x"] * X_SIGNS, p["u"] * U_SIGNS
    out = texts.fixed.astype(np.float64)
    h = np.zeros((len(texts.size), HIDDEN), np.float32)
    # What a step needs of ROWS texts stays in the processor's cache; the states of a window follow one another in ``hs``.
    x_, g_, new_ = (np.empty(w * ROWS * HIDDEN, np.float32) for w in (3, 3, 1))
    longest = int(texts.size[0]) if len(texts.size) else 0
    start = 0
    while start < longest:
        running = texts.running(start)
        stop = min(longest, start + max(WINDOW, STATES // min(ROWS, running)))
        for first in range(0, running, ROWS):
            at, cuts = texts.steps(start, stop, first, ROWS)
            hs, ids = np.empty((len(at), HIDDEN), np.float32), texts.inp.take(at).astype(np.intp)
            last = h[first : first + ROWS]
            for a, b in zip(cuts, cuts[1:]):
                k = b - a
                x, g, new = (v[: w * k * HIDDEN].reshape(w, k, HIDDEN) for v, w in ((x_, 3), (g_, 3), (new_, 1)))
                xs.take(ids[a:b], axis=1, out=x, mode="clip")
                s = hs[a:b]
                _step(last[:k], u, x, g, new[0], s, s)
                last = s
            h[first : first + len(last)] = last
            out[at] += token_log_probs(p, hs, texts.cls[at], texts.word[at])
        start = stop
    return out


class Trainer:
    """Truncated back-propagation with Adam over batches of texts in step."""

    def __init__(self, flat: np.ndarray, rate: float):
        self.flat, self.rate = flat.astype(np.float32).copy(), rate
        self.m, self.v, self.steps, self.seen = np.zeros_like(self.flat), np.zeros_like(self.flat), 0, 0

    @np.errstate(over="ignore")
    def train(self, texts: Texts) -> None:
        h = np.zeros((len(texts.size), HIDDEN), np.float32)
        longest = int(texts.size[0]) if len(texts.size) else 0
        for start in range(0, longest, WINDOW):
            h = self._window(texts, h, start, min(longest, start + WINDOW))

    def _window(self, texts: Texts, h: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Trains on the steps of a window; returns the states of the texts that run at its last step."""
        p = unpacked(self.flat)
        grad = np.zeros_like(self.flat)
        g_ = unpacked(grad)
        at, cuts = texts.steps(start, stop)
        n, spans = cuts[-1], list(zip(cuts, cuts[1:]))
        # Rows of all steps of the window one after the other, so what does not depend on the step before is computed once for all.
        ids = texts.inp[at]
        xs, u = (p["x"] * X_SIGNS).take(ids, axis=1), p["u"] * U_SIGNS
        g = np.empty((3, n, HIDDEN), np.float32)
        before, new, fall, hs = (np.empty((n, HIDDEN), np.float32) for _ in range(4))
        for a, b in spans:
            before[a:b] = h[: b - a]
            h = hs[a:b]
            _step(before[a:b], u, xs[:, a:b], g[:, a:b], new[a:b], fall[a:b], h)
        cls, word = texts.cls[at], texts.word[at]
        # Output factors: gradient of the mean log loss.
        dc = hs @ p["wc"]
        dc += p["bc"]
        _softmax(dc, n)[np.arange(n), cls] -= np.float32(1 / n)
        np.matmul(hs.T, dc, out=g_["wc"])
        np.matmul(np.ones(n, np.float32), dc, out=g_["bc"])
        dh_all = dc @ p["wc"].T
        # The words' softmaxes: rows sorted by class, so each class is one slice and the rest is done for all rows at once.
        own, hw, parts, dw = _own_words(p, hs, cls, word)
        _softmax(dw, n)[np.arange(len(own)), word[own] % CLASS_WORDS] -= np.float32(1 / n)
        dh_own = np.empty((len(own), HIDDEN), np.float32)
        for k, a, b in parts:
            d = dw[a:b]
            np.matmul(hw[a:b].T, d, out=g_["ww"][k])
            np.matmul(d, p["ww"][k].T, out=dh_own[a:b])
        if parts:
            g_["bw"][[k for k, _, _ in parts]] = np.add.reduceat(dw, [a for _, a, _ in parts], axis=0)
        dh_all[own] += dh_own
        # What a state's gradient is multiplied with: candidate's share of the state before, update, reset; and the candidate.
        z, r = g[1], g[2]
        by = np.empty((4, n, HIDDEN), np.float32)
        np.multiply(1 - z, 1 - new * new, out=by[3])
        np.multiply(by[3], r, out=by[0])
        np.multiply(fall, z * (1 - z), out=by[1])
        np.multiply(by[0], g[0] * (1 - r), out=by[2])
        back, carry = np.ascontiguousarray(p["u"].transpose(0, 2, 1)), None
        for a, b in spans[::-1]:
            dh, d = dh_all[a:b], by[:3, a:b]
            if carry is not None:
                dh[: len(carry)] += carry
            d *= dh
            carry = (d @ back).sum(0)
            carry += dh * z[a:b]
        by[3] *= dh_all
        np.matmul(before.T, by[:3], out=g_["u"])
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.diff(ids, prepend=np.int16(-1)))
        g_["x"][:, ids[first]] = np.add.reduceat(by[1:].take(order, axis=1), first, axis=1)
        norm = float(np.sqrt(grad @ grad))
        if norm > 1:
            grad /= norm
        self.steps += 1
        self.seen += n
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        by_root = np.sqrt(self.v / (1 - 0.99**self.steps))
        by_root += 1e-6
        # A window in which few texts still run moves the weights less.
        self.flat -= self.rate * min(1.0, n / (WINDOW * BATCH)) / (1 - 0.9**self.steps) * self.m / by_root
        return h


def _groups(col: pa.Array, vocab: Vocabulary, most_tokens: int, most_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, ranks, tokens per text) of consecutive texts, up to the limits but at least one text."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = rows = 0
    for buf, offs in text_slices(col):
        h, row = tokens(buf, offs)
        part = (h, vocab.ranks(h), np.bincount(row, minlength=len(offs) - 1))
        if held and (size + len(h) > most_tokens or rows + len(part[2]) > most_rows):
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, size, rows = [], 0, 0
        held.append(part)
        size, rows = size + len(h), rows + len(part[2])
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def train_round(docs: DataFrame, vocab: Vocabulary, flat: np.ndarray, rate: float, text_col: str = "text") -> np.ndarray:
    """Parameters after every partition trained on its texts, averaged over partitions by tokens; unchanged without texts.

    The averages are Spark aggregates over (place, value) rows with partial sums, so the driver receives one parameter
    vector however many partitions train.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(flat, rate)
        for batch in batches:
            for _, ranks, sizes in _groups(batch.column(0), vocab, GROUP_TOKENS, 1 << 30):
                # Batches of texts of like length; their order is mixed, so short and long ones alternate.
                order = np.argsort(sizes, kind="stable")
                begin = np.concatenate([[0], np.cumsum(sizes)])
                parts = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
                for j in np.random.default_rng(len(order)).permutation(len(parts)):
                    own = parts[j]
                    trainer.train(Texts(np.concatenate([ranks[begin[i] : begin[i + 1]] for i in own]), sizes[own], vocab))
        if trainer.seen:
            value = trainer.flat.astype(np.float64) * trainer.seen
            place = np.arange(PARAMETERS, dtype=np.int32)
            yield pa.record_batch([pa.array(place), pa.array(value), pa.array(np.full(PARAMETERS, trainer.seen, np.int64))], names=["i", "v", "n"])

    sums = docs.select(quoted(text_col).cast("string").alias("t")).mapInArrow(run, "i int, v double, n bigint").groupBy("i").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    got = sums.toPandas()  # PARAMETERS rows
    if not len(got):
        return flat
    out = flat.copy()
    out[got["i"].to_numpy()] = (got["v"] / got["n"]).to_numpy(np.float32)
    return out


_STATS = "n_tokens bigint, head_known bigint, head_base double, head_score double, tail array<bigint>, tail_n array<int>"


def _scored(vocab: Vocabulary, flat: np.ndarray, text: Column) -> Column:
    """Per text: tokens, sums over its head words, the network's score, and its distinct other words with counts."""

    @F.arrow_udf(_STATS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        base = np.log10((vocab.counts + 0.5) / (vocab.total + 0.5 * (vocab.distinct + 1)))
        names = [f.split()[0] for f in _STATS.split(", ")]
        for col in batches:
            parts = []
            for h, ranks, sizes in _groups(col, vocab, GROUP_TOKENS, 1 << 30):
                n = len(sizes)
                row = np.repeat(np.arange(n), sizes)
                texts = Texts(ranks, sizes, vocab)
                score = np.bincount(row, weights=log_likelihoods(flat, texts), minlength=n) / np.log(10.0)
                own = ranks >= 0
                known = np.bincount(row[own], minlength=n)
                sums = np.bincount(row[own], weights=base[ranks[own]], minlength=n) if own.any() else np.zeros(n)
                # Distinct (text, word) pairs beyond the head, by text.
                th, tr = h[~own], row[~own]
                order = np.lexsort((th, tr))
                th, tr = th[order], tr[order]
                first = np.flatnonzero(np.concatenate([[True], (th[1:] != th[:-1]) | (tr[1:] != tr[:-1])])) if len(th) else np.zeros(0, np.int64)
                times = np.diff(np.concatenate([first, [len(th)]])).astype(np.int32)
                ends = np.concatenate([[0], np.cumsum(np.bincount(tr[first], minlength=n))]).astype(np.int32)
                parts.append(pa.StructArray.from_arrays([
                    pa.array(sizes.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(sums), pa.array(score),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(th[first].view(np.int64))), pa.ListArray.from_arrays(pa.array(ends), pa.array(times)),
                ], names=names))
            if parts:
                yield pa.concat_arrays(parts)
            else:
                yield pa.array([], pa.struct(list(zip(names, [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int32())]))))

    return run(text.cast("string"))


def fit(docs: DataFrame, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text", head_words: int = HEAD_WORDS) -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary from the counts (h, n) and parameters trained on all rows of ``docs``, each in one round."""
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    # The head ends at the step of a sixteenth of a doubling where it still has at most head_words words, so no task sorts
    # or sends more than its share of them.
    step = F.floor(F.log2("n") * 16).cast("int")
    room, least = head_words, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r["step"]):
        room -= r["words"]
        if room < 0:
            break
        least = r["step"]
    head = counts.where(F.lit(False) if least is None else step >= least).toPandas().sort_values(["n", "h"], ascending=[False, True])
    vocab = Vocabulary(head["h"].to_numpy(np.int64).view(np.uint64), head["n"].to_numpy(np.int64), int(whole["n"] or 0), int(whole["v"]))
    flat = initial(vocab)
    turn = F.pmod(F.xxhash64(quoted(id_col), quoted(text_col), F.lit("share")), F.lit(ROUNDS))
    place = F.xxhash64(quoted(id_col), quoted(text_col), F.lit("place"))
    shards = max(1, -(-vocab.total // (ROUNDS * SHARD_TOKENS)))
    for r in range(ROUNDS):
        part = docs.where(turn == r).select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), place.alias("place"))
        flat = train_round(part.repartition(shards, "place").sortWithinPartitions("place"), vocab, flat, RATE / (r + 1))
    return vocab, flat


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head_words: int = HEAD_WORDS) -> DataFrame:
    """Per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the whole text).

    Trained on the rows whose fold is not held out (a null id is never held out). A null or empty text is its end alone; repeated
    rows get equal scores; an empty table returns no rows; without training rows every word is unseen.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    seen = rows.where(fold(F.col("id"), FOLDS) != HELD_OUT_FOLD)
    counts = materialize(count_tokens(seen), "gru-counts")
    vocab, flat = fit(seen, counts, "id", head_words=head_words)
    scored = rows.select("id", _scored(vocab, flat, F.col("text")).alias("s")).select("id", "s.*")
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "gru-scored")
    pairs = scored.select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("p")).select("row", F.col("p.tail").alias("h"), F.col("p.tail_n").alias("k"))
    c = F.coalesce("n", F.lit(0))
    total, distinct = float(vocab.total), float(vocab.distinct)
    sums = pairs.join(counts, "h", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("known"),
        F.sum(F.col("k") * F.log10((c + 0.5) / F.lit(total + 0.5 * (distinct + 1)))).alias("base"),
        F.sum(F.col("k") * F.log10((c + 0.5) / F.lit(float(vocab.rare_total) + 0.5 * (vocab.rare_distinct + 1)))).alias("rare"),
    )
    none = F.lit(0.0)
    return scored.join(sums, "row", "left").select(
        F.col("id").alias(id_col), (fold(F.col("id"), FOLDS) == HELD_OUT_FOLD).alias("held_out"), "n_tokens",
        (F.col("head_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"), F.lit(int(vocab.total)).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("base", none)).alias("base_score"), (F.col("head_score") + F.coalesce("rare", none)).alias("score"),
    )
