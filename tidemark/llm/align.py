"""Alignment of two tokenizers over the same texts by pointer jumping.

Both tokenizers cut the bytes of a text (with one leading space) into tokens. Byte offsets
at which a token of either ends cut the text into groups; inside a group the tokens of the two
overlap in a chain.

Groups. Every token points to its farthest-right overlapping token of the other tokenizer, unless
it reaches as far right itself. Successor doubling (``succ = succ[succ]``) over whole Arrow slices
converges to the last token of each chain, which labels the group, in as many steps as the
logarithm of the longest chain.

Links. A link is a pair of tokens, one of each tokenizer, with overlapping bytes. Both cut the same
bytes, so every piece between two neighbouring cuts of either belongs to exactly one link. The number
of documents that hold an id pair is counted by Spark over all documents, and each document's links
are joined with these counts. Pairs of at least ``T`` documents are broadcast, where ``T`` is the
smallest power of two that leaves at most ``broadcast_rows`` of them; rarer pairs, none of which is
in many rows, are joined by a shuffle. A small table is thus broadcast whole.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, text_slices
from tidemark.session import materialize

BROADCAST_ROWS = 1 << 20
SCHEMA = "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"


def tokenizer_path(name: str) -> str:
    """Place of an installed public tokenizer file; other files are passed by their own path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_decoder() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself, the
    other bytes take the code points from 256 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Bytes of every token id as one buffer with offsets."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, end offset of each token) of a token sequence."""
        n = self.size[ids]
        end = np.cumsum(n)
        if not len(ids):
            return np.zeros(0, np.uint8), end
        at = np.arange(end[-1]) + np.repeat(self.start[ids] - (end - n), n)
        return self.data[at], end


# Fixed value: the words that a byte-level pre-tokenizer cuts a text into.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """A byte-level BPE file; special tokens are ordinary text.

    Where the file is plain (no normalizer, the usual words, ids in the order of the merges) its entries serve as
    ranks of ``tiktoken``, which returns the same ids several times faster; other files go through ``tokenizers``.
    """

    def __init__(self, path: str, plain: bool | None = None):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        decode = byte_decoder()
        vocab = spec["model"]["vocab"]
        entries = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in vocab.items():
            entries[i] = token.encode() if token in special else bytes(decode[c] for c in token)
        for token, i in special.items():
            entries[i] = token.encode()
        self.vocab = Vocabulary(entries)
        if self.is_plain(spec, vocab) if plain is None else plain:
            import tiktoken

            ranks = {entries[i]: i for token, i in vocab.items() if token not in special}
            model = tiktoken.Encoding("entries", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
            self._ids = lambda texts: [model.encode_ordinary(t) for t in texts]
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.encode_special_tokens = True
            self._ids = lambda texts: [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]

    @staticmethod
    def is_plain(spec: dict, vocab: dict[str, int]) -> bool:
        words, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if spec.get("normalizer") or words.get("type") != "ByteLevel" or words.get("add_prefix_space") or not words.get("use_regex", True):
            return False
        if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return False
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        return merged == list(range(256, 256 + len(merged)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self._ids([" " + t for t in texts]))


class Pieces:
    """A sentencepiece model with byte fallback; it adds the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            entries.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.vocab = Vocabulary(entries)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self.model.encode(texts, num_threads=1))


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, number of ids of each text)."""
    return np.concatenate([np.zeros(0, np.int64), *(np.asarray(x, np.int64) for x in lists)]), np.array([len(x) for x in lists], np.int64)


def _matching(vocab: Vocabulary, ids: np.ndarray, counts: np.ndarray, want: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each text, whether the bytes of its tokens are the wanted ones."""
    got, _ = vocab.joined(ids)
    doc = np.repeat(np.arange(len(counts)), counts)
    n = np.bincount(doc, vocab.size[ids], len(counts)).astype(np.int64)
    ok = n == size
    a, b = got[np.repeat(ok, n)], want[np.repeat(ok, size)]
    ok[np.repeat(np.flatnonzero(ok), size[ok])[a != b]] = False
    return ok


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, ascending; how often each occurs)."""
    values = np.sort(values)
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.append(first, len(values)))


def group_ends(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label of every token (of A, of B): the index of the last A token of its group.

    ``end_a`` and ``end_b`` are ascending end offsets of two cuts of the same bytes into non-empty tokens.
    """
    na = len(end_a)
    start_a, start_b = np.concatenate([[0], end_a])[:-1], np.concatenate([[0], end_b])[:-1]
    last_b = np.searchsorted(start_b, end_a, "left") - 1
    last_a = np.searchsorted(start_a, end_b, "left") - 1
    # An A token that reaches as far as its last B token ends the chain; that B token points to it.
    succ = np.concatenate([np.where(end_b[last_b] > end_a, na + last_b, np.arange(na)), last_a]) if na else np.zeros(0, np.int64)
    while True:
        far = succ[succ]
        if np.array_equal(far, succ):
            return succ[:na], succ[na:]
        succ = far


def _decimals(n: int) -> np.ndarray:
    """Decimal id with each of the four things that may follow it: nothing, comma, bar, semicolon."""
    return np.array([str(i).encode() + s for s in (b"", b",", b"|", b";") for i in range(n)], object)


class Aligner:
    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.ids = max(len(a.vocab.size), len(b.vocab.size))
        self.words = _decimals(self.ids)

    def slice(self, texts: list[str], raw: np.ndarray, offs: np.ndarray) -> list:
        """Columns of ``SCHEMA`` after the id for the texts, whose bytes are ``raw`` cut at ``offs``."""
        rows = len(texts)
        ids_a, n_a = self.a.encode(texts)
        ids_b, n_b = self.b.encode(texts)
        size = np.diff(offs) + 1
        want = np.insert(raw, offs[:-1], 32)
        ok = _matching(self.a.vocab, ids_a, n_a, want, size) & _matching(self.b.vocab, ids_b, n_b, want, size) & (size > 1)
        ids_a, ids_b = ids_a[np.repeat(ok, n_a)], ids_b[np.repeat(ok, n_b)]
        n_a, n_b = n_a * ok, n_b * ok
        end_a, end_b = np.cumsum(self.a.vocab.size[ids_a]), np.cumsum(self.b.vocab.size[ids_b])
        doc_a, doc_b = np.repeat(np.arange(rows), n_a), np.repeat(np.arange(rows), n_b)
        label_a, label_b = group_ends(end_a, end_b)
        n_groups = np.bincount(doc_a[label_a == np.arange(len(label_a))], minlength=rows)
        cuts, _ = _counted(np.concatenate([end_a, end_b]))
        link_a, link_b = np.searchsorted(end_a, cuts, "left"), np.searchsorted(end_b, cuts, "left")
        n_links = np.bincount(doc_a[link_a], minlength=rows)
        span = len(self.a.vocab.size) * len(self.b.vocab.size)
        held, times = _counted(doc_a[link_a] * span + ids_a[link_a] * len(self.b.vocab.size) + ids_b[link_b])
        cut = np.searchsorted(held // span, np.arange(rows + 1)).astype(np.int32)
        digests = self._digests(rows, ids_a, label_a, doc_a, ids_b, label_b, doc_b, n_a + n_b)
        return [
            pa.array(n_a), pa.array(n_b), pa.array(n_groups, pa.int64()), pa.array(n_links, pa.int64()), pa.array(digests, pa.string()),
            pa.ListArray.from_arrays(pa.array(cut), pa.array(held % span)), pa.ListArray.from_arrays(pa.array(cut), pa.array(times.astype(np.int32))),
        ]

    def _digests(self, rows, ids_a, label_a, doc_a, ids_b, label_b, doc_b, n) -> list[str]:
        label = np.concatenate([label_a, label_b])
        order = np.argsort(label, kind="stable")  # A before B inside a group, each in the order of the text
        label, ids = label[order], np.concatenate([ids_a, ids_b])[order]
        is_b, doc = order >= len(ids_a), np.concatenate([doc_a, doc_b])[order]
        after = np.zeros(len(ids), np.int64)
        if len(ids):
            same = label[1:] == label[:-1]
            after[:-1] = np.where(~same, np.where(doc[1:] == doc[:-1], 3, 0), np.where(is_b[1:] == is_b[:-1], 1, 2))
        words = self.words[after * self.ids + ids]
        end = np.cumsum(n)
        return [hashlib.sha256(b"".join(words[z - k : z].tolist())).hexdigest() if k else "" for z, k in zip(end.tolist(), n.tolist())]


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_level: str | None = None, pieces: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``byte_level`` and ``pieces`` are files of the two tokenizers, readable on every worker. ``n_best`` counts the
    links whose id pair is in as many documents as any pair of its A id; ``count_sum`` adds those numbers of
    documents over the links. A text that is null, empty or not reproduced by the bytes of either tokenizer's
    tokens has no tokens: zeros and an empty digest. Repeated rows count as documents of their own. A null id
    stays null; an empty table returns no rows; other columns are not read.
    """
    byte_level, pieces = byte_level or tokenizer_path("byte_bpe_50k.json"), pieces or tokenizer_path("piece_bpe_32k.model")
    rows = docs.select(quoted(id_col).cast("bigint").alias("id"), quoted(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for batch in batches:
            aligner = aligner or Aligner(ByteLevel(byte_level), Pieces(pieces))
            i = 0
            for raw, offs in text_slices(batch.column(1)):
                n = len(offs) - 1
                texts = [t or "" for t in batch.column(1).slice(i, n).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), *aligner.slice(texts, raw, offs)], names)
                i += n

    # Sorted keys are stored as packed differences, about three bytes a pair.
    found = rows.mapInArrow(run, SCHEMA).withColumn("row", F.monotonically_increasing_id())
    found = materialize(found, "align", {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false", "compression": "zstd"})
    counts, small = pair_counts(found, _piece_count(pieces), broadcast_rows)
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("key"), F.col("p.times").alias("times"))
    if small is None:
        matched = links.join(F.broadcast(counts), "key")
    else:
        often = F.broadcast(counts.where(F.col("n") >= small))
        rare = links.join(F.broadcast(counts.where(F.col("n") >= small).select("key")), "key", "left_anti")
        matched = links.join(often, "key").unionByName(rare.join(counts.where(F.col("n") < small), "key"))
    sums = matched.groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("bigint")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return found.drop("pairs", "times").join(sums, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )


def _piece_count(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


def pair_counts(found: DataFrame, pieces: int, broadcast_rows: int) -> tuple[DataFrame, int | None]:
    """((key, n, best), T): documents of each id pair, and the least count of the pairs to broadcast.

    T is None where all pairs are at most ``broadcast_rows``. The best count of an A id is one
    row of each id of the vocabulary, whatever the corpus.
    """
    counts = materialize(found.select(F.explode("pairs").alias("key")).groupBy("key").agg(F.count("*").alias("n")), "align-counts")
    first = F.expr(f"key div {pieces}")
    best = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    marked = counts.withColumn("a", first).join(F.broadcast(best), "a").select("key", "n", (F.col("n") == F.col("most")).alias("best"))
    sizes = {int(r["bits"]): r["rows"] for r in counts.groupBy(F.floor(F.log2("n")).alias("bits")).agg(F.count("*").alias("rows")).collect()}
    kept, small = 0, None
    for bits in sorted(sizes, reverse=True):
        kept += sizes[bits]
        if kept > broadcast_rows:
            small = 1 << (bits + 1)
            break
    return marked, small
