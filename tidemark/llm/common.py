"""Helpers shared by the operators: table reads, row keys, vectorised text work.

The numpy helpers run inside Arrow UDF batches. They work on slices of a batch
of at most ``SLICE_BYTES`` of text (one longer text is a slice of its own), so
their memory follows the slice, not the Arrow batch.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 18


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers that see this checkout may import from it wherever the driver was started;
    elsewhere the package is shipped with ``--py-files``."""
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(col: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; a null id has fold -1."""
    return F.coalesce(F.crc32(col.cast("string")) % parts, F.lit(-1))


def spare_name(df: DataFrame, stem: str) -> str:
    """A column name starting with ``stem`` that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(name: str) -> Column:
    """A top-level column whose name may hold dots or backquotes."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_slices(col: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of consecutive rows of a string array; a null row is empty.

    ``offsets`` has one entry more than the slice has rows. Slices hold at
    least one row and otherwise at most ``max_bytes``.
    """
    if not len(col):
        return
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = int(np.searchsorted(offs, offs[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), len(col))
        yield raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def byte_table(chars: bytes) -> np.ndarray:
    """256 flags that are true for the given byte values."""
    t = np.zeros(256, bool)
    t[np.frombuffer(chars, np.uint8)] = True
    return t


ASCII_SPACE = byte_table(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(buf: np.ndarray, offs: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each maximal run of non-gap bytes; rows never share a word."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = np.zeros(n + 1, bool)
    np.logical_not(gap[buf], out=word[:n])
    start = word.copy()
    start[1:] &= ~word[:-1]
    end = ~word
    end[1:] &= word[:-1]
    end[0] = False
    cut = offs[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < n)])
    inside = cut[word[cut] & word[cut - 1]]  # a row boundary inside a run ends one word and starts another
    start[inside] = True
    s = np.flatnonzero(start[:n])
    e = np.flatnonzero(end)
    if len(inside):
        e = np.sort(np.concatenate([e, inside]))
    row = np.searchsorted(offs, s, side="right") - 1
    return s, e, row


P = np.uint64(0x9E3779B97F4A7C15 | 1)
PINV = np.uint64(pow(int(P), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i < n, kept for slices of the usual size."""
    have = _POW.get("p")
    if have is not None and len(have) >= n:
        return have[:n], _POW["q"][:n]
    p, q = _powers(P, n), _powers(PINV, n)
    if n <= 4 * SLICE_BYTES:
        _POW["p"], _POW["q"] = p, q
    return p, q


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising bit mix of 64-bit values (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def span_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes have equal hashes wherever they stand.

    A prefix sum of byte * P^i turns every span into one subtraction, so the
    cost is per byte of the slice and not per span and byte.
    """
    if not len(s):
        return np.zeros(0, np.uint64)
    p, q = powers(len(buf) + 1)
    pre = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * p[: len(buf)], out=pre[1:])
    return mix((pre[e] - pre[s]) * q[s] + (e - s).astype(np.uint64))


def hash_word(word: bytes) -> int:
    """The ``span_hashes`` value of one byte string."""
    b = np.frombuffer(word, np.uint8)
    return int(span_hashes(b, np.array([0]), np.array([len(b)]))[0])


def per_slice(fn: Callable[[np.ndarray, np.ndarray], np.ndarray], col: pa.Array, dtype=np.float64) -> np.ndarray:
    """Concatenate ``fn`` (one value per row) over the slices of a batch."""
    out = [fn(buf, offs) for buf, offs in text_slices(col)]
    return np.concatenate(out) if out else np.zeros(0, dtype)
