"""Small documents with awkward rows, and plain-Python versions of the definitions."""

import random
import re

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and river stone bright walks under morning cloud señor größe été naïve paper lamp green quiet seven house".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, copies, near copies, repeated rows and ids."""
    rng = random.Random(5)
    base = prose(rng, 120)
    rows = [(i, prose(rng, rng.randint(1, 90)), rng.choice(["en", "de"]), f"src{i % 3}", 1) for i in range(40)]
    rows += [
        (100, None, "en", "src0", None), (101, "", "en", "src0", 0), (102, " \t\n\r\x0b\x0c ", None, None, 3),
        (103, base, "en", "src0", 1), (104, base, "en", "src1", 1), (105, base.replace("river", "brook", 1), "en", "src0", 1),
        (106, prose(rng, 20_000), "de", "src1", 1), (107, "word", "en", "src2", 4), (108, "ein ein ein ein ein ein ein ein ein ein ein ein", "de", "src2", 4),
        (109, "a\x00b   \U0001f600 ünï", "fr", "src2", 9), (None, "no id at all", "en", "src0", 2), (None, None, None, None, None),
        (110, base, "en", "src0", 1), (110, base, "en", "src0", 1), (110, "another text of the same id", "en", "src0", 1), (-3, "negative id text", "en", "src0", 1),
    ]
    return rows


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


def words_ascii(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
