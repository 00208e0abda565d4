"""Small awkward documents, and brute-force versions of the text rules."""

from __future__ import annotations

import random
import re

import pytest
from stationflow.llm.shared import ship_package

SPACE = r"[\x20\x09-\x0D]+"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, stems=("lorem", "ipsum", "dólor", "sit", "amet", "Eà", "tempor")):
    return " ".join(rng.choice(stems) + rng.choice(stems) for _ in range(n))


def make_rows(seed=0):
    """Near and exact copies, shared passages, nulls, odd spaces, very long
    texts, repeated rows, texts shorter than any window."""
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([3, 8, 15, 60, 120, 200])) for _ in range(24)]
    passage = prose(rng, 90)
    long = prose(rng, 9_000)
    texts = [None, "", " \t\n ", "one", "two words", "A b c d", "x " * 600, "ab" * 500, long, long[200:], *base]
    for b in base:
        w = b.split(" ")
        if len(w) > 20:
            at = rng.randrange(len(w))
            texts += [b, " ".join([*w[:at], "changed", *w[at + 1 :]]), f"{prose(rng, 40)}\n{passage} {prose(rng, 7)}"]
        elif len(w) == 15:
            texts += [" ".join(w[:-1]), b.upper()]
    langs, sources = ["en", "de", None], ["s1", "s2", "s1", None]
    rows = [(i, t, rng.choice(langs), rng.choice(sources), len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def llm(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(llm, rows):
    return llm.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(docs):
    """The documents with columns named as the operators name theirs."""
    from pyspark.sql import functions as F

    names = ["block", "k", "z", "t", "g", "h", "n", "blob", "found", "cuts", "size", "taken", "kept", "_mark", "_address", "_d", "_t", "word", "c"]
    return docs.select("*", *[F.lit(i).alias(x) for i, x in enumerate(names)])


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], SCHEMA)
