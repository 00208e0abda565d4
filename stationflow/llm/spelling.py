"""Spelling variants by PartEnum signatures of letter multisets.

A word's letters, each with the number of its occurrence (``l1, l2``), are a set;
two words at an edit distance of one differ in at most two such letters. So the
letters are dealt by hash into seven parts, of which at most two can differ: every
near pair agrees in the letters of some five of the seven parts. A word has one
signature for each choice of five parts (21); words are joined on equal signatures
and the pairs verified by their edit distance. No near pair can be missed.

A signature that many words share is refined before the join: of two words at a
distance of one, the shorter of L letters, the first L div 2 or the last L - L div 2
letters agree, so that the key becomes the signature with such a half. Nothing is
capped.

Words are counted in each task before the shuffle. A word's form is the most
frequent word near it if that one is at least five times as frequent; its root is
found by following forms (counts grow fivefold at each step, so a handful of
doubling joins suffice).

Defined cases: a null text has no words; a null doc_id is the empty string in the
damage's key; repeated rows count each; an empty table gives no rows; other columns
are ignored."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.shared import stored
from stationflow.llm.text import mixed

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, LEAST = 6, 5
DAMAGE = 199
#: A form is at least so many times as frequent as its variant.
TIMES = 5
#: Letters of near words differ in two places, so signatures leave out two parts.
PARTS, DIFFER = 7, 2
#: Words of one signature from which on its key is refined.
CROWD = 256
#: Distinct words that a task counts before it hands them on.
HELD = 400_000


def count_words(documents: DataFrame, *, shortest: int = SHORTEST, least: int = LEAST, damage: int = DAMAGE) -> DataFrame:
    """``word, n``: damaged lower-cased runs of letters, counted over all texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[{LETTERS}]{{{shortest},}}").findall  # whole runs, since it is greedy
        held: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{doc.as_py() if doc.is_valid else ''}:".encode())
                for word, n in Counter(runs(text.as_py().encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % damage == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < shortest:
                            continue
                    held[word] += n
            if len(held) >= HELD:
                yield _counts(held)
                held.clear()
        yield _counts(held)

    ids = documents.select(F.col("doc_id").cast("string"), "text")
    words = ids.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.col("n") >= least)


def _counts(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


def signatures(words: list[str], parts: int = PARTS, differ: int = DIFFER) -> np.ndarray:
    """A row of signatures for each word: the letters of all choices of
    ``parts - differ`` parts, hashed."""
    letter = np.array([ord(c) for w in words for c in w], dtype=np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    order = np.lexsort((letter, owner))
    letter, owner = letter[order], owner[order]
    new = np.ones(len(letter), dtype=bool)
    new[1:] = (letter[1:] != letter[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    occurrence = np.arange(len(letter)) - first[np.cumsum(new) - 1] if len(letter) else owner
    with np.errstate(over="ignore"):
        h = mixed(letter * np.uint64(1 << 32) + occurrence.astype(np.uint64) + np.uint64(1))
        part = (h >> np.uint64(40)) % np.uint64(parts)
        sums = np.zeros((len(words), parts), dtype=np.uint64)
        np.add.at(sums, (owner, part.astype(np.int64)), h)
        chosen = list(combinations(range(parts), parts - differ))
        out = np.empty((len(words), len(chosen)), dtype=np.uint64)
        for k, c in enumerate(chosen):
            key = np.full(len(words), k + 1, dtype=np.uint64)
            for p in c:
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + sums[:, p])
            out[:, k] = key
    return out


def near_pairs(words: DataFrame, *, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """``a, b`` with a < b: all pairs of the column ``word``'s distinct values
    that one inserted, deleted or replaced code point tells apart."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_pylist()
            if values:
                keys = signatures(values, parts)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["word", "keys"])

    signed_words = words.select("word").mapInArrow(signed, "word string, keys array<long>")
    entries = stored(signed_words.select("word", F.char_length("word").alias("l"), F.explode("keys").alias("key")), "word-signatures")
    crowded = entries.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > crowd).select(F.col("key").alias("_key"))
    marked = entries.join(crowded, F.col("key") == F.col("_key"), "left").selectExpr("word", "l", "key", "_key is not null as crowded")
    halves = """transform(sequence(greatest(l - 1, 1), l), s -> array(
        struct(s as s, 0 as side, substring(word, 1, cast(s div 2 as int)) as half),
        struct(s as s, 1 as side, right(word, cast(s - s div 2 as int)) as half)))"""
    keyed = stored(
        marked.where("not crowded").selectExpr("word", "l", "key", "0 as s", "0 as side", "'' as half").unionByName(
            marked.where("crowded").selectExpr("word", "l", "key", f"inline(flatten({halves}))")
        ),
        "word-keys",
    )
    on = ["key", "s", "side", "half"]
    pairs = keyed.selectExpr(*on, "word as a", "l as la").join(keyed.selectExpr(*on, "word as b", "l as lb"), on)
    return pairs.where("a < b and abs(la - lb) <= 1 and levenshtein(a, b, 1) = 1").select("a", "b").distinct()


def group_variants(words: DataFrame, *, times: int = TIMES, **options) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``word, n``."""
    words = stored(words.select("word", "n"), "words")
    pairs = stored(near_pairs(words, **options), "near-words")
    both = pairs.unionByName(pairs.selectExpr("b as a", "a as b"))
    near = both.join(words.selectExpr("word as b", "n as near_n"), "b")
    best = near.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("b"))).alias("best"))
    judged = words.join(best, F.col("word") == F.col("a"), "left").selectExpr(
        "word", "n", "coalesce(n_near, 0) as n_near", f"if(-best.rank >= {times} * n, best.b, null) as form", f"if(-best.rank >= {times} * n, -best.rank, null) as form_n"
    )
    judged = stored(judged, "word-forms")
    # Words with a form, each pointing further at every round.
    now = judged.where("form is not null").selectExpr("word as w", "form as root")
    while True:
        step = now.join(now.selectExpr("w as _w", "root as _root"), F.col("root") == F.col("_w"), "left")
        now = stored(step.selectExpr("w", "coalesce(_root, root) as root", "_root is not null as moved"), "word-roots")
        moved = now.where("moved").limit(1).count()
        now = now.select("w", "root")
        if not moved:
            break
    return judged.join(now, F.col("word") == F.col("w"), "left").selectExpr("word", "form", "coalesce(root, word) as root", "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame) -> DataFrame:
    """Words of all texts with their forms and roots."""
    return group_variants(count_words(documents))
