"""Dedup operators against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import UPPER, clashing, docs, empty, llm, rows, words  # noqa: F401
from stationflow.llm.blocks import bucket_bits, pack, unpack
from stationflow.llm.components import connected_components
from stationflow.llm.jaccard_join import Scheme, boundary, drop_near_copies, jaccard_components, prefix, subset_keys
from stationflow.llm.substring_dedup import remove_repeated_windows
from stationflow.llm.suffix_dedup import remove_repeated_bytes
from stationflow.llm.text import sequence_hashes, word_hashes


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# --- repeated byte strings -----------------------------------------------------


def brute_bytes(rows, length=400):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    count = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for doc, b in texts:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        rest = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc, len(b), int(gone.sum()), spans, sha(rest)))
    return sorted(out, key=repr)


def test_repeated_bytes_equal_brute_force(docs, rows):
    want = brute_bytes(rows)
    assert any(r[2] for r in want) and any(not r[2] for r in want)
    assert _sorted(remove_repeated_bytes(docs)) == want
    assert _sorted(remove_repeated_bytes(docs, block_bytes=20_000)) == want  # matches across blocks


def test_repeated_bytes_odd_inputs(llm, empty, clashing, rows):
    assert remove_repeated_bytes(empty).count() == 0
    assert _sorted(remove_repeated_bytes(clashing)) == brute_bytes(rows)
    same = [(1, "q" * 399, "en", "s", 1), (1, "q" * 399, "en", "s", 1), (None, "w" * 401, "en", "s", 1), (2, "é" * 250, None, None, None)]
    got = _sorted(remove_repeated_bytes(llm.createDataFrame(same, "doc_id long, text string, lang string, source string, n_chars long")))
    assert got == brute_bytes(same)  # 399 bytes are below the length; 401 equal bytes overlap themselves
    with pytest.raises(ValueError):
        remove_repeated_bytes(empty, length=100)


def brute_both(rows, length=400, shorter=256):
    """As brute_bytes, with the bytes that the shorter strings cover."""
    most, more = brute_bytes(list(enumerate(r[1] for r in rows)), length), brute_bytes(list(enumerate(r[1] for r in rows)), shorter)
    return sorted(((rows[i][0], *rest, x[2]) for (i, *rest), x in zip(sorted(most), sorted(more), strict=True)), key=repr)


@pytest.mark.parametrize("buckets", [None, 5])
def test_two_lengths_in_one_run(docs, rows, monkeypatch, buckets):
    from stationflow.llm import suffix_dedup

    if buckets:
        monkeypatch.setattr(suffix_dedup, "bucket_bits", lambda entries, *_: buckets)
    want = brute_both(rows)
    assert any(r[5] > r[2] for r in want)
    assert _sorted(remove_repeated_bytes(docs, block_bytes=20_000, shorter=256)) == want
    assert [r[:5] for r in want] == brute_bytes(rows)  # what is removed does not depend on the other length


def test_passages_of_51_words_are_seen(llm, empty, tmp_path):
    """Passages of over 50 words in two documents each, most of them below 400
    bytes; the query counts their bytes and removes only what the 400 bytes do."""
    import random

    from stationflow.llm.queries import QUERIES

    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdeilmnorstu", k=rng.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (51, 52, 53, 55, 58, 60, 63, 90)]
    assert sum(len(p) < 400 for p in passages) > 5 and min(map(len, passages)) > 260
    rows = [(10 * i + j, f"{text(40)}. {p} {text(30 + j)}", "en", "s", 0) for i, p in enumerate(passages) for j in range(2)]
    rows += [(1000 + i, text(120), "en", "s", 0) for i in range(20)] + [(None, None, None, None, None), (2000, passages[0][:255], "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    llm.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op2_suffix_dedup"](llm, str(tmp_path))
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated"]
    got = {r["doc_id"]: r for r in out.collect()}
    for i, p in enumerate(passages):
        for j in range(2):
            assert got[10 * i + j]["n_repeated"] >= len(p) and (got[10 * i + j]["n_removed"] > 0) == (got[10 * i + j]["n_removed"] >= 400)
    assert all(r["n_repeated"] == 0 for d, r in got.items() if d is None or d >= 1000)
    assert _sorted(out) == brute_both(rows)
    assert remove_repeated_bytes(empty, shorter=256).count() == 0
    with pytest.raises(ValueError):
        remove_repeated_bytes(empty, shorter=255)


# --- repeated windows of words ---------------------------------------------------


def brute_windows(rows, n=13):
    texts = [(r[0], (r[1] or "").encode().split()) for r in rows]
    rank = lambda d: -1 if d is None else d
    first: dict = {}
    for doc, w in texts:
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            first[key] = min(first.get(key, rank(doc)), rank(doc))
    out = []
    for doc, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < rank(doc):
                gone[i : i + n] = [True] * n
        out.append((doc, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return sorted(out, key=repr)


def test_windows_equal_brute_force(docs, rows):
    want = brute_windows(rows)
    assert any(r[2] for r in want)
    assert _sorted(remove_repeated_windows(docs)) == want
    assert _sorted(remove_repeated_windows(docs, block_bytes=20_000)) == want


def test_full_sketch_loses_nothing(docs, rows, monkeypatch):
    """A sketch so small that every window counts as repeated."""
    from stationflow.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "SLICE", 64)
    assert _sorted(remove_repeated_windows(docs, most_cells=64, rows=1)) == brute_windows(rows)


def test_sketches_merge_in_a_tree(docs, rows, monkeypatch):
    from stationflow.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "FAN_IN", 2)
    monkeypatch.setattr(substring_dedup, "SLICE", 4096)
    assert _sorted(remove_repeated_windows(docs, block_bytes=20_000)) == brute_windows(rows)


def test_windows_odd_inputs(llm, empty, clashing, rows):
    assert remove_repeated_windows(empty).count() == 0
    assert _sorted(remove_repeated_windows(clashing)) == brute_windows(rows)
    w = " ".join(f"w{i}" for i in range(13))
    same = [(3, w, None, None, 0), (3, w, None, None, 0), (None, w, None, None, 0), (5, w.replace("w12", "W12"), None, None, 0)]
    got = _sorted(remove_repeated_windows(llm.createDataFrame(same, "doc_id long, text string, lang string, source string, n_chars long")))
    assert got == brute_windows(same)  # a null id is the smallest; rows of one id are one document


# --- near copies by shingles -----------------------------------------------------


def brute_sets(rows, n=3):
    out = []
    for r in rows:
        w = words((r[1] or "").translate(UPPER))
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    return out


def brute_components(rows, n=3, percent=90):
    sets = brute_sets(rows, n)
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return sorted(((rows[i][0], len(sets[i]), min(groups[find(i)])) for i in range(len(rows))), key=repr)


def test_components_equal_brute_force(docs, rows):
    want = brute_components(rows)
    assert any(d != c for d, _, c in want)
    assert _sorted(jaccard_components(docs)) == want
    assert _sorted(jaccard_components(docs, words=5, percent=80)) == brute_components(rows, 5, 80)
    # many blocks, and lists dealt out in tiles of a few sets
    assert _sorted(jaccard_components(docs, block_bytes=20_000, tile_bytes=2_000)) == want


def test_keys_exchanged_in_many_buckets(docs, rows, monkeypatch):
    """The block operators with 32 buckets and several blocks: every key meets its
    like in its own range."""
    from stationflow.llm import jaccard_join, substring_dedup, suffix_dedup

    for module in (jaccard_join, substring_dedup, suffix_dedup):
        monkeypatch.setattr(module, "bucket_bits", lambda entries, *_: 5)
    assert _sorted(remove_repeated_bytes(docs, block_bytes=20_000)) == brute_bytes(rows)
    assert _sorted(remove_repeated_windows(docs, block_bytes=20_000)) == brute_windows(rows)
    assert _sorted(jaccard_components(docs, block_bytes=20_000)) == brute_components(rows)


@pytest.mark.parametrize("one_id", [None, 10**6])
def test_a_third_of_rows_under_one_id(llm, rows, one_id):
    """Rows of one id (or of none) are documents of their own to op2, and no
    copies of each other to op5."""
    own = [(one_id if i % 3 == 0 else r[0], *r[1:]) for i, r in enumerate(rows)]
    docs = llm.createDataFrame(own, "doc_id long, text string, lang string, source string, n_chars long")
    assert _sorted(remove_repeated_bytes(docs, block_bytes=20_000)) == brute_bytes(own)
    assert _sorted(remove_repeated_windows(docs, block_bytes=20_000)) == brute_windows(own)


def test_small_sets_at_the_boundary(llm):
    """Sets of 7 to 26 shingles that differ in one or two: pairs on both sides
    of the boundary and of the threshold."""
    rows = []
    for n in range(7, 27):
        w = [f"a{n}_{i}" for i in range(n + 2)]
        for text in (w, w[:-1], w[:-2], [*w[:-1], "other"], ["other", *w[1:]]):
            rows.append((len(rows), " ".join(text), "en", "s", 0))
    df = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert _sorted(jaccard_components(df)) == brute_components(rows)


def test_linked_sets_always_meet():
    rng = np.random.default_rng(3)
    for percent in (80, 90):
        scheme = Scheme(percent, 12)
        for n in [4, 5, 9, 10, 11, 12, 13, 14, 15, 18, 19, 20, 21, 30, 47, 80, 200, 540]:
            for _ in range(30):
                a = np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))
                lost = int(rng.integers(0, scheme.spare(n) + 1))
                b = np.unique(np.concatenate([a[lost:], rng.integers(1, 2**63, int(rng.integers(0, max(1, scheme.spare(n)) + 1)), dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both < percent * (len(a) + len(b) - both):
                    continue
                sets_with = {int(x): int(rng.integers(1, 300)) for x in np.union1d(a, b)}
                ends = [x[prefix(x, np.array([min(255, sets_with[int(y)]) for y in x], dtype=np.uint8), scheme)] for x in (a, b)]
                lists = scheme.enters_lists(len(a)) and scheme.enters_lists(len(b))
                subsets = scheme.lists_subsets(len(a)) and scheme.lists_subsets(len(b))
                assert lists or subsets
                assert not lists or np.intersect1d(*ends).size, (n, lost)
                assert not subsets or np.intersect1d(subset_keys(a, scheme), subset_keys(b, scheme)).size, (n, lost)


def test_boundary_follows_the_lists():
    short, long = {n: (10, 10) for n in range(1, 25)}, {n: (10, 10**9) for n in range(1, 25)}
    assert boundary(short, 90) == 1  # nothing is gained by subsets
    assert boundary(long, 90) == 24 and 10 < boundary(long, 80) < 20  # 80: subsets become too many
    assert boundary({}, 80) == 1


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_similar_but_unlinked_texts(llm, words, percent):
    """Texts over one template, each a quarter its own: all of one list, no link
    but a few; sent bytes stay in proportion to the texts."""
    import random

    rng = random.Random(5)
    template = [f"t{i}" for i in range(80)]

    def text(i):
        w = list(template)
        for at in rng.sample(range(16), 2):
            w[at * 5] = f"own{i}x{at}"
        return " ".join(w)

    rows = [(i, text(i), "en", "s", 0) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + f" tail{i}", "en", "s", 0) for i in range(0, 300, 10)]
    df = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = brute_components(rows, words, percent)
    assert any(c != d for d, _, c in want) and len({c for *_, c in want}) > 250
    assert _sorted(jaccard_components(df, words=words, percent=percent)) == want
    assert _sorted(jaccard_components(df, words=words, percent=percent, block_bytes=20_000, tile_bytes=30_000)) == want


def test_near_copies_odd_inputs(llm, empty, clashing, rows):
    assert jaccard_components(empty).count() == 0
    kept = drop_near_copies(clashing)
    assert kept.columns == clashing.columns
    firsts = {c for _, n, c in brute_components(rows)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(firsts)
    same = [(1, "a b c d", None, None, 0)] * 3 + [(None, "A B c d", None, None, 0), (2, "", None, None, 0), (2, None, None, None, 0)]
    df = llm.createDataFrame(same, "doc_id long, text string, lang string, source string, n_chars long")
    assert _sorted(jaccard_components(df)) == sorted([(1, 2, None)] * 3 + [(None, 2, None), (2, 0, 2), (2, 0, 2)], key=repr)
    assert _sorted(drop_near_copies(df).select("doc_id", "text")) == sorted([(None, "A B c d"), (2, ""), (2, None)], key=repr)


# --- helpers ------------------------------------------------------------------


def test_components_of_chains_and_stars(llm):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200), (200, 300)]
    got = dict(tuple(r) for r in connected_components(llm.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 300: 200}
    assert connected_components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_packed_arrays_round_trip():
    arrays = [np.sort(np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64)), np.arange(7, dtype=np.uint32), np.zeros(0, dtype=np.uint8)]
    for got, want in zip(unpack(pack(*arrays)), arrays, strict=True):
        assert got.dtype == want.dtype and (got == want).all()
    assert bucket_bits(1) == 0 and bucket_bits(4 << 20) == 2


def test_word_hashes_follow_words():
    texts = ["A b\tc", "", " b  A ", "long" * 400_000 + " b"]
    h, owner = word_hashes([t.encode() for t in texts])
    split = [(i, w) for i, t in enumerate(texts) for w in t.split()]
    assert owner.tolist() == [i for i, _ in split]
    assert len(set(h.tolist())) == len({w for _, w in split}) and h[0] == h[4] and h[1] == h[3]
    low, _ = word_hashes([b"ABC d"], lower=True)
    assert (low == word_hashes([b"abc d"])[0]).all()
    assert len(sequence_hashes(h, 3)) == len(h) - 2
