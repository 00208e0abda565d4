"""Conversation repair, spelling variants and packing against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import SCHEMA, clashing, docs, empty, llm, prose, rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from stationflow.llm.conversations import Row, Search, repair_conversations
from stationflow.llm.packing import Encoder, fill_one, longest_run, pack_documents, pieces_of, plan_sequences
from stationflow.llm.spelling import count_words, group_variants, near_pairs, signatures, spelling_variants

BPE = public_tokenizers.path("byte_bpe_50k.json")

# --- conversation repair -------------------------------------------------------


def brute_edits(rows):
    """Least cost and least audit over all edits, by a table from the end.
    rows: (initial, must go, truncated)."""
    accepting, turn = {"", "a"}, {"": "u", "s": "u", "u": "a", "a": "u"}
    table = {q: {"": (0, ""), "a": (0, ""), "u": (2, "I"), "s": (4, "II")}[q] for q in ("", "s", "u", "a")}
    assert accepting <= set(table)
    for initial, gone, cut in reversed(rows):
        new = {}
        after = {}
        for q in table:
            ways = [(3 + table[q][0], "D" + table[q][1])]
            if not gone:
                if initial == turn[q]:
                    ways.append((cut + table[turn[q]][0], "K" + table[turn[q]][1]))
                if initial == "s" and q == "":
                    ways.append((cut + table["s"][0], "K" + table["s"][1]))
                ways.append((2 + cut + table[turn[q]][0], "R" + table[turn[q]][1]))
            after[q] = min(ways)
        for q in table:  # inserts before the row: at most three can help
            ways, now, pre = [], q, ""
            for k in range(4):
                ways.append((2 * k + after[now][0], pre + after[now][1]))
                now, pre = turn[now], pre + "I"
            new[q] = min(ways)
        table = new
    return table[""]


def brute_damage(rows):
    out = []
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        out += [(c, t, role, text)] * (2 if h == 3 else 1)
    return out


def brute_repair(rows):
    out = {}
    after = brute_damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in after if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, turns = set(), [], [t for t, *_ in mine if t is not None]
        for _, role, text in mine:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[:1] or " " for _, r, _ in mine]
        cost, audit = brute_edits([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults, strict=True)])
        lines, state, at = [], "", 0
        for e in audit:
            turn = "a" if state == "u" else "u"
            name = {"u": "user", "a": "assistant"}[turn]
            if e == "I":
                lines.append(f"{name}:")
                state = turn
                continue
            _, role, text = mine[at]
            at += 1
            if e == "K":
                lines.append(f"{role}:{text}")
                state = role[:1]
            elif e == "R":
                lines.append(f"{name}:{text}")
                state = turn
        count = Counter(faults)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def _repaired(df):
    got = [tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]
    out = {r[0]: r[1:] for r in got}
    assert len(out) == len(got)
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(["", "a.", "b.", "c", "d", "e."]), st.booleans()), max_size=9))
def test_search_finds_the_least_of_the_cheapest(spec):
    rows = [Row(role, text, again) for role, text, again in spec]
    assert Search(rows).best() == brute_edits([(r.initial, r.gone, r.truncated) for r in rows])


def conversations(seed=0, many=60):
    import random

    rng = random.Random(seed)
    rows = []
    for c in range(many):
        role = ["system"] * rng.randrange(2) + ["user", "assistant"] * rng.randrange(1, 6)
        for t, r in enumerate(role):
            rows.append((c, t, r if rng.random() < 0.9 else rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(["Yes.", "no", "Why?", f"text {t}.", f"more {c} {t}!", " \t", "", None])))
    rows += [(500, t, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice([f"long {t}.", f"cut {t}", "same."])) for t in range(300)]  # several chunks
    rows += [(None, t, "user", "null id.") for t in (None, None, 3, 9)] + [(501, None, "user", "no turn."), (501, None, "assistant", "no turn")]
    rows += [(502, 5, "user", "same turn."), (502, 5, "assistant", "same turn."), (502, 5, "assistant", "same turn."), (503, 1, "user", "x" * 200_000), (503, 2, "assistant", "y" * 100_000 + ".")]
    dropped = next(t for t in range(100) if zlib.crc32(f"504:{t}".encode()) % 20 == 0)
    rows += [(504, dropped, "user", "gone.")]
    rows += [(505, 7, "user", "again and again.")] * 200  # equal rows
    rng.shuffle(rows)
    return rows


CONV = "conv_id long, turn long, role string, text string"


def test_repair_rows(llm):
    rows = conversations()
    want = brute_repair(rows)
    df = llm.createDataFrame(rows, CONV).repartition(5)
    assert _repaired(repair_conversations(df)) == want
    assert _repaired(repair_conversations(df, chunk=7)) == want  # many chunks
    clash = df.select("*", *[F.lit(1).alias(c) for c in ("copies", "again", "part", "seq", "kind", "h", "x", "facts", "audit")])
    assert _repaired(repair_conversations(clash)) == want
    assert repair_conversations(llm.createDataFrame([], CONV)).count() == 0
    assert want[504] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repair_of_one_conversation_over_many_tasks(llm):
    """A third of all rows in one conversation, ids as text."""
    rows = [("hot", t, ["user", "assistant"][t % 2] if t % 7 else "assistant", f"{t} words." if t % 5 else f"{t} words") for t in range(900)]
    rows += [(f"c{c}", t, ["user", "assistant"][t], "Good.") for c in range(900) for t in (0, 1)]
    df = llm.createDataFrame(rows, CONV.replace("conv_id long", "conv_id string")).repartition(4)
    llm.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert _repaired(repair_conversations(df, chunk=16)) == brute_repair(rows)
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", "8")


# --- spelling variants -----------------------------------------------------------

RUN = re.compile("[A-Za-zÀ-ÿ]+")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows):
    n = Counter()
    for doc, text, *_ in rows:
        for run in RUN.findall(text or ""):
            w = run.translate(A_Z)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_variants(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def _variants(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def _misspelt(seed=1, size=400):
    import random

    rng = random.Random(seed)
    letters = "abcdeéßn"
    n = Counter()
    for _ in range(size):
        w = "".join(rng.choice(letters) for _ in range(rng.choice([6, 7, 9, 12])))
        k = rng.choice([5, 30, 200])
        n[w] += k
        for _ in range(3):
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            v = w[:at] + ("" if kind == 0 else rng.choice(letters)) + w[at + (kind < 2) :]
            n[v] += max(1, k // 6)
            n[v[:-1]] += max(1, k // 40)
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def test_words_are_counted_after_damage(docs, rows, clashing, empty):
    want = brute_words(rows)
    for df in (docs, clashing):
        assert {tuple(r) for r in count_words(df).collect()} == set(want.items())
    assert spelling_variants(empty).count() == 0


def test_damage_and_case(llm):
    rows = [(None, "ÉCOLES écoles Écoles×÷x ABCdefg abcdefg's", "", "", 0)] * 7 + [(i, f"wordword{'y' * (i % 3)} Straßen-Bahnen", "", "", 0) for i in range(2000)]
    want = brute_words(rows)
    got = {tuple(r) for r in count_words(llm.createDataFrame(rows, SCHEMA)).collect()}
    assert got == set(want.items()) and 600 < want["wordword"] < 667  # some lost a letter
    assert _variants(spelling_variants(llm.createDataFrame(rows, SCHEMA))) == brute_variants(want)


@pytest.mark.parametrize("crowd", [256, 1])
def test_variants_equal_brute_force(llm, crowd):
    n = _misspelt()
    df = llm.createDataFrame([(w, k, 1) for w, k in n.items()], "word string, n long, key int").repartition(3)
    got = _variants(group_variants(df, crowd=crowd))
    assert got == brute_variants(n)
    assert any(f and r != f for _, f, r, *_ in got)  # chains are followed


@settings(max_examples=200, deadline=None)
@given(st.text("abcdé", min_size=6, max_size=10), st.integers(0, 9), st.sampled_from("abcdé"), st.integers(0, 2))
def test_near_words_share_a_signature(word, at, letter, kind):
    at %= len(word)
    other = word[:at] + ("" if kind == 0 else letter) + word[at + (kind < 2) :]
    a, b = signatures([word, other])
    assert set(a.tolist()) & set(b.tolist())


def test_crowded_signatures_lose_no_pair(llm):
    words = sorted({w for base in ("abcabc", "bcabca") for i in range(6) for c in "abc" for w in (base[:i] + c + base[i + 1 :], base[:i] + c + base[i:], base)})
    want = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    for crowd in (0, 2, 1000):
        got = near_pairs(llm.createDataFrame([(w,) for w in words], "word string"), crowd=crowd)
        assert {tuple(r) for r in got.collect()} == want


# --- packing -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(open(BPE, encoding="utf-8").read())


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("ab e's<|>endoftx\n\t 09", max_size=60))
def test_ids_equal_the_library(encoder, tokenizer, text):
    text = text.encode("utf-8", "ignore").decode()
    assert encoder(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_whole_tables_equal_the_library(llm, encoder, tokenizer):
    assert encoder.fast is not None
    for text in ["a<|endoftext|>b", "x" * 5000, "é😀" * 400, " " * 3000 + "z", "\n" * 1001 + "ab", "=" * 999]:
        assert encoder(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert longest_run("") == 0 and longest_run("ab  c") == 2 and longest_run("a" + " " * 9) == 9 and longest_run("abc") == 3
    for r in llm.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect():
        assert encoder(r.text or "").tolist() == tokenizer.encode(r.text or "", add_special_tokens=False).ids


def brute_fill(lengths, capacity):
    """One sequence by trying all fits and all pairs."""
    left, taken = sorted(lengths, reverse=True), []
    for x in list(left):
        if sum(taken) + x <= capacity:
            taken.append(x)
            left.remove(x)
    while sum(taken) < capacity and len(taken) > 1:
        small = min(taken)
        room = capacity - sum(taken) + small
        pool = sorted([*left, small], reverse=True)
        best = max(((a + b, a, b) for i, a in enumerate(pool) for b in pool[i + 1 :] if a + b <= room), default=(0, 0, 0))
        if best[0] <= small:
            break
        taken.remove(small)
        taken += best[1:]
        left = pool
        for x in best[1:]:
            left.remove(x)
    return Counter(taken)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=30))
def test_a_sequence_is_filled_like_brute_force(lengths):
    counts = np.bincount(lengths, minlength=41)
    assert Counter(fill_one(counts, 40)) == brute_fill(lengths, 40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=33, max_size=33))
def test_plans_are_whole_and_tight(counts):
    counts = np.array([0, *counts[1:]])
    plan = plan_sequences(counts, 32)
    used, fill = Counter(), Counter()
    for size, first, each, copies, sequence, offset in plan.tolist():
        assert first == used[size]
        used[size] += each * copies
        for s in range(sequence, sequence + copies):
            fill[s] += each * size
    assert used == Counter({s: int(n) for s, n in enumerate(counts) if n}) and all(f <= 32 for f in fill.values())
    least = -(-int((counts * np.arange(33)).sum()) // 32)
    big = int(counts[17:].sum())
    assert len(fill) <= 11 / 9 * max(least, big) + 4


def _packed(df, rows, tokenizer, capacity):
    got = df.collect()
    want = Counter()
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]
        for k, (lo, hi) in enumerate(pieces_of(np.array(ids), capacity)):
            want[r[0], k, lo, hi - lo, zlib.crc32(np.array(ids[lo:hi], dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r.length for r in got) // capacity)


def test_pieces():
    assert pieces_of(np.arange(5), 5) == [(0, 5)] and pieces_of(np.arange(12), 5) == [(0, 2), (2, 7), (7, 12)] and pieces_of(np.arange(1), 5) == [(0, 1)]


def test_pack_rows(docs, rows, clashing, empty, tokenizer):
    for df, capacity in ((docs, 1024), (clashing.repartition(7), 1024), (docs, 100)):
        n, least = _packed(pack_documents(df, BPE, capacity=capacity), rows, tokenizer, capacity)
        assert n <= 11 / 9 * least + 1
    assert pack_documents(empty, BPE).count() == 0
    for r in pack_documents(docs, BPE, with_ids=True).collect():
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32


def test_pack_repeated_and_null_ids(llm, tokenizer):
    import random

    rows = [(None, prose(random.Random(1), 30), "", "", 0)] * 40 + [("k", None, "", "", 0)] * 5
    n, least = _packed(pack_documents(llm.createDataFrame(rows, SCHEMA.replace("doc_id long", "doc_id string")).repartition(6), BPE), rows, tokenizer, 1024)
    assert n <= least + 2
