"""Source mixing: apportionment, targets, block selection."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from conftest_llm import SCHEMA, clashing, docs, empty, llm, rows, words  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from stationflow.llm.mixing import MOST_PASSES, WEIGHTS, mix_sources, sainte_lague, source_targets, taken_by_blocks


def by_quotients(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats if any(v > 0 for v in votes) else 0):
        i = max(range(len(votes)), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
        got[i] += 1
    return got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=8), st.integers(0, 60))
def test_seats_follow_highest_quotients(votes, seats):
    assert sainte_lague([float(v) for v in votes], seats) == by_quotients(votes, seats)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets(sizes):
    weights = [WEIGHTS[i % 3] for i in range(len(sizes))]
    got = source_targets(sizes, weights)
    assert sum(got) == Fraction(3, 2) * sum(sizes)
    assert all(0 <= t <= MOST_PASSES * s for t, s in zip(got, sizes, strict=True))
    per = [t / w for t, s, w in zip(got, sizes, weights, strict=True) if 0 < t < MOST_PASSES * s]
    assert len(set(per)) <= 1  # uncapped sources share by weight
    if per:
        assert all(t / w <= per[0] for t, s, w in zip(got, sizes, weights, strict=True))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=30), st.integers(0, 200), st.integers(1, 16), st.integers(0, 99))
def test_blocks_taken(sizes, quota, block, seed):
    sizes = np.array(sizes, dtype=np.int64)
    taken = taken_by_blocks(sizes, quota, block, seed)
    assert (taken >= 0).all() and (taken <= MOST_PASSES * sizes).all()
    want = min(quota * block, MOST_PASSES * int(sizes.sum()))
    assert abs(int(taken.sum()) - want) <= block
    assert (taken == taken_by_blocks(sizes, quota, block, seed)).all()


def _check(rows, got):
    size = {}
    for r in rows:
        size.setdefault(r[3], []).append(len(words(r[1])))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, source_targets([sum(size[s]) for s in order], [WEIGHTS[i % 3] for i in range(len(order))]), strict=True))
    assert sorted((r["doc_id"], r["size"]) for r in got) == sorted((r[0], len(words(r[1]))) for r in rows)
    for r in got:
        assert r["source_size"] == sum(size[r["source"]]) and r["target"] == float(targets[r["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
    for s in order:
        taken = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(taken - float(targets[s])) <= max(1, 0.02 * float(targets[s])), (s, taken, float(targets[s]))


def test_mix_rows(llm, docs, rows, clashing, empty):
    got = mix_sources(docs).collect()
    _check(rows, got)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mix_sources(clashing.repartition(5)).collect()), key=repr)
    _check(rows, mix_sources(docs, shard_tokens=3000).collect())  # large sources in several shards
    assert mix_sources(empty).count() == 0


def test_mix_of_tiny_and_wordless_sources(llm):
    rows = [(1, "a b c d e", "en", "x", 0), (2, None, "en", "y", 0), (3, " ", "en", None, 0), (4, "w " * 5000, "en", "z", 0), (4, "w " * 5000, "en", "z", 0), (6, "q r s", "en", "\U0001f600", 0), (7, "m n", "en", "\ufffd", 0)]
    _check(rows, mix_sources(llm.createDataFrame(rows, SCHEMA)).collect())


def test_ids_of_any_type(llm):
    rows = [(None, "a b c " * 40, None, "x", 0), ("k", "d e " * 50, None, "x", 0), ("k", "d e " * 50, None, "x", 0), (None, "f", None, "y", 0)]
    got = mix_sources(llm.createDataFrame(rows, SCHEMA.replace("doc_id long", "doc_id string"))).collect()
    assert sorted(r["size"] for r in got) == [1, 100, 100, 120] and all(r["taken"] <= 2 * r["size"] for r in got)
