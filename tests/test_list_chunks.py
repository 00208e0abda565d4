"""Connection lists cut into bounded, ordered chunks."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from stationflow import operators as op
from stationflow.operators.list_chunks import _PART, CHUNK, ELEMENTS, connection_list_chunks, numbered_elements, placed_elements

SCHEMA = "file string, station long, role string, other_station long, travel_time long, n long"


def _lists(seed=3):
    rng = random.Random(seed)
    counts = defaultdict(int)
    for _ in range(3000):
        hot = rng.random() < 0.4
        station = 7 if hot else rng.choice([None, *range(12)])
        other, time = rng.choice([None, *range(40)]), rng.choice([None, *range(60)])
        counts[("a" if hot else rng.choice(["a", "b"]), station, rng.choice(["o", "d"]), other, time)] += rng.choice([1, 1, 2, 50])
    return [(*k, n) for k, n in counts.items()]


def _null_first(x):
    return tuple((v is not None, v) for v in x)


@pytest.mark.parametrize(("size", "partitions"), [(1, 3), (7, 6), (1000, 6), (10**6, 2)])
def test_chunks_equal_the_ordered_lists(spark, size, partitions):
    rows = _lists() if size > 1 else [(*r[:5], min(r[5], 3)) for r in _lists()[:300]]
    want = defaultdict(list)
    for f, s, r, other, time, n in rows:
        want[f, s, r] += [(other, time)] * n
    got = connection_list_chunks(spark.createDataFrame(rows, SCHEMA), size=size, partitions=partitions).collect()
    assert len({(x["file"], x["station"], x["role"], x[CHUNK]) for x in got}) == len(got)
    parts = defaultdict(dict)
    for x in got:
        parts[x["file"], x["station"], x["role"]][x[CHUNK]] = [tuple(e) for e in x[ELEMENTS]]
    assert set(parts) == set(want)
    for key, chunks in parts.items():
        whole = sorted(want[key], key=_null_first)
        assert [chunks[i] for i in range(len(chunks))] == [whole[i : i + size] for i in range(0, len(whole), size)]


def test_a_hot_list_is_spread(spark):
    """Two fifths of all elements lie in two lists; no partition holds much more
    than its share, and ordinals run through all partitions of a list."""
    lists = spark.createDataFrame(_lists(), SCHEMA)
    placed = placed_elements(lists, 8)
    sizes = [r["count"] for r in placed.groupBy(_PART).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.5 * sum(sizes) / 8
    hot = placed.where("file = 'a' AND station = 7 AND role = 'o'")
    assert hot.select(_PART).distinct().count() > 1
    spans = sorted((r["first"], r["last"]) for r in numbered_elements(placed).where("file = 'a' AND station = 7 AND role = 'o'").collect())
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_no_lists_and_wrong_size(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert connection_list_chunks(none).count() == 0
    with pytest.raises(ValueError):
        connection_list_chunks(none, size=0)


def test_list_lengths_are_the_connections(spark):
    rows = [("f.json", "f.json", "f.json", 1, 2, 5), ("f.json", "f.json", "f.json", 1, 1, 6), ("f.json", "f.json", "f.json", 2, 1, 7)]
    trips = spark.createDataFrame(rows, "file string, file_name string, month string, origin long, destination long, travel_time long")
    ends = op.trip_ends(trips)
    chunks = connection_list_chunks(op.connection_lists(ends), size=2)
    got = {r["station"]: r["n"] for r in chunks.groupBy("station").agg({ELEMENTS: "count"}).selectExpr("station", f"`count({ELEMENTS})` AS n").collect()}
    lengths = {r["station"]: r["connections"] for r in chunks.selectExpr("station", f"size({ELEMENTS}) AS c").groupBy("station").sum("c").toDF("station", "connections").collect()}
    assert set(got) == {1, 2} and lengths == {r["station"]: r["connections"] for r in op.connections(ends).collect()}
