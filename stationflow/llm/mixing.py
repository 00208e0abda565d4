"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is dealt out in equal-token blocks. Every source's documents are
hashed into shards of bounded size (a source that holds a third of all tokens
has many shards, a small one has a single shard). Within each shard the blocks
are apportioned to the sources present by highest quotients, which gives an
integer quota per (source, shard). Each (source, shard) then lays its documents
end to end in seeded order, cuts them into blocks and takes its quota: whole
passes first, then the blocks with the lowest seeded hashes.

Defined cases: a null text has size 0 and takes nothing; a null source is a
source of its own, last in code-point order; a null doc_id is one more id;
repeated rows are separate documents; an empty table gives no rows; a source without words has target 0.
Columns other than the three named ones are ignored."""

from __future__ import annotations

import heapq
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that make up the size of a text (fixed by the contract).
WORDS = r"[^\x20\x09-\x0D]+"
#: Source weights in code-point order, repeating (fixed by the contract).
WEIGHTS = (3, 1, 2)
#: Share of all sizes that the mix takes, and the most passes over a document.
SHARE, MOST_PASSES = Fraction(3, 2), 2
BLOCK_TOKENS = 64
SHARD_TOKENS = 2_000_000


def sainte_lague(votes: list[float], seats: int) -> list[int]:
    """Seats by highest quotients votes/(2s+1); ties go to the earlier entry.

    Starts from the seats of a divisor that gives at most ``seats`` and adds
    the few missing ones from a heap of next quotients."""
    live = [i for i, v in enumerate(votes) if v > 0]
    got = [0] * len(votes)
    if not live or seats <= 0:
        return got
    lo, hi = 0.0, 2.0 * sum(votes) + 1.0  # divisor: lo gives too many seats, hi none

    def dealt(divisor: float) -> int:
        return sum(int(votes[i] / divisor + 0.5) for i in live)

    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        if dealt(mid) > seats:
            lo = mid
        else:
            hi = mid
    for i in live:
        got[i] = int(votes[i] / hi + 0.5)
    heap = [(-votes[i] / (2 * got[i] + 1), i) for i in live]
    heapq.heapify(heap)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(heap)
        got[i] += 1
        heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def source_targets(sizes: list[int], weights: list[int], share: Fraction = SHARE, most: int = MOST_PASSES) -> list[Fraction]:
    """Targets in proportion to the weights; each stops at ``most`` times its
    source's size and the excess is dealt again by weight until none is above."""
    target = [Fraction(0)] * len(sizes)
    free = [i for i, s in enumerate(sizes) if s > 0]
    left = share * sum(sizes)
    while free:
        total = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] >= most * sizes[i] * total]
        if not full:
            for i in free:
                target[i] = left * weights[i] / total
            break
        for i in full:
            target[i] = Fraction(most * sizes[i])
        left -= sum(target[i] for i in full)
        free = [i for i in free if i not in set(full)]
    return target


def _shuffled(n: int, seed: int) -> np.ndarray:
    """A seeded 64-bit hash for each of n blocks (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (np.arange(n, dtype=np.uint64) + np.uint64(seed & (2**63 - 1))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def taken_by_blocks(sizes: np.ndarray, quota: int, block: int, seed: int) -> np.ndarray:
    """Tokens taken of each document when ``quota`` blocks are taken of the
    documents laid end to end: whole passes, then whole blocks by lowest
    seeded hash. The last block of the shard may be shorter; it is taken last."""
    total = int(sizes.sum())
    if total == 0 or quota <= 0:
        return np.zeros(len(sizes), dtype=np.int64)
    passes, rest = divmod(min(quota * block, MOST_PASSES * total), total)
    taken = sizes.astype(np.int64) * passes
    blocks = min(-(-total // block), (rest + block // 2) // block)
    if blocks:
        edges = np.arange(0, total + block, block, dtype=np.int64).clip(max=total)
        n = len(edges) - 1 if edges[-1] > edges[-2] else len(edges) - 2
        keys = _shuffled(n, seed)
        if total % block:
            keys[n - 1] = np.uint64(2**64 - 1)
        chosen = np.zeros(n, dtype=bool)
        chosen[np.argsort(keys, kind="stable")[:blocks]] = True
        upto = np.concatenate([[0], np.cumsum(np.where(chosen, np.diff(edges[: n + 1]), 0))])
        ends = np.cumsum(sizes.astype(np.int64))
        at = np.concatenate([[0], ends])
        k = np.minimum(at // block, n - 1)
        before = upto[k] + np.where(chosen[k], at - edges[k], 0)
        taken += np.diff(before)
    return taken


def mix_sources(
    documents: DataFrame, *, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS, seed: int = 20_240_501
) -> DataFrame:
    """``doc_id, size, source, source_size, target, taken`` for each row.

    The driver holds one row per source (the mix is a list of sources with
    weights); everything per document or per shard stays in tasks. The block
    shrinks when the smallest target is small, so that a quota of whole blocks
    still comes near it."""
    sized = documents.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"))
    per_source = (
        sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()  # one row per source
    )
    per_source.sort(key=lambda r: (r["source"] is None, [ord(c) for c in r["source"] or ""]))
    sizes = [int(r["size"]) for r in per_source]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))]
    targets = source_targets(sizes, weights)
    least = min((t for t in targets if t > 0), default=Fraction(1))
    block = max(1, min(block_tokens, int(least / 128)))
    spark = documents.sparkSession
    plan = [
        (r["source"], i, s, float(t), max(1, -(-(s + int(r["n"])) // shard_tokens)))
        for i, (r, s, t) in enumerate(zip(per_source, sizes, targets, strict=True))
    ]
    sources = spark.createDataFrame(plan, "source string, place int, source_size long, target double, shards int")
    # One row per source: the same bound as the collected totals above.
    dealt = sized.alias("d").join(F.broadcast(sources.alias("s")), F.expr("d.source <=> s.source")).select(
        "doc_id", "d.source", "size", "place", "source_size", "target", "shards",
        F.expr(f"cast(pmod(xxhash64(doc_id, {seed}L), shards) as int)").alias("shard"),
    )
    per_shard = dealt.groupBy("shard", "place", "source_size", "target").agg(F.sum("size").alias("held"))

    def quotas(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        votes = [r["target"] * r["held"] / r["source_size"] if r["source_size"] else 0.0 for r in rows]
        got = sainte_lague(votes, int(sum(votes) / block + 0.5))
        return pa.table({
            "shard": pa.array([r["shard"] for r in rows], pa.int32()),
            "place": pa.array([r["place"] for r in rows], pa.int32()),
            "quota": pa.array(got, pa.int64()),
        })

    quota = per_shard.groupBy("shard").applyInArrow(quotas, "shard int, place int, quota long")

    def take(key: tuple[pa.Scalar, ...], docs: pa.Table, quota: pa.Table) -> pa.Table:
        sizes = docs.column("size").to_numpy()
        order = pc.sort_indices(docs, sort_keys=[(c, "ascending") for c in ("h", "doc_id", "size")]).to_numpy()
        mixed = seed + 1_000_003 * key[0].as_py() + 7_919 * key[1].as_py()
        taken = np.zeros(len(sizes), dtype=np.int64)
        taken[order] = taken_by_blocks(sizes[order], quota.column("quota")[0].as_py() if quota.num_rows else 0, block, mixed)
        return docs.drop_columns(["h", "shard", "place"]).append_column("taken", pa.array(taken))

    docs = dealt.select(
        "shard", "place", "doc_id", "size", "source", "source_size", "target", F.xxhash64("doc_id", F.lit(seed + 1)).alias("h")
    )
    kind = dict(documents.dtypes)["doc_id"]
    return (
        docs.groupBy("shard", "place")
        .cogroup(quota.groupBy("shard", "place"))
        .applyInArrow(take, f"doc_id {kind}, size long, source string, source_size long, target double, taken long")
    )
