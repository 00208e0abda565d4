"""Substring dedup by windows of words with a count-min prefilter.

Pass 1: every block of texts counts its windows in a sketch (rows of cells,
counters that stop at two); the blocks' sketches are merged cell by cell. The
merged sketch never counts too few, so a window that it counts once is unique.
Pass 2: only windows estimated as repeated are grouped exactly, by the 96-bit
hash of their word sequence: blocks follow the order of doc_id, so the question
whether a smaller doc_id has a window is one bit: whether an earlier block has
it, or an earlier document of the same block. Pass 3 removes the covered words.

The sketch has three cells per window and row up to a fixed size, which bounds
what is broadcast. Beyond it more windows are estimated as repeated and pass 2
groups more of them; no window is lost and the result stays the same.

Defined cases: a null text has no words; texts shorter than a window keep all
words; rows that share a doc_id are not copies of each other; a null doc_id is
the smallest; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stationflow.llm.blocks import (
    REPLY,
    REQUEST,
    Rows,
    bucket_bits,
    each_block,
    gathered,
    pack,
    replied,
    replies_table,
    requests_table,
    text_blocks,
    unpack,
)
from stationflow.llm.shared import stored
from stationflow.llm.text import mixed, sequence_hashes, word_hashes

WINDOW_WORDS = 13
SKETCH_ROWS = 2
#: Cells per window in each row, and the most cells of a row (64 MB of bits).
CELLS_PER_WINDOW, MOST_CELLS = 3, 1 << 29
SLICE = 1 << 22
FAN_IN = 64


def _windows(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """word owners; place of each whole window, its hash and its check hash."""
    words, owner = word_hashes(texts)
    if len(words) < n:
        none = np.zeros(0, dtype=np.uint64)
        return owner, np.zeros(0, dtype=np.int64), none, none.astype(np.uint32)
    whole = np.nonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])[0]
    return owner, whole, sequence_hashes(words, n)[whole], (sequence_hashes(words, n, 1)[whole] >> np.uint64(32)).astype(np.uint32)


def _cells(h: np.ndarray, row: int, width: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = mixed(h + np.uint64(0x9E3779B97F4A7C15 * (row + 1) % 2**64))
    return ((x >> np.uint64(32)) * np.uint64(width)) >> np.uint64(32)


def merged_sketch(blocks, width: int, rows: int, n: int) -> np.ndarray:
    """Bits (rows x width) of the cells that count two or more windows."""
    slices = -(-width // SLICE)

    def counted(block: int, docs: Rows, _: pa.Table | None) -> pa.Table:
        texts = docs.texts
        _, _, h, _ = _windows(texts, n)
        out = []
        for row in range(rows):
            cell, count = np.unique(_cells(h, row, width), return_counts=True)
            edges = np.searchsorted(cell, np.arange(slices + 1, dtype=np.uint64) * np.uint64(SLICE))
            for s in range(slices):
                own = slice(edges[s], edges[s + 1])
                if edges[s + 1] > edges[s]:
                    out.append((row * slices + s, block // FAN_IN, pack(cell[own] - np.uint64(s * SLICE), np.packbits(count[own] > 1))))
        return pa.table({
            "slice": pa.array([x[0] for x in out], pa.int32()),
            "part": pa.array([x[1] for x in out], pa.int32()),
            "payload": pa.array([x[2] for x in out], pa.binary()),
        })

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table, last: bool) -> pa.Table:
        total = np.zeros(SLICE, dtype=np.uint8)
        for p in table["payload"]:
            a, b = unpack(p.as_py())
            if a.dtype == np.uint64:  # cells of one block
                total[a] = np.minimum(total[a] + 1 + np.unpackbits(b, count=len(a)), 2)
            else:  # bits of merged blocks: once or more, twice or more
                total = np.minimum(total + np.unpackbits(a) + np.unpackbits(b), 2)
        twice = np.packbits(total > 1)
        payload = pack(twice) if last else pack(np.packbits(total > 0), twice)
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py() // FAN_IN], pa.int32()), "payload": [payload]})

    def merged(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return merge(key, table, last=False)

    def merged_last(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return merge(key, table, last=True)

    schema = "slice int, part int, payload binary"
    sketches = each_block(blocks, counted, schema)
    parts = -(-blocks.count // FAN_IN)
    while parts > 1:  # a tree of merges: each task takes at most FAN_IN sketches
        sketches = sketches.groupBy("slice", "part").applyInArrow(merged, schema)
        parts = -(-parts // FAN_IN)
    sketches = sketches.groupBy("slice", "part").applyInArrow(merged_last, schema)
    bits = np.zeros((rows, slices * SLICE // 8), dtype=np.uint8)
    for r in sketches.select("slice", "payload").collect():  # at most rows * MOST_CELLS bits
        row, s = divmod(r["slice"], slices)
        bits[row, s * SLICE // 8 : (s + 1) * SLICE // 8] = unpack(bytes(r["payload"]))[0]
    return bits


def _repeated(bits: np.ndarray, h: np.ndarray, width: int) -> np.ndarray:
    maybe = np.ones(len(h), dtype=bool)
    for row in range(len(bits)):
        at = np.nonzero(maybe)[0]
        cell = _cells(h[at], row, width)
        maybe[at] = (bits[row][cell >> np.uint64(3)] >> (np.uint64(7) - (cell & np.uint64(7))).astype(np.uint8)) & 1
    return maybe


def remove_repeated_windows(
    documents: DataFrame,
    *,
    window: int = WINDOW_WORDS,
    rows: int = SKETCH_ROWS,
    most_cells: int = MOST_CELLS,
    block_bytes: int | None = None,
    with_text: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``text``, the kept
    words, if asked for) for each row."""
    blocks = text_blocks(documents, **({"block_bytes": block_bytes} if block_bytes else {}))
    width = max(SLICE, min(most_cells, CELLS_PER_WINDOW * (blocks.text_bytes // 6)))
    sketch = documents.sparkSession.sparkContext.broadcast(merged_sketch(blocks, width, rows, window))
    bits = bucket_bits(blocks.text_bytes // 20)

    def candidates(texts: list[bytes]):
        owner, place, h, check = _windows(texts, window)
        own = np.nonzero(_repeated(sketch.value, h, width))[0]
        place, h, check = place[own], h[own], check[own]
        order = np.lexsort((place, check, h))
        place, h, check = place[order], h[order], check[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
        return owner, place, h, check, new

    def ask(block: int, docs: Rows, _: pa.Table | None) -> pa.Table:
        texts = docs.texts
        _, _, h, check, new = candidates(texts)
        return requests_table(block, h[new], [check[new]], bits)

    def answer(key: tuple[pa.Scalar, ...], requests: pa.Table) -> pa.Table:
        numbers, n, (h, check) = gathered(requests)
        order = np.lexsort((check, h))  # stable: earlier blocks first
        first = np.ones(len(h), dtype=bool)
        first[1:] = (h[order][1:] != h[order][:-1]) | (check[order][1:] != check[order][:-1])
        seen = np.empty(len(h), dtype=np.uint8)
        seen[order] = ~first
        return replies_table(key[0].as_py(), numbers, n, [seen])

    replies = stored(each_block(blocks, ask, REQUEST).groupBy("bucket").applyInArrow(answer, REPLY), "window-replies")

    def removed(block: int, docs: Rows, replies: pa.Table | None) -> pa.Table:
        ids, texts = docs.ids, docs.texts
        owner, place, h, check, new = candidates(texts)
        (earlier,) = replied(replies, 1)
        group = np.cumsum(new) - 1
        # Rows come in order of doc_id; equal ids have one rank.
        rank = np.cumsum([0, *(a != b for a, b in zip(ids[1:], ids[:-1], strict=True))])[owner[place]] if len(place) else place
        least = rank[new] if len(place) else rank  # the first place of a window has its smallest rank
        covered = place[(earlier[group] > 0) | (rank > least[group])] if len(place) else place
        edge = np.zeros(len(owner) + 1, dtype=np.int32)
        np.add.at(edge, covered, 1)
        np.add.at(edge, covered + window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        out = []
        for i, text in enumerate(texts):
            words, lost = text.split(), gone[ends[i] : ends[i + 1]]
            kept = b" ".join(compress(words, ~lost)) if lost.any() else b" ".join(words)
            out.append((len(words), int(lost.sum()), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        n_words, n_removed, digest, kept = zip(*out, strict=True) if out else ([], [], [], [])
        table = {"doc_id": pa.array(ids, id_arrow), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
        if with_text:
            table["text"] = pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())
        return pa.table(table)

    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(documents.schema["doc_id"].dataType)
    schema = f"doc_id {blocks.id_type}, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    return each_block(blocks, removed, schema, replies)
