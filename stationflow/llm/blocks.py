"""Blocks of texts, and exchanges of packed keys between them.

The dedup operators hash every position of every text. Shuffling a row per
position would move many times the input, so texts are laid out in blocks of
bounded size, a task works on one block at a time with NumPy, and only packed
arrays of keys travel: each block sends the sorted keys of a hash range to the
task of that range (a bucket), which sees the keys of all blocks and answers
each block with a few bits per key. Blocks can be recomputed from their texts,
so a bit's meaning is its place in the block's own sorted list.

A key that occurs everywhere is sent once by each block, so the buckets stay
even: no key, text or group of copies is ever gathered row by row."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.shared import stored

#: Bytes of text in a block, about; a longer text makes its block longer.
BLOCK_BYTES = 12 << 20
REQUEST = "bucket int, block int, n int, payload binary"
REPLY = "block int, bucket int, payload binary"


class Blocks:
    """Stored texts, one row ``block, payload`` for each block (payload: its
    rows, compressed together). Blocks follow the order of doc_id; rows of one
    doc_id are in one block."""

    def __init__(self, table: DataFrame, count: int, text_bytes: int, id_type: str) -> None:
        self.table, self.count, self.text_bytes, self.id_type = table, count, text_bytes, id_type


class Rows:
    """A block's rows in order of doc_id (null first): ids, xxhash64 of the
    texts (``t``), texts as bytes (a null text is empty), and row numbers
    ``k``, which hold the block's number from bit 33 on."""

    def __init__(self, block: int, payload: bytes) -> None:
        import zstandard

        table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(payload)).read_all()
        self.ids, self.t, self.texts = (table[c].to_pylist() for c in ("doc_id", "t", "text"))
        self.k = [(block << 33) + i for i in range(table.num_rows)]


def text_blocks(documents: DataFrame, *, block_bytes: int = BLOCK_BYTES) -> Blocks:
    total = documents.agg(F.sum(F.octet_length("text").cast("long") + 1)).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    id_type = dict(documents.dtypes)["doc_id"]

    def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = pa.array([packer.compress(t.as_py() or b"") for t in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), z], ["doc_id", "t", "z"])

    def laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.concat_tables(tables).combine_chunks()
        # Rows of equal id and text are alike, so this order is the same in every attempt.
        keys = pa.table({"some": table["doc_id"].is_valid().cast(pa.int8()), "doc_id": table["doc_id"], "t": table["t"]})
        table = table.take(pa.compute.sort_indices(keys, sort_keys=[(c, "ascending") for c in keys.column_names]))
        unpack = zstandard.ZstdDecompressor().decompress
        texts = pa.array([unpack(z.as_py()) for z in table["z"]], pa.large_binary())
        rows = pa.table({"doc_id": table["doc_id"], "t": table["t"], "text": texts}).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_table(rows)
        payload = zstandard.ZstdCompressor(level=5).compress(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([table["block"].chunk(0)[:1] if table["block"].num_chunks else table["block"], pa.array([payload], pa.binary())], ["block", "payload"])

    rows = documents.select("doc_id", F.xxhash64("text").alias("t"), F.col("text").cast("binary").alias("text")).mapInArrow(
        compressed, f"doc_id {id_type}, t long, z binary"
    )
    ranged = rows.repartitionByRange(count, "doc_id").select(F.spark_partition_id().alias("block"), "doc_id", "t", "z")
    table = stored(ranged.mapInArrow(laid, "block int, payload binary"), "text-blocks")
    last = table.agg(F.max("block")).first()[0]
    return Blocks(table, 0 if last is None else last + 1, int(total), id_type)


def give_back() -> None:
    """Return memory that a finished block held to the system: Python workers
    live on between tasks, and an executor's share is limited."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


BlockFunction = Callable[[int, Rows, pa.Table | None], pa.Table]


def each_block(blocks: Blocks, fn: BlockFunction, schema: str, replies: DataFrame | None = None) -> DataFrame:
    """``fn(block, rows, replies)`` for each block; ``replies`` are the rows of
    that frame with the block's number. Without replies the stored blocks are
    read where they lie; with them, blocks and replies meet by shuffle."""
    if replies is None:

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, payload in zip(batch.column(0), batch.column(1), strict=True):
                    out = fn(block.as_py(), Rows(block.as_py(), payload.as_py()), None)
                    give_back()
                    yield from out.to_batches()

        return blocks.table.select("block", "payload").mapInArrow(alone, schema)

    def both(key: tuple[pa.Scalar, ...], t: pa.Table, r: pa.Table) -> pa.Table:
        block = key[0].as_py()
        out = fn(block, Rows(block, t["payload"][0].as_py()), r)
        give_back()
        return out

    return blocks.table.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(both, schema)


# --- packed arrays ------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes; ascending uint64 arrays as steps."""
    import zstandard

    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        steps = a.dtype == np.uint64 and len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        if steps:
            a = np.concatenate([a[:1], np.diff(a)])
        planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T
        head = np.array([len(a), a.dtype.itemsize, ord(a.dtype.kind), steps], dtype=np.int64)
        parts += [head.tobytes(), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(payload: bytes) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(payload)
    at, out = 0, []
    while at < len(data):
        n, width, kind, steps = np.frombuffer(data, np.int64, 4, at)
        at += 32
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        at += int(n * width)
        a = np.ascontiguousarray(planes.T).view(np.dtype(f"{chr(kind)}{width}")).reshape(n)
        out.append(np.cumsum(a, dtype=np.uint64) if steps else a)
    return out


# --- exchange -----------------------------------------------------------------


def bucket_bits(entries: int, per_bucket: int = 1 << 20) -> int:
    """log2 of the buckets that hold so many entries."""
    return max(0, (max(1, entries) - 1).bit_length() - (per_bucket - 1).bit_length())


def cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places where a sorted uint64 array passes from bucket to bucket."""
    if not bits:
        return np.array([0, len(keys)])
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, edges, side="left"), [len(keys)]])


def requests_table(block: int, keys: np.ndarray, extra: list[np.ndarray], bits: int) -> pa.Table:
    """A row for each bucket in which the block has keys (sorted, with arrays
    of the same length beside them)."""
    at = cuts(keys, bits)
    full = np.nonzero(np.diff(at))[0]
    rows = [pack(keys[at[b] : at[b + 1]], *(e[at[b] : at[b + 1]] for e in extra)) for b in full]
    return pa.table({
        "bucket": pa.array(full, pa.int32()),
        "block": pa.array([block] * len(full), pa.int32()),
        "n": pa.array(np.diff(at)[full], pa.int32()),
        "payload": pa.array(rows, pa.binary()),
    })


def gathered(requests: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """A bucket's requests: block numbers, entries of each, and the arrays of
    all blocks end to end, blocks in order."""
    requests = requests.sort_by("block")
    arrays = [unpack(p.as_py()) for p in requests["payload"]]
    return requests["block"].to_numpy(), requests["n"].to_numpy(), [np.concatenate(a) for a in zip(*arrays, strict=True)]


def replies_table(bucket: int, blocks: np.ndarray, n: np.ndarray, arrays: list[np.ndarray]) -> pa.Table:
    """Answers in the order of the requests, cut again by block."""
    ends = np.concatenate([[0], np.cumsum(n)])
    rows = [pack(*(a[ends[i] : ends[i + 1]] for a in arrays)) for i in range(len(blocks))]
    return pa.table({
        "block": pa.array(blocks, pa.int32()),
        "bucket": pa.array([bucket] * len(blocks), pa.int32()),
        "payload": pa.array(rows, pa.binary()),
    })


def replied(replies: pa.Table, n_arrays: int) -> list[np.ndarray]:
    """Answers to a block's sorted keys, buckets in order."""
    replies = replies.sort_by("bucket")
    arrays = [unpack(p.as_py()) for p in replies["payload"]]
    if not arrays:
        return [np.zeros(0, dtype=np.uint8)] * n_arrays
    return [np.concatenate(a) for a in zip(*arrays, strict=True)]
