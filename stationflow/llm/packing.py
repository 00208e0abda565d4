"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A document is its token ids and an end id; a longer one is cut into pieces of
the sequence's length, the first piece being what is left over. A sequence is
filled greedily (the longest unpacked piece that fits, again and again); then its
smallest piece is replaced by the two unpacked pieces that fill the widened gap
best, as long as that fills it more tightly.

Only the lengths of the pieces decide, and there are at most as many lengths as
tokens in a sequence. So the packing is planned on the counts of the lengths (one
row per length, whatever the size of the data): a sequence's pattern repeats until
one of its lengths runs out, and the plan says how often. The pieces themselves
never leave Spark: each knows its place among those of its length (a count within
its task plus the counts of the tasks before), which the plan turns into sequence
and offset. A length that a third of all pieces have is one row of the plan.

Token ids are those that the ``tokenizers`` library gives for the vocabulary file.
That library takes about 0.8 s of CPU a MB of text here, so the merges of the file
are run by ``tiktoken``, which gives the same ids (tested on whole tables); texts
with a run of over 1,000 bytes without or of white space, on which its merging is
quadratic, go to ``tokenizers`` itself.

Defined cases: a null or empty text is its end id alone; the vocabulary's special
strings inside texts are special tokens, as the library's default has it; repeated
rows are packed each; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from stationflow.llm.shared import stored
from stationflow.llm.text import SPACES
from stationflow.llm.token_counts import PATTERN, byte_symbols

CAPACITY = 1024
END_ID = 2
#: Bytes of one run, of white space or of other bytes, that merging takes in one go.
LONGEST_RUN = 1000


# --- token ids ----------------------------------------------------------------


class Encoder:
    """Token ids of a byte-level BPE vocabulary file of ``tokenizers``."""

    def __init__(self, vocabulary: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(vocabulary)
        spec = json.loads(vocabulary)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        byte = {symbol: b for b, symbol in enumerate(byte_symbols())}
        ranks = {bytes(byte[s] for s in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        made = [spec["model"]["vocab"][left + right] for left, right in pairs]
        # Merging by the lowest id is merging by the lowest rank where ids follow ranks.
        self.fast = None
        if all(a < b for a, b in zip(made, made[1:], strict=False)):
            self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or longest_run(text) > LONGEST_RUN:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all")


def longest_run(text: str) -> int:
    """Bytes of the longest run of ASCII white space or of other bytes."""
    space = SPACES[np.frombuffer(text.encode(), dtype=np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return int(np.diff(edges, prepend=-1, append=len(space) - 1).max()) if len(space) else 0


_ENCODERS: dict[int, Encoder] = {}


def pieces_of(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, stop) of the pieces: the rest first, then full ones."""
    rest = len(ids) % capacity
    cuts = [0, *range(rest or capacity, len(ids) + 1, capacity)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


# --- plan ---------------------------------------------------------------------


def _best_two(left: np.ndarray, room: int) -> tuple[int, int]:
    """The two lengths, still left, of the largest sum up to ``room`` (0, 0: none)."""
    size = np.arange(len(left))
    largest = np.maximum.accumulate(np.where(left > 0, size, 0))  # largest length left up to each
    y = np.flatnonzero(left[:room]) if room < len(left) else np.flatnonzero(left)
    if not len(y):
        return 0, 0
    z = largest[np.clip(np.minimum(room - y, y), 0, None)]
    twin = (z == y) & (left[y] < 2)
    z = np.where(twin, largest[y - 1], z)
    total = np.where(z > 0, y + z, 0)
    best = len(y) - 1 - int(np.argmax(total[::-1]))
    return (int(y[best]), int(z[best])) if total[best] else (0, 0)


def fill_one(left: np.ndarray, capacity: int) -> dict[int, int]:
    """Lengths of one sequence with their numbers, from the counts left."""
    left = left.copy()
    gap, taken = capacity, {}
    sizes = np.flatnonzero(left)
    while (at := int(np.searchsorted(sizes, gap, side="right"))) > 0:
        size = int(sizes[at - 1])
        n = min(int(left[size]), gap // size)
        taken[size] = n
        left[size] -= n
        gap -= n * size
        sizes = sizes[: at - 1]
    while gap > 0 and sum(taken.values()) > 1:
        small = min(taken)
        left[small] += 1
        y, z = _best_two(left, gap + small)
        if y + z <= small:
            break
        taken[small] -= 1
        if not taken[small]:
            del taken[small]
        for size in (y, z):
            taken[size] = taken.get(size, 0) + 1
            left[size] -= 1
        gap -= y + z - small
    return taken


#: Columns of a plan: pieces first..first + each * copies - 1 of a length go to
#: ``copies`` sequences from ``sequence`` on, ``each`` to one, from ``offset`` on.
PLAN = ("length", "first", "each", "copies", "sequence", "offset")


def plan_sequences(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Rows of :data:`PLAN` for ``counts[length]`` pieces of each length, by
    length and first piece. At most a few thousand patterns arise: each uses up
    one of its lengths."""
    left, used = counts.astype(np.int64).copy(), np.zeros(len(counts), dtype=np.int64)
    rows, sequence = [], 0
    while left.any():
        taken = fill_one(left, capacity)
        copies = min(int(left[size]) // n for size, n in taken.items())
        offset = 0
        for size, n in sorted(taken.items(), reverse=True):
            rows.append((size, used[size], n, copies, sequence, offset))
            offset += n * size
            used[size] += n * copies
            left[size] -= n * copies
        sequence += copies
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, len(PLAN))


_ORDINALS = 1 << 48


def placed(plan: np.ndarray, length: np.ndarray, ordinal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the pieces numbered ``ordinal`` among their length."""
    size, first, _, copies, sequence, offset = plan.T
    row = np.searchsorted(size * _ORDINALS + first, length * _ORDINALS + ordinal, side="right") - 1
    inside = ordinal - first[row]
    return sequence[row] + inside % copies[row], offset[row] + inside // copies[row] * length


# --- operator -----------------------------------------------------------------


def pack_documents(documents: DataFrame, vocabulary_path: str, *, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and
    ``ids``, the piece's token ids, if asked for) for each piece.

    The vocabulary file is read on the driver and broadcast; its size is the
    vocabulary's, whatever the size of the data."""
    context = documents.sparkSession.sparkContext
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = context.broadcast(f.read())
    id_type = dict(documents.dtypes)["doc_id"]
    id_arrow = to_arrow_type(documents.schema["doc_id"].dataType)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", *["ids"] * with_ids]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _ENCODERS.get(hash(shared.value)) or _ENCODERS.setdefault(hash(shared.value), Encoder(shared.value))
        met = np.zeros(capacity + 1, dtype=np.int64)  # pieces of each length in this task
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            doc, number, start, length, crc, nth, kept = ([] for _ in range(7))
            for i, text in enumerate(batch.column(1)):
                ids = np.concatenate([encode(text.as_py() or ""), end]).astype("<u4")
                for k, (lo, hi) in enumerate(pieces_of(ids, capacity)):
                    doc.append(i)
                    number.append(k)
                    start.append(lo)
                    length.append(hi - lo)
                    crc.append(zlib.crc32(ids[lo:hi].tobytes()))
                    nth.append(int(met[hi - lo]))
                    met[hi - lo] += 1
                    if with_ids:
                        kept.append(ids[lo:hi].astype(np.int32))
            columns = [
                batch.column(0).take(pa.array(doc, pa.int64())).cast(id_arrow),
                pa.array(number, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
                batch.column(2).take(pa.array(doc, pa.int64())),
                pa.array(nth, pa.int64()),
                *[pa.array(kept, pa.list_(pa.int32()))] * with_ids,
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    numbered = documents.select("doc_id", "text", F.spark_partition_id().alias("part"))
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<int>" * with_ids
    pieces = stored(numbered.mapInArrow(cut, schema), "pack-pieces")

    of_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = of_part.select(F.col("part").alias("_part"), F.col("length").alias("_length"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in of_part.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` rows
        counts[size] = n
    plan = context.broadcast(plan_sequences(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                length, ordinal = batch.column("length").to_numpy(), batch.column("ordinal").to_numpy()
                sequence, offset = placed(plan.value, length, ordinal)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in out), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*out, "sequence_id", "offset"]
                )

    out = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    ordered = pieces.join(bases, F.expr("part = _part and length = _length")).selectExpr(*out, "base + nth as ordinal")
    result = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return ordered.mapInArrow(place, result + ", sequence_id long, offset long")
