"""Token counts of a byte-level BPE vocabulary, without token ids.

The text is cut into pieces by the vocabulary's pattern; within a piece the
adjacent pair of lowest rank is popped from a heap again and again and merged
in a linked list of symbols. The piece's count is its initial symbols minus the
merges made. Pieces repeat, so each Python worker keeps a bounded table of the
counts of pieces it has met.

Defined cases: a null or empty text has 0 tokens; a special token's string
inside a text counts as one token (the library's default); repeated rows count
alike; other columns are ignored."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pattern of byte-level pre-tokenisation (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LIMIT = 512
#: Entries of a worker's table of piece counts before it is emptied.
MEMO = 400_000


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte:
    itself if printable, else the next free one from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, free = [""] * 256, 256
    for b in range(256):
        if b in own:
            table[b] = chr(b)
        else:
            table[b] = chr(free)
            free += 1
    return table


class PieceCounts(dict):
    """Piece -> number of tokens; unknown pieces are merged and remembered."""

    def __init__(self, vocabulary: str) -> None:
        super().__init__()
        import regex

        spec = json.loads(vocabulary)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("a byte-level BPE vocabulary without normalizer and prefix space is expected")
        ids: dict[str, int] = {}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        name = lambda s: ids.setdefault(s, len(ids))
        self.bytes = [name(s) for s in byte_symbols()]
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.setdefault((name(left), name(right)), (rank, name(left + right)))
        self.pieces = regex.compile(PATTERN).findall
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def __missing__(self, piece: str) -> int:
        n = self.merged(piece.encode("utf-8", "surrogatepass"))
        if len(self) >= MEMO:
            self.clear()
        self[piece] = n
        return n

    def merged(self, piece: bytes) -> int:
        """Symbols left after merging by lowest rank, leftmost among equals."""
        n = len(piece)
        symbol = [self.bytes[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs
        heap = [(*pairs[p], i, p) for i in range(n - 1) if (p := (symbol[i], symbol[i + 1])) in pairs]
        heap = [(rank, i, p, new) for rank, new, i, p in heap]
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, pair, new = heapq.heappop(heap)
            j = after[i]
            if j >= n or symbol[i] != pair[0] or symbol[j] != pair[1]:
                continue  # one of the two was merged meanwhile
            symbol[i], symbol[j] = new, -1
            after[i] = k = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if (p := (new, symbol[k])) in pairs:
                    rank, made = pairs[p]
                    heapq.heappush(heap, (rank, i, p, made))
            if (h := before[i]) >= 0 and (p := (symbol[h], new)) in pairs:
                rank, made = pairs[p]
                heapq.heappush(heap, (rank, h, p, made))
        return left

    def count(self, text: str) -> int:
        if self.special is None:
            return sum(map(self.__getitem__, self.pieces(text)))
        total = at = 0
        for m in self.special.finditer(text):
            total += 1 + sum(map(self.__getitem__, self.pieces(text[at : m.start()])))
            at = m.end()
        return total + sum(map(self.__getitem__, self.pieces(text[at:] if at else text)))


_LOADED: dict[int, PieceCounts] = {}


def count_tokens(documents: DataFrame, vocabulary_path: str, *, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row.

    The vocabulary file is read on the driver and broadcast; its size is the
    vocabulary's (1.5 MB here), whatever the size of the data."""
    with open(vocabulary_path, encoding="utf-8") as f:
        content = f.read()
    shared = documents.sparkSession.sparkContext.broadcast(content)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _LOADED.get(hash(shared.value)) or _LOADED.setdefault(hash(shared.value), PieceCounts(shared.value))
        for batch in batches:
            n = pa.array([counts.count(t.as_py()) if t.is_valid else 0 for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    kind = dict(documents.dtypes)["doc_id"]
    rows = documents.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")

