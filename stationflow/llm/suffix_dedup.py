"""Removal of repeated byte strings by ranked suffixes and one doubling.

The dealt method, distributed prefix doubling, ranks position pairs at offsets 1, 2,
4, ... until unique or past the threshold. Ranking every byte so moves many times
the text, so this module keeps its first step and one doubling, on phrases instead
of bytes, and lets hashes of whole strings decide past the threshold: with phrases
of some 40 bytes a pair is already a fifth of a string of 400 bytes. The result is the same.

Suffixes are ranked at the places that repeats must share, not at every byte.
Each window of W bytes names its anchor, the place of the smallest hash in it,
which depends on these bytes only; so the windows of a text fall into runs with
one anchor, and equal strings of L bytes have equal anchors at equal places.
From anchor to anchor the text is cut into phrases.

* Rank 0: Spark sorts all (anchor, phrase) pairs by hash range; equal phrases
  get one rank, unique phrases none. An anchor without a rank is dropped: no
  string of L bytes through it repeats.
* One doubling: pairs (rank of an anchor's phrase, rank one phrase on) are sorted
  and ranked again, which compares twice the length; unique pairs are dropped.
* Past the threshold: equal pairs are told apart by the bytes that all windows
  of the run share, then by all bytes that any window of the run covers. Where
  the latter repeat, all windows of the run repeat; where only the former do
  (around an edit or the end of a passage), the run's windows are compared one
  by one.

A passage of 51 to some 63 words is mostly shorter than 400 bytes: with ``shorter``,
the bytes covered by repeated strings of that length are counted too, and nothing more
is removed. Both lengths share anchors, phrases and ranks, and the same rounds.

Keys travel packed between blocks and buckets (see :mod:`blocks`); a string that
occurs everywhere is one key per block. Spans are compared by 96 or more bits of
independent hashes.

Defined cases: a null text is empty; texts shorter than L lose nothing; a string
may repeat within its own text, overlapping itself; repeated rows are copies of
each other; matches never cross texts; an empty table gives no rows."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stationflow.llm.blocks import (
    Blocks,
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
from stationflow.llm.text import hashed_spans, joined, mixed, prefix_hashes, span_hashes

LENGTH = 400
SHORTER = 256  # for the bytes that repeat in passages below LENGTH
GRAM, SPREAD = 16, 80
_SEGMENT = 1 << 20
REQUESTS = "round int, bucket int, block int, n int, payload binary"
REPLIES = "round int, block int, bucket int, payload binary"
RUNS = 9  # round number of a block's own runs
PHRASES, PAIRS, WINDOWS = 0, 1, 5  # round numbers; of pairs and windows for the first length


def _sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w values."""
    size = 1
    while 2 * size <= w:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    return np.minimum(a[: len(a) - (w - size)], a[w - size :]) if size < w else a


def anchor_runs(data: np.ndarray, starts: np.ndarray, spread: int = SPREAD) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, first window) of each run of windows with one anchor, over a
    buffer of texts. Windows reach ``spread + GRAM - 1`` bytes and stay within
    their text; a run's windows end where the next run or the text's windows do."""
    reach = spread + GRAM - 1
    anchors, firsts = [], []
    for lo in range(0, len(data), _SEGMENT):
        part = data[lo : lo + _SEGMENT + reach - 1]
        n = len(part) - reach + 1
        if n <= 0:
            break
        c = prefix_hashes(part)
        at = np.arange(len(part) - GRAM + 1)
        key = (mixed(span_hashes(c, at, at + GRAM)) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
        place = (_sliding_min(key, spread) & np.uint64(0xFFFFFFFF)).astype(np.int64) + lo
        change = np.concatenate([[0], np.nonzero(np.diff(place))[0] + 1])
        anchors.append(place[change])
        firsts.append(change + lo)
    anchor = np.concatenate(anchors) if anchors else np.zeros(0, dtype=np.int64)
    first = np.concatenate(firsts) if firsts else np.zeros(0, dtype=np.int64)
    # Cut at the texts' bounds: a window belongs to the text it starts in and
    # must end before that text's line feed.
    lo, hi = starts[:-1], starts[1:] - 1 - reach + 1  # windows of a text: lo <= s < hi
    keep = np.searchsorted(first, lo[hi > lo], side="right") - 1
    extra_anchor, extra_first = anchor[keep], lo[hi > lo]
    anchor, first = np.concatenate([anchor, extra_anchor]), np.concatenate([first, extra_first])
    order = np.lexsort((anchor, first))
    anchor, first = anchor[order], first[order]
    owner = np.searchsorted(starts, first, side="right") - 1
    ok = first < hi[owner]
    new = np.ones(len(first), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    return anchor[ok & new], first[ok & new]


class _Runs:
    """Runs of a block's texts of at least ``least`` bytes."""

    def __init__(self, texts: list[bytes], least: int, packed: bytes | None = None) -> None:
        self.long = [i for i, t in enumerate(texts) if len(t) >= least]
        self.data, self.starts = joined([texts[i] for i in self.long]) if self.long else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        if packed is None:
            self.anchor, self.first = anchor_runs(self.data, self.starts) if self.long else (np.zeros(0, np.int64),) * 2
        else:
            self.anchor, self.first = (a.astype(np.int64) for a in unpack(packed))
        owner = np.searchsorted(self.starts, self.first, side="right") - 1
        n = len(self.first)
        self.next = np.full(n, -1)  # the run one phrase on, in the same text
        if n:
            same = np.nonzero(owner[1:] == owner[:-1])[0]
            self.next[same] = same + 1
        self.end = self.starts[owner + 1] - 1 if n else self.first
        self.follow = np.where(self.next >= 0, np.append(self.first[1:], 0), self.end + 1 - SPREAD - GRAM + 1) if n else self.first
        self.phrased = np.nonzero(self.next >= 0)[0]

    def last(self, length: int) -> np.ndarray:
        """Strings of ``length`` bytes start at first..last of a run; none where
        last is smaller."""
        return np.minimum(self.follow - 1, self.end - length)

    def packed(self) -> bytes:
        return pack(self.anchor.astype(np.uint64), self.first.astype(np.uint64))

    def phrase_keys(self) -> np.ndarray:
        i = self.phrased
        return hashed_spans(self.data, self.anchor[i], self.anchor[self.next[i]] + GRAM)


def _distinct(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sort by several keys: (order, group of each sorted place, first place
    of each group, size of each group)."""
    order = np.lexsort(keys[::-1])
    n = len(order)
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    firsts = np.nonzero(new)[0]
    return order, np.cumsum(new) - 1, firsts, np.diff(np.append(firsts, n))


def _tagged(table: pa.Table, number: int) -> pa.Table:
    return table.add_column(0, "round", pa.array([number] * table.num_rows, pa.int32()))


def _of_round(replies: pa.Table, number: int) -> pa.Table:
    import pyarrow.compute as pc

    return replies.filter(pc.equal(replies["round"], number)).drop_columns(["round"])


def _ranked(rows: _Runs, replies: pa.Table) -> np.ndarray:
    """Rank 0 of each run's phrase (0: none)."""
    keys = rows.phrase_keys()
    order, group, firsts, _ = _distinct(keys)
    (rank,) = replied(_of_round(replies, PHRASES), 1)
    out = np.zeros(len(rows.first), dtype=np.uint64)
    out[rows.phrased[order]] = rank[group]
    return out


def _hashed(data: np.ndarray, spans: list[tuple[np.ndarray, np.ndarray]], seed: int = 0) -> list[np.ndarray]:
    """Hashes of several lists of spans in one pass over the buffer."""
    start, stop = (np.concatenate(x) for x in zip(*spans, strict=True))
    order = np.argsort(start, kind="stable")
    out = np.empty(len(start), dtype=np.uint64)
    out[order] = hashed_spans(data, start[order], stop[order], seed)
    return np.split(out, np.cumsum([len(x) for x, _ in spans])[:-1])


class _Pairs:
    """Runs whose pair may repeat at one length, grouped by the keys of the
    doubled length and beyond."""

    def __init__(self, length: int, i: np.ndarray, last: np.ndarray, *keys: np.ndarray) -> None:
        self.length, self.i, self.last = length, i, last
        self.order, self.group, self.firsts, self.size = _distinct(*keys)
        self.keys = [k[self.order][self.firsts] for k in keys]


def _pairs(rows: _Runs, rank: np.ndarray, lengths: list[int]) -> list[_Pairs]:
    """Survivors of rank 0 at each length."""
    alive = np.nonzero((rows.next >= 0) & (rank > 0) & (rank[rows.next] > 0))[0]
    chosen, cores, wholes = [], [], []
    for length in lengths:
        last = rows.last(length)
        i = alive[last[alive] >= rows.first[alive]]
        p, s, e = rows.anchor[i], rows.first[i], last[i]
        chosen.append((length, i, p, s, e, last))
        cores.append((p, p + length - SPREAD + 1))
        wholes.append((s, e + length))
    n = len(lengths)
    hashes = _hashed(rows.data, [*cores, *wholes])
    again = _hashed(rows.data, wholes, 1)
    out = []
    for (length, i, p, s, e, last), core, whole, other in zip(chosen, hashes[:n], hashes[n:], again, strict=True):
        with np.errstate(over="ignore"):
            pair = mixed(mixed(rank[i]) * np.uint64(0x9E3779B97F4A7C15) + rank[rows.next[i]])
            shape = mixed((p - s).astype(np.uint64) * np.uint64(1000) + (e - s).astype(np.uint64))
            out.append(_Pairs(length, i, last, pair, core, whole + shape, other + shape))
    return out


class _Single:
    """Windows of one length to be compared one by one: of one run for each
    group flagged so."""

    def __init__(self, rows: _Runs, pairs: _Pairs, flag: np.ndarray) -> None:
        run = pairs.i[pairs.order[pairs.firsts[flag >= 2]]]
        resolved = flag[flag >= 2] == 3
        run, resolved = run[at := np.argsort(run)], resolved[at]
        counts = pairs.last[run] - rows.first[run] + 1
        self.place = np.repeat(rows.first[run] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        self.resolved = np.repeat(resolved, counts)


def _singles(rows: _Runs, pairs: list[_Pairs], flags: list[np.ndarray]) -> list[_Single]:
    out = [_Single(rows, p, flag) for p, flag in zip(pairs, flags, strict=True)]
    spans = [(x.place, x.place + p.length) for x, p in zip(out, pairs, strict=True)]
    for x, h, check in zip(out, _hashed(rows.data, spans), _hashed(rows.data, spans, 1), strict=True):
        x.h, x.check = h, (check >> np.uint64(32)).astype(np.uint32)
        x.order, x.group, x.firsts, x.size = _distinct(x.h, x.check)
    return out


def remove_repeated_bytes(documents: DataFrame, *, length: int = LENGTH, block_bytes: int | None = None, with_bytes: bool = False, shorter: int | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, the
    remaining bytes, if asked for) for each row. With ``shorter``, a length of
    its own, ``n_repeated`` follows: bytes covered by a string of that length that
    also starts anywhere else; it changes nothing of what is removed. Lengths are
    at least 256 so that every string holds two phrases."""
    lengths = [length] if shorter is None else [length, shorter]
    least = min(lengths)
    if least < 3 * SPREAD + GRAM:
        raise ValueError(f"length must be at least {3 * SPREAD + GRAM}")
    blocks = text_blocks(documents, **({"block_bytes": block_bytes} if block_bytes else {}))
    bits = bucket_bits(blocks.text_bytes // (SPREAD // 2))

    def ask_phrases(block: int, docs: Rows, _: pa.Table | None) -> pa.Table:
        texts = docs.texts
        rows = _Runs(texts, least)
        keys = rows.phrase_keys()
        order, _, firsts, size = _distinct(keys)
        own = pa.table({"bucket": pa.array([0], pa.int32()), "block": pa.array([block], pa.int32()), "n": pa.array([0], pa.int32()), "payload": [rows.packed()]})
        asked = requests_table(block, keys[order][firsts], [(size > 1).astype(np.uint8)], bits)
        return pa.concat_tables([_tagged(asked, PHRASES), _tagged(own, RUNS)])

    def rank_phrases(key: tuple[pa.Scalar, ...], requests: pa.Table) -> pa.Table:
        """Sorted phrases of a hash range: repeated ones get ranks 1, 2, ..."""
        bucket = key[0].as_py()
        numbers, n, (h, more) = gathered(requests.drop_columns(["round"]))
        order, group, firsts, size = _distinct(h)
        repeated = (size > 1) | (np.maximum.reduceat(more[order], firsts) > 0 if len(firsts) else size > 1)
        rank = np.where(repeated, np.cumsum(repeated) + np.uint64(bucket << 40), 0).astype(np.uint64)
        out = np.empty(len(h), dtype=np.uint64)
        out[order] = rank[group]
        return _tagged(replies_table(bucket, numbers, n, [out]), PHRASES)

    def paired(docs: Rows, replies: pa.Table) -> tuple[_Runs, list[_Pairs]]:
        rows = _Runs(docs.texts, least, _of_round(replies, RUNS)["payload"][0].as_py())
        return rows, _pairs(rows, _ranked(rows, replies), lengths)

    def singled(docs: Rows, replies: pa.Table) -> tuple[_Runs, list[_Pairs], list[np.ndarray], list[_Single]]:
        rows, pairs = paired(docs, replies)
        flags = [replied(_of_round(replies, PAIRS + k), 1)[0] for k in range(len(lengths))]
        return rows, pairs, flags, _singles(rows, pairs, flags)

    def ask_pairs(block: int, docs: Rows, replies: pa.Table) -> pa.Table:
        _, pairs = paired(docs, replies)
        asked = [requests_table(block, p.keys[0], [*p.keys[1:], (p.size > 1).astype(np.uint8)], bits) for p in pairs]
        return pa.concat_tables([_tagged(t, PAIRS + k) for k, t in enumerate(asked)])

    def judge_pairs(key: tuple[pa.Scalar, ...], requests: pa.Table) -> pa.Table:
        """0: unique; 1: every window of the run repeats; 2: compare its
        windows; 3: repeats, and stands for its kind in that comparison."""
        numbers, n, (pair, core, whole, again, more) = gathered(requests.drop_columns(["round"]))
        order, group, firsts, size = _distinct(pair, core, whole, again)
        many = (size > 1) | (np.maximum.reduceat(more[order], firsts) > 0 if len(firsts) else size > 1)
        a, b = pair[order][firsts], core[order][firsts]
        edge = np.ones(len(firsts), dtype=bool)
        edge[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        kind = np.cumsum(edge) - 1
        open_ = np.bincount(kind, weights=~many) if len(kind) else np.zeros(0)
        alone = np.bincount(kind) == 1 if len(kind) else open_
        flag = np.where(many, 1, 2 * ~alone[kind]) if len(kind) else np.zeros(0, dtype=np.int64)
        out = np.empty(len(pair), dtype=np.uint8)
        out[order] = flag[group]
        stands = many & (open_[kind] > 0) if len(kind) else many
        out[order[firsts[stands]]] = 3
        return _tagged(replies_table(key[1].as_py(), numbers, n, [out]), key[0].as_py())

    def ask_windows(block: int, docs: Rows, replies: pa.Table) -> pa.Table:
        *_, singles = singled(docs, replies)
        asked = []
        for x in singles:
            first = x.order[x.firsts]
            asked.append(requests_table(block, x.h[first], [x.check[first], (x.size > 1).astype(np.uint8)], bits))
        return pa.concat_tables([_tagged(t, WINDOWS + k) for k, t in enumerate(asked)])

    def judge_windows(key: tuple[pa.Scalar, ...], requests: pa.Table) -> pa.Table:
        numbers, n, (h, check, more) = gathered(requests.drop_columns(["round"]))
        order, group, firsts, size = _distinct(h, check)
        many = (size > 1) | (np.maximum.reduceat(more[order], firsts) > 0 if len(firsts) else size > 1)
        out = np.empty(len(h), dtype=np.uint8)
        out[order] = many[group]
        return _tagged(replies_table(key[1].as_py(), numbers, n, [out]), key[0].as_py())

    def removed(block: int, docs: Rows, replies: pa.Table) -> pa.Table:
        rows, pairs, flags, singles = singled(docs, replies)
        spans = []
        for k, (p, flag, x) in enumerate(zip(pairs, flags, singles, strict=True)):
            (again,) = replied(_of_round(replies, WINDOWS + k), 1)
            single = np.zeros(len(x.place), dtype=bool)
            single[x.order] = again[x.group] > 0
            run = p.i[p.order[(flag[p.group] == 1) | (flag[p.group] == 3)]]
            begin = np.concatenate([rows.first[run], x.place[single & ~x.resolved]])
            stop = np.concatenate([p.last[run], x.place[single & ~x.resolved]]) + p.length
            spans.append(_union(begin, stop))
        report = _report(docs.ids, docs.texts, rows, spans[0], id_arrow, with_bytes)
        if shorter is not None:
            report = report.add_column(5, "n_repeated", pa.array(_covered(len(docs.texts), rows, *spans[1]), pa.int64()))
        return report

    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(documents.schema["doc_id"].dataType)
    asked = stored(each_block(blocks, ask_phrases, REQUESTS), "phrases")
    runs = asked.where(f"round = {RUNS}").select("round", "block", "bucket", "payload")
    known = runs.unionByName(stored(asked.where(f"round = {PHRASES}").groupBy("bucket").applyInArrow(rank_phrases, REPLIES), "phrase-ranks"))
    known = known.unionByName(stored(_answered(blocks, ask_pairs, judge_pairs, known), "pair-verdicts"))
    known = known.unionByName(stored(_answered(blocks, ask_windows, judge_windows, known), "window-verdicts"))
    schema = f"doc_id {blocks.id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", n_repeated long" * (shorter is not None) + ", kept binary" * with_bytes
    return each_block(blocks, removed, schema, known)


def _answered(blocks: Blocks, ask, judge, known: DataFrame) -> DataFrame:
    return each_block(blocks, ask, REQUESTS, known).groupBy("round", "bucket").applyInArrow(judge, REPLIES)


def _union(begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by the spans."""
    if not len(begin):
        return begin, stop
    order = np.argsort(begin, kind="stable")
    begin, stop = begin[order], np.maximum.accumulate(stop[order])
    new = np.ones(len(begin), dtype=bool)
    new[1:] = begin[1:] > stop[:-1]
    firsts = np.nonzero(new)[0]
    return begin[firsts], stop[np.append(firsts[1:], len(begin)) - 1]


def _covered(n: int, rows: _Runs, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Bytes of each of n texts that the spans cover."""
    out = np.zeros(n, dtype=np.int64)
    owner = np.searchsorted(rows.starts, begin, side="right") - 1
    np.add.at(out, np.array(rows.long, dtype=np.int64)[owner], stop - begin)
    return out


def _report(ids: list, texts: list[bytes], rows: _Runs, spans, id_arrow: pa.DataType, with_bytes: bool) -> pa.Table:
    begin, stop = spans
    owner = np.searchsorted(rows.starts, begin, side="right") - 1
    cut = np.searchsorted(owner, np.arange(len(rows.long) + 1))
    place = {i: j for j, i in enumerate(rows.long)}
    out = []
    for i, text in enumerate(texts):
        j = place.get(i)
        mine = range(cut[j], cut[j + 1]) if j is not None else ()
        if mine:
            kept, at, base = [], 0, int(rows.starts[j])
            for m in mine:
                kept.append(text[at : int(begin[m]) - base])
                at = int(stop[m]) - base
            rest = b"".join([*kept, text[at:]])
        else:
            rest = text
        out.append((len(text), len(text) - len(rest), len(mine), hashlib.sha256(rest).hexdigest(), rest if with_bytes else None))
    n, gone, count, digest, rest = zip(*out, strict=True) if out else ([],) * 5
    table = {"doc_id": pa.array(ids, id_arrow), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "n_spans": pa.array(count, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
    if with_bytes:
        table["kept"] = pa.array(rest, pa.binary())
    return pa.table(table)
