"""N-gram Jaccard join: a size-aware heavy-light join over shingle sets.

Documents with one and the same set are a class with one representative. Two
sets A, B with J(A, B) >= s share at least s * max(|A|, |B|) shingles, so

* small (light) sets list all their subsets of the sizes that an intersection can
  have; a linked pair of light sets lists its intersection twice;
* large (heavy) sets are found in the inverted lists of shingles. A set of n lacks
  at most n - s * n of a linked set's shingles, so that two linked sets agree in one
  of the n - s * n + 1 rarest of either; only those enter the lists, and of those
  only such as other sets have. Rare means in few sets of the whole table; what
  many texts share (passages, boilerplate) comes last, and unrelated texts that
  share it do not meet. The sizes that a light set can be linked to enter both.

The boundary is where listing subsets costs more than scanning the measured lists:
both costs are summed over the whole table for each size.

Lists are scanned for exact overlaps in three steps. Each member is compared with
the smallest of its list, one pair per entry; linked ones are contracted. Lists
whose other members are then still in several components are scanned themselves,
sets of equal lists once; one larger than a tile is dealt out in tiles of bounded
bytes. Every linked pair shares a list, so no link between components is lost, and
lists are not joined to larger clusters before they are verified. Links then give
components. A list of very many texts that are all similar but not linked costs the
square of its size in counting, and beyond a tile also in tiles.

Shingles are three consecutive words, A-Z lower-cased; a text of one or two
words is one shingle; a null or empty text has none and is linked with nothing.
Repeated rows are copies; a null doc_id is the smallest; an empty table gives no
rows; other columns are ignored."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stationflow.llm.blocks import REPLY, REQUEST, Blocks, Rows, bucket_bits, each_block, gathered, pack, replied, replies_table, requests_table, text_blocks, unpack
from stationflow.llm.components import connected_components
from stationflow.llm.shared import fresh, stored
from stationflow.llm.text import mixed, sequence_hashes, word_hashes

SHINGLE_WORDS = 3
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 90
TILE_BYTES = 8 << 20
#: Bytes of text in a block: sets and keys take several times their text.
BLOCK_BYTES = 6 << 20


class Scheme:
    """Sizes, subsets and prefixes for a threshold in hundredths. Sets of fewer
    than ``light`` shingles are light."""

    def __init__(self, percent: int = PERCENT, light: int = 1) -> None:
        self.percent, self.light = percent, light

    def spare(self, n: int) -> int:
        """Shingles of a set of n that a linked set may lack."""
        return n - -(-n * self.percent // 100)

    def subsets(self, n: int) -> int:
        total = term = 1
        for i in range(1, self.spare(n) + 1):
            term = term * (n - i + 1) // i
            total += term
        return total

    def lists_subsets(self, n: int) -> bool:
        return n < self.light

    def enters_lists(self, n: int) -> bool:
        """Heavy sets, and the light ones that a heavy set can be linked to."""
        return n * 100 >= self.light * self.percent


#: Sizes from which on all sets are heavy, whatever the lists' lengths.
MOST_LIGHT = 24
#: Subsets that one set may list.
MOST_SUBSETS = 4096


def boundary(scans: dict[int, tuple[int, int]], percent: int) -> int:
    """The size below which sets are light: of all boundaries that of the least
    cost, for ``scans[n]`` = (number of sets of size n, entries of the lists that
    they would have scanned)."""
    scheme = Scheme(percent)
    cost = {}
    for light in range(1, MOST_LIGHT + 1):
        if scheme.subsets(light - 1) > MOST_SUBSETS:
            break
        listed = sum(count * scheme.subsets(n) for n, (count, _) in scans.items() if n < light)
        scanned = sum(entries for n, (_, entries) in scans.items() if n * 100 >= light * percent)
        cost[light] = listed + scanned
    return min(cost, key=lambda light: (cost[light], light))


def shingle_sets(texts: list[bytes], n: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, owner = word_hashes(texts, lower=True)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    runs = sequence_hashes(words, n)
    out = []
    for lo, hi in zip(ends[:-1], ends[1:], strict=True):
        if hi - lo >= n:
            out.append(np.unique(runs[lo : hi - n + 1]))
        else:
            out.append(sequence_hashes(words[lo:hi], int(hi - lo)) if hi > lo else words[:0])
    return out


def subset_keys(s: np.ndarray, scheme: Scheme) -> np.ndarray:
    """Keys of the subsets that an intersection with a linked set can be."""
    m = mixed(s)
    with np.errstate(over="ignore"):
        total = m.sum(dtype=np.uint64)
        gone = [np.zeros(1, dtype=np.uint64)]
        for size in range(1, scheme.spare(len(s)) + 1):
            at = np.fromiter((i for c in combinations(range(len(s)), size) for i in c), dtype=np.int64).reshape(-1, size)
            gone.append(m[at].sum(axis=1, dtype=np.uint64))
        return mixed(total - np.concatenate(gone))


def prefix(s: np.ndarray, sets_with: np.ndarray, scheme: Scheme) -> np.ndarray:
    """Places of the set's rarest shingles, one more than a linked set may lack.
    ``sets_with``: in how many sets each is (up to 255); equals in order of hash."""
    order = (sets_with.astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
    n = scheme.spare(len(s)) + 1
    return np.argpartition(order, n - 1)[:n] if n < len(s) else np.arange(len(s))


def overlaps(sets: list[np.ndarray], one: np.ndarray, other: np.ndarray, percent: int, label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between the sets numbered in ``one`` and those in ``other``, found
    by scanning the inverted lists of each set's shingles; only links that join
    two components so far (``label``) are returned."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(ids, kind="stable")
    start = np.searchsorted(ids[order], np.arange(ids.max() + 2))
    first = np.concatenate([[0], np.cumsum(sizes)])
    listed = owner[order]
    label = np.arange(len(sets)) if label is None else np.unique(label, return_inverse=True)[1]
    allowed = np.zeros(len(sets), dtype=bool)
    allowed[other] = True
    links = []
    for a in one:
        own = ids[first[a] : first[a + 1]]
        lens = start[own + 1] - start[own]
        at = np.repeat(start[own] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
        both = np.bincount(listed[at], minlength=len(sets))
        linked = allowed & (100 * both >= percent * (sizes[a] + sizes - both)) & (label != label[a])
        for b in np.nonzero(linked)[0]:
            if label[b] != label[a]:
                links.append((int(a), int(b)))
                label[label == label[b]] = label[a]
    return links


OWN = -1  # bucket number of a block's own rows
#: Bits of a shingle's hash that are sent to count the sets it is in.
COUNTED_BITS = 40


def join_rows(documents: DataFrame, *, percent: int = PERCENT, words: int = SHINGLE_WORDS, tile_bytes: int = TILE_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``k, doc_id, t, n_shingles, component_id, first`` per row: k numbers the
    rows, t is the text's xxhash64, ``first`` tells the one row of a component
    that has its smallest doc_id (rows of equal id: the first)."""
    blocks = text_blocks(documents, block_bytes=block_bytes)
    scheme = Scheme(percent)

    def cards(block: int, docs: Rows, _: pa.Table | None) -> pa.Table:
        ks, ids, texts = docs.k, docs.ids, docs.texts
        sets = shingle_sets(texts, words)
        with np.errstate(over="ignore"):
            sums = [[int(mixed(s + np.uint64(c)).sum(dtype=np.uint64).view(np.int64)) for s in sets] for c in (1, 2)]
        return pa.table({"k": pa.array(ks, pa.int64()), "doc_id": pa.array(ids, id_arrow), "t": pa.array(docs.t, pa.int64()), "n": pa.array([len(s) for s in sets], pa.int64()), "d1": pa.array(sums[0], pa.int64()), "d2": pa.array(sums[1], pa.int64())})

    id_arrow = to_arrow_type(documents.schema["doc_id"].dataType)
    card = stored(each_block(blocks, cards, f"k long, doc_id {blocks.id_type}, t long, n long, d1 long, d2 long"), "set-cards")
    classes = stored(card.where("n > 0").groupBy("n", "d1", "d2").agg(F.min(F.struct("doc_id", "k")).alias("least")), "set-classes")
    leaders = classes.selectExpr("cast(shiftright(least.k, 33) as int) as block", "least.k as k", "least.doc_id as doc_id", "n")
    bits = bucket_bits(blocks.text_bytes // 6)
    shift = np.uint64(64 - COUNTED_BITS)

    def own_sets(docs: Rows, wanted: set[int]) -> tuple[list[int], list[np.ndarray]]:
        own = [i for i, k in enumerate(docs.k) if k in wanted]
        return [docs.k[i] for i in own], shingle_sets([docs.texts[i] for i in own], words)

    def counted_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys, their numbers, and the key of each shingle."""
        keys, at, n = np.unique(np.concatenate([*sets, np.zeros(0, dtype=np.uint64)]) >> shift << shift, return_inverse=True, return_counts=True)
        return keys, n, at

    def ask(block: int, docs: Rows, wanted: pa.Table) -> pa.Table:
        """Shingles of the block's representatives, with the number of sets."""
        ks, sets = own_sets(docs, set(wanted["k"].to_pylist()))
        keys, n, _ = counted_keys(sets)
        own = pa.table({"bucket": pa.array([OWN], pa.int32()), "block": pa.array([block], pa.int32()), "n": pa.array([0], pa.int32()), "payload": pa.array([pack(np.array(ks, dtype=np.int64))], pa.binary())})
        return pa.concat_tables([requests_table(block, keys, [np.minimum(n, 255).astype(np.uint8)], bits), own])

    def count(key: tuple[pa.Scalar, ...], requests: pa.Table) -> pa.Table:
        numbers, n, (h, sets_with) = gathered(requests)
        _, at = np.unique(h, return_inverse=True)
        total = np.minimum(np.bincount(at, weights=sets_with), 255).astype(np.uint8)
        return replies_table(key[0].as_py(), numbers, n, [total[at]])

    asked = stored(each_block(blocks, ask, REQUEST, leaders.select("block", "k")), "shingle-requests")
    replies = asked.where("bucket >= 0").groupBy("bucket").applyInArrow(count, REPLY)
    known = stored(replies.unionByName(asked.where(f"bucket = {OWN}").select("block", "bucket", "payload")), "shingle-counts")

    def rarest(block: int, docs: Rows, replies: pa.Table):
        """Number and set of each representative with the places of its rarest
        shingles that other sets have, and those places' counts."""
        own = pc.equal(replies["bucket"], OWN)
        (ks,) = unpack(replies.filter(own)["payload"][0].as_py())
        _, sets = own_sets(docs, set(ks.tolist()))
        (total,) = replied(replies.filter(pc.invert(own)), 1)
        counts = total[counted_keys(sets)[2]] if len(ks) else total
        ends = np.cumsum([0, *(len(s) for s in sets)])
        for k, s, lo, hi in zip(ks.tolist(), sets, ends[:-1], ends[1:], strict=True):
            at = prefix(s, counts[lo:hi], scheme)
            yield k, s, at[counts[lo:hi][at] > 1], counts[lo:hi]

    def measure(block: int, docs: Rows, replies: pa.Table) -> pa.Table:
        found = [(len(s), 1, int(counts[at].sum(dtype=np.int64))) for _, s, at, counts in rarest(block, docs, replies)]
        size = np.array(found, dtype=np.int64).reshape(-1, 3)
        small = size[size[:, 0] <= MOST_LIGHT]
        sums = [np.bincount(small[:, 0], weights=small[:, c], minlength=MOST_LIGHT + 1).astype(np.int64) for c in (1, 2)]
        return pa.table({"n": pa.array(np.arange(MOST_LIGHT + 1), pa.int64()), "sets": pa.array(sums[0]), "entries": pa.array(sums[1])})

    def enter(block: int, docs: Rows, replies: pa.Table) -> pa.Table:
        """The block's entries in the lists: those of subsets and of shingles."""
        keys, members, sizes = [np.zeros(0, dtype=np.uint64)], [], []
        for k, s, at, _ in rarest(block, docs, replies):
            mine = [subset_keys(s, bounded)] if bounded.lists_subsets(len(s)) else []
            if bounded.enters_lists(len(s)):
                mine.append(mixed(s[at]))
            total = sum(map(len, mine))
            keys += mine
            members.append(np.full(total, k))
            sizes.append(np.full(total, len(s)))
        none = np.zeros(0, dtype=np.int64)
        return pa.table({"key": pa.array(np.concatenate(keys).view(np.int64)), "k": pa.array(np.concatenate([none, *members])), "n": pa.array(np.concatenate([none, *sizes]))})

    measured = each_block(blocks, measure, "n long, sets long, entries long", known).groupBy("n").agg(F.sum("sets"), F.sum("entries")).collect()
    bounded = Scheme(percent, boundary({n: (sets, entries) for n, sets, entries in measured}, percent))
    entries = stored(each_block(blocks, enter, "key long, k long, n long", known), "list-entries")
    hubs = entries.groupBy("key").agg(F.min(F.struct("k", "n")).alias("hub"), F.count("*").alias("length")).where("length > 1")
    lists = stored(entries.join(hubs.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key")).selectExpr("key", "k", "n", "hub.k as hub", "hub.n as hub_n"), "lists")
    near = f"100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)"
    stars = stored(lists.where("k <> hub").where(near).select("k", "hub").distinct(), "list-stars")
    place = leaders.select("k", "block", "n")
    first = stored(_star_links(blocks, place, stars, percent, words, tile_bytes), "star-links")
    rest = _list_links(blocks, place, lists, connected_components(first), percent, words, tile_bytes)
    links = first.unionByName(rest)
    roots = connected_components(links)
    smallest = roots.join(leaders, F.col("node") == F.col("k")).groupBy("root").agg(F.min(F.struct("doc_id", "k")).alias("top"))
    named = roots.join(smallest, "root").selectExpr("node", "top")
    of_class = classes.join(named, F.col("least.k") == F.col("node"), "left").selectExpr(
        "n as _n", "d1 as _d1", "d2 as _d2", "coalesce(top, least) as top"
    )
    return card.join(of_class, F.expr("n = _n and d1 = _d1 and d2 = _d2"), "left").selectExpr(
        "k", "doc_id", "t", "n as n_shingles", "if(n = 0, doc_id, top.doc_id) as component_id", "n = 0 or top.k = k as first"
    )


def _sets(blocks: Blocks, wanted: DataFrame, words: int) -> DataFrame:
    """``k, s``: the sets (packed hashes) of the rows ``block, k``."""

    def sets_of(block: int, docs: Rows, rows: pa.Table) -> pa.Table:
        mine = set(rows["k"].to_pylist())
        own = [i for i, k in enumerate(docs.k) if k in mine]
        sets = shingle_sets([docs.texts[i] for i in own], words)
        return pa.table({"k": pa.array([docs.k[i] for i in own], pa.int64()), "s": pa.array([s.tobytes() for s in sets], pa.binary())})

    return each_block(blocks, sets_of, "k long, s binary", wanted)


def _hashes(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py(), dtype=np.uint64)


def _groups(rows: DataFrame) -> int:
    """Tasks' worth of groups for rows ``n`` of sets that are sent."""
    sent = rows.agg(F.sum(F.col("n") * 8 + 64)).first()[0] or 0
    return max(1, -(-int(sent) // (16 << 20)))


def _star_links(blocks: Blocks, place: DataFrame, stars: DataFrame, percent: int, words: int, tile_bytes: int) -> DataFrame:
    """Links ``a, b`` among the pairs ``k, hub``. A hub's set is sent once for
    each tile of its members."""
    spread = max(1, tile_bytes // 8)
    held = stars.join(place, "k").groupBy("hub").agg(F.sum("n").alias("held"))
    members = stars.join(held, "hub").selectExpr("hub", f"cast(pmod(xxhash64(k), held div {spread} + 1) as int) as tile", "k")
    sent = stored(members.unionByName(members.selectExpr("hub", "tile", "hub as k").distinct()).join(place, "k"), "star-members")
    groups = _groups(sent)
    dealt = sent.join(_sets(blocks, sent.select("block", "k").distinct(), words), "k")
    keyed = dealt.selectExpr("hub", "tile", "k", "s", f"cast(pmod(xxhash64(hub, tile), {groups}) as int) as g")

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hub, tile, k = (table[c].to_numpy() for c in ("hub", "tile", "k"))
        order = np.lexsort((k != hub, tile, hub))  # a hub before its members
        a, b = [], []
        for i in order.tolist():
            if k[i] == hub[i]:
                core = _hashes(table["s"][i])
                continue
            own = _hashes(table["s"][i])
            at = np.minimum(np.searchsorted(core, own), len(core) - 1)
            both = int((core[at] == own).sum())
            if 100 * both >= percent * (len(core) + len(own) - both):
                a.append(k[i])
                b.append(hub[i])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return keyed.groupBy("g").applyInArrow(compare, "a long, b long")


def _list_links(blocks: Blocks, place: DataFrame, lists: DataFrame, components: DataFrame, percent: int, words: int, tile_bytes: int) -> DataFrame:
    """Links ``a, b`` between components (a spanning set) that members of a list
    have beside those to its hub."""
    labelled = lists.join(components, F.col("k") == F.col("node"), "left").selectExpr("key", "k", "n", "hub", "coalesce(root, k) as root")
    labelled = stored(labelled, "labelled-lists")
    others = F.when(F.col("k") != F.col("hub"), F.col("root"))
    mark = [F.sum(F.xxhash64("k", F.lit(s)).cast("decimal(38,0)")).alias(f"mark{s}") for s in (1, 2)]
    lists_open = labelled.groupBy("key").agg(F.min(others).alias("low"), F.max(others).alias("high"), F.count("*").alias("length"), F.sum(F.col("n") * 8 + 64).alias("bytes"), *mark)
    # Of lists with the same members one is scanned.
    scanned = lists_open.where("low <> high").groupBy("length", "mark1", "mark2", "bytes").agg(F.min("key").alias("_key"))
    chunks = f"cast(ceil(bytes / {tile_bytes}) as int) as chunks"
    sized = stored(labelled.join(scanned.selectExpr("_key", chunks), F.col("key") == F.col("_key")).selectExpr("key as list", "k", "n", "root", "chunks").join(place.select("k", "block"), "k"), "open-lists")
    tiles = sized.selectExpr("*", "cast(pmod(xxhash64(k), chunks) as int) as c").selectExpr(
        "k", "n", "list", "root", "c", "explode(transform(sequence(0, chunks - 1), j -> struct(least(c, j) as i, greatest(c, j) as j))) as tile"
    )
    groups = _groups(tiles)
    sets = _sets(blocks, sized.select("block", "k").distinct(), words)
    dealt = tiles.join(sets, "k").selectExpr("list", "tile.i as i", "tile.j as j", "c", "k", "root", "s", f"cast(pmod(xxhash64(list, tile), {groups}) as int) as g")

    def scan(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.select(["list", "i", "j", "c", "k", "root"]).to_pylist()
        tiles: dict[tuple, list[int]] = {}
        for at, r in enumerate(rows):
            tiles.setdefault((r["list"], r["i"], r["j"]), []).append(at)
        a, b = [], []
        for (_, i, j), at in tiles.items():
            at.sort(key=lambda x: rows[x]["k"])
            sets = [_hashes(table["s"][x]) for x in at]
            chunk, root = (np.array([rows[x][c] for x in at]) for c in ("c", "root"))
            for x, y in overlaps(sets, np.nonzero(chunk == i)[0], np.nonzero(chunk == j)[0], percent, root):
                a.append(rows[at[x]]["k"])
                b.append(rows[at[y]]["k"])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("g").applyInArrow(scan, "a long, b long")


def jaccard_components(documents: DataFrame, **options) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row."""
    return join_rows(documents, **options).select("doc_id", "n_shingles", "component_id")


def drop_near_copies(documents: DataFrame, **options) -> DataFrame:
    """One document of each component, the one of smallest doc_id, unchanged."""
    rows = stored(join_rows(documents, **options).select("doc_id", "t", "first"), "component-rows")
    kept = rows.where("first").selectExpr("doc_id as _d", "t as _t").distinct()
    mark = fresh(documents, "_mark")
    marked = documents.withColumn(mark, F.xxhash64("text"))
    out = marked.join(kept, marked["doc_id"].eqNullSafe(kept["_d"]) & (marked[mark] == kept["_t"]), "left_semi")
    if rows.where("first").count() < rows.join(kept, F.expr("doc_id <=> _d and t = _t"), "left_semi").count():
        out = out.dropDuplicates(["doc_id", mark])  # rows of equal id and text
    return out.drop(mark)
