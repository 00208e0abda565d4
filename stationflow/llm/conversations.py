"""Repair of conversation structure by iterative-deepening A*.

A conversation's rows, in order of turn, are edited at least cost (keep, rerole,
delete, insert) so that its role initials read ``(s?(ua)+)?``. The search goes
through the rows depth first, tries edits in ASCII order of their initials
(``D I K R``) and stays under a cost bound, which rises to the least cost that
exceeded it; a table holds for each state (row, what the roles read so far) the
largest rest of the bound that failed there. So the first accepting path is the
cheapest, and among those the ASCII-least. The estimate of the cost to come counts
edits that no path can avoid: blank and repeated rows, rows of other roles,
truncated ones, and neighbours of one role.

Conversations are laid out by range of (conversation, turn, role, text), so that a
long one spreads over tasks. One that lies whole within a task and has at most
``CHUNK`` rows is repaired there. Of others each chunk of rows is searched once for
each pair of states before and after it, which leaves a few numbers: the costs, and
the order of the cheapest paths from one state. (Of two paths through the same rows
neither begins with the other unless they are equal, so the first chunk in which
they differ decides.) These numbers are combined by partition, by groups of
partitions and by conversation; the states that were chosen go back down and each
chunk gives its part of the answer. Equal rows are counted before they are
shuffled, so a row that is repeated in a third of the table is one row. What remains
in one task is the hash of a repaired conversation, which is sequential by
definition: it reads the chunks in order and holds one at a time.

Rows of one turn are in order of role, then text (code points); null turns come
first, in the same order.

Defined cases: a null conv_id is a conversation of its own, a null role or text is
one space; an empty role has no initial that can be kept; repeated rows are rows; a
conversation of which all rows were dropped has zeros, an empty audit and the empty
string's hash; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType

from stationflow.llm.shared import stored

#: Costs of the edits (fixed values).
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows searched at a time.
CHUNK = 16
#: What the roles so far read: nothing, ``s``, ``..u`` or ``..a``.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_INITIAL = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
#: The state that a user's or assistant's row leads to.
_TURN = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: The last initial read, as far as it matters to the next one, and the initial
#: that follows an end (None: a conversation's).
_READ = {NOTHING: "a", SYSTEM: "a", USER: "u", ASSISTANT: "a"}
_THEN = {None: "u", NOTHING: "-", SYSTEM: "-", USER: "a", ASSISTANT: "u"}
#: Inserts that end a conversation, from each state.
_END = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"
_INFINITE = 1 << 40


class Row:
    """A row after damage: its role, text and first fault."""

    __slots__ = ("again", "blank", "role", "text", "truncated")

    def __init__(self, role: str, text: str, again: bool) -> None:
        self.role, self.text = role, text
        words = text.strip(SPACE)
        self.blank = not words
        self.again = again and not self.blank
        self.truncated = not self.blank and not again and words[-1] not in ".!?"

    @property
    def gone(self) -> bool:
        return self.blank or self.again

    @property
    def initial(self) -> str:
        return self.role[:1] or " "


class Search:
    """Cheapest edits of some rows."""

    def __init__(self, rows: list[Row]) -> None:
        self.rows, self.n = rows, len(rows)
        # From each row on: costs that no edits avoid; neighbours of one role,
        # among rows that need not go; the initials of the first and last of these.
        self.forced, self.pairs, self.head = [0] * (self.n + 1), [0] * (self.n + 1), [""] * (self.n + 1)
        self.tail = ""
        for i in range(self.n - 1, -1, -1):
            r = rows[i]
            cost, pair, head = DELETE, 0, self.head[i + 1]
            if not r.gone:
                cost = TRUNCATED * r.truncated + REROLE * (r.initial not in "sua")
                pair = r.initial in "ua" and r.initial == head
                head = r.initial
                self.tail = self.tail or head
            self.forced[i], self.pairs[i], self.head[i] = self.forced[i + 1] + cost, self.pairs[i + 1] + pair, head

    def estimate(self, i: int, state: int, end: int | None) -> int:
        """No more than the edits from row i on cost. Beside the forced costs,
        every edit costs two at least and mends at most two illegal pairs; what is
        behind and what must follow the rows count as neighbours. To read nothing
        (more), all rows go, but for one that may be kept as ``s``."""
        if end in (NOTHING, SYSTEM):
            kept = state != end
            return DELETE * (self.n - i - kept) if state in (NOTHING, end) and i + kept <= self.n else _INFINITE
        read, then = _READ[state], _THEN[end]
        head = self.head[i]
        pairs = self.pairs[i] + (read == (head or then)) + (head != "" and self.tail == then)
        return self.forced[i] + 2 * ((pairs + 1) // 2)

    def steps(self, i: int, state: int, closing: bool) -> Iterator[tuple[str, int, int, int]]:
        """(initial, cost, next row, next state) of the edits, in ASCII order."""
        turn = _TURN[state]
        if i == self.n:
            if closing:
                yield "I", INSERT, i, turn
            return
        r = self.rows[i]
        yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, turn
        if not r.gone:
            more = TRUNCATED * r.truncated
            if r.initial == _INITIAL[turn]:
                yield "K", more, i + 1, turn
            elif state == NOTHING and r.initial == "s":
                yield "K", more, i + 1, SYSTEM
            if r.role != ("user" if turn == USER else "assistant"):
                yield "R", REROLE + more, i + 1, turn

    def reachable(self, state: int, end: int) -> bool:
        """Whether some edits lead through all rows (there is one) to ``end``."""
        if end == NOTHING:
            return state == NOTHING
        if end == SYSTEM:
            return state == SYSTEM or state == NOTHING and any(r.initial == "s" and not r.gone for r in self.rows)
        return True

    def best(self, state: int = NOTHING, end: int | None = None) -> tuple[int, str]:
        """Cost and initials of the cheapest edits from ``state`` to ``end``
        (None: to the end of a conversation)."""
        accepting = {NOTHING, ASSISTANT} if end is None else {end}
        closing, bound = end is None, self.estimate(0, state, end)
        while True:
            failed: dict[tuple[int, int], int] = {}
            beyond = _INFINITE
            path: list[str] = []
            # A frame: row, state, rest of the bound, steps not yet tried.
            stack = [(0, state, bound, self.steps(0, state, closing))]
            while stack:
                i, now, rest, steps = stack[-1]
                if i == self.n and now in accepting:
                    return bound - rest, "".join(path)
                for edit, cost, j, then in steps:
                    left = rest - cost
                    short = self.estimate(j, then, end) - left
                    if short > 0:
                        beyond = min(beyond, bound + short)  # the least cost that exceeds the bound
                    elif failed.get((j, then), -1) < left:
                        path.append(edit)
                        stack.append((j, then, left, self.steps(j, then, closing)))
                        break
                else:
                    failed[i, now] = max(failed.get((i, now), -1), rest)
                    stack.pop()
                    if path:
                        path.pop()
            bound = beyond

    def repaired(self, audit: str, state: int = NOTHING) -> list[str]:
        """``role:text`` of the rows that edits leave or make."""
        out, i = [], 0
        for edit in audit:
            role = "user" if _TURN[state] == USER else "assistant"
            if edit == "I":
                out.append(f"{role}:")
                state = _TURN[state]
                continue
            r = self.rows[i]
            i += 1
            if edit == "D":
                continue
            if edit == "K" and state == NOTHING and r.initial == "s":
                state = SYSTEM
            else:
                state = _TURN[state]
            out.append(f"{r.role if edit == 'K' else role}:{r.text}")
        return out


def summary(rows: list[Row]) -> tuple[list[int], list[int]]:
    """Costs and, among the paths from one state, ranks of the cheapest paths
    through the rows, for each (state before, state after) in order."""
    search = Search(rows)
    cost, rank = [_INFINITE] * 16, [0] * 16
    for a in range(4):
        paths = {}
        for b in range(4):
            if search.reachable(a, b):
                cost[4 * a + b], paths[b] = search.best(a, b)
        for k, b in enumerate(sorted(paths, key=paths.__getitem__)):
            rank[4 * a + b] = k
    return cost, rank


def route(parts: list[tuple[list[int], list[int]]], state: int, end: int | None) -> tuple[int, list[int]]:
    """Least cost and states after each of the parts, from ``state`` to ``end``
    (None: to the end of a conversation), by costs, then ranks."""
    rest = [[INSERT * _END[q] for q in range(4)] if end is None else [0 if q == end else _INFINITE for q in range(4)]]
    for cost, _ in reversed(parts):
        rest.append([min(_INFINITE, *(cost[4 * a + b] + rest[-1][b] for b in range(4))) for a in range(4)])
    rest.reverse()
    total, states = rest[0][state], []
    if total >= _INFINITE:
        return _INFINITE, []
    for (cost, rank), after, before in zip(parts, rest[1:], rest, strict=False):
        state = min((b for b in range(4) if cost[4 * state + b] + after[b] == before[state]), key=lambda b: rank[4 * state + b])  # noqa: B023
        states.append(state)
    return total, states


def combined(parts: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int]]:
    """The summary of parts that follow each other."""
    cost, rank = [_INFINITE] * 16, [0] * 16
    for a in range(4):
        ways = {}
        for b in range(4):
            cost[4 * a + b], states = route(parts, a, b)
            if states:
                before = [a, *states]
                ways[b] = [r[4 * x + y] for (_, r), x, y in zip(parts, before, before[1:], strict=False)]
        for k, b in enumerate(sorted(ways, key=ways.__getitem__)):
            rank[4 * a + b] = k
    return cost, rank


# --- damage -------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows after damage, equal ones as
    one with their number; a conversation also has a row of no copies if rows of
    it were dropped."""
    key = "concat(coalesce(cast(conv_id as string), ' '), ':', coalesce(cast(turn as string), ' '))"
    rows = conversations.selectExpr("conv_id", "turn", "coalesce(role, ' ') as role", "coalesce(text, ' ') as text", f"crc32(encode({key}, 'UTF-8')) % 20 as h")
    hit = rows.selectExpr(
        "conv_id",
        "if(h = 0, null, turn) as turn",
        "case when h = 0 then null when h = 4 then 'user' else role end as role",
        "case when h = 0 then null when h = 1 then '' when h = 2 then regexp_replace(text, '[.!?]', '') else text end as text",
        "case when h = 0 then 0 when h = 3 then 2 else 1 end as copies",
    )
    return hit.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


def with_repeats(rows: DataFrame) -> DataFrame:
    """A column ``again``: role and text were seen at an earlier turn."""
    said = ["xxhash64(role, text) as x", "xxhash64(text, role, 1) as y"]
    keyed = rows.selectExpr("*", *said)
    order = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    seen = keyed.where("copies > 0").groupBy(F.col("conv_id").alias("_c"), F.col("x").alias("_x"), F.col("y").alias("_y")).agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    on = F.expr("conv_id <=> _c and x = _x and y = _y")
    return keyed.join(seen, on, "left").selectExpr(*rows.columns, "_x is not null and not (first.turn <=> turn) as again")


# --- operator -----------------------------------------------------------------

_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_EDGE = "conv_id {0}, kind int, part int, seq int"
_RESULT = ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
#: What a chunk tells about itself: rows, distinct turns, first and last turn,
#: faults, illegal neighbours, outer initials, costs and ranks.
_FACTS = "n long, turns long, low long, high long, blank long, duplicate long, truncated long, illegal long, head string, tail string, cost array<long>, rank array<int>"


def _facts(rows: list[Row], turns: list[int | None]) -> dict:
    known = [t for t in turns if t is not None]
    initials = [r.initial for r in rows]
    return {
        "n": len(rows),
        "turns": len(set(known)),
        "low": min(known, default=None),
        "high": max(known, default=None),
        "blank": sum(r.blank for r in rows),
        "duplicate": sum(r.again for r in rows),
        "truncated": sum(r.truncated for r in rows),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "head": initials[0] if rows else None,
        "tail": initials[-1] if rows else None,
    }


def _gaps(facts: dict) -> int:
    return 0 if facts["low"] is None else facts["high"] - facts["low"] + 1 - facts["turns"]


def _merged(parts: list[dict]) -> dict:
    """Facts of parts that follow each other, turns ascending."""
    out = dict.fromkeys(("n", "turns", "blank", "duplicate", "truncated", "illegal"), 0) | dict.fromkeys(("low", "high", "head", "tail"))
    for p in parts:
        if out["high"] is not None and out["high"] == p["low"]:
            out["turns"] -= 1
        if out["tail"] is not None and p["head"] is not None:
            out["illegal"] += out["tail"] + p["head"] not in LEGAL
        for k in ("n", "turns", "blank", "duplicate", "truncated", "illegal"):
            out[k] += p[k]
        out["low"] = p["low"] if out["low"] is None else out["low"]
        out["high"] = out["high"] if p["high"] is None else p["high"]
        out["head"] = out["head"] or p["head"]
        out["tail"] = p["tail"] or out["tail"]
    cost, rank = combined([(p["cost"], p["rank"]) for p in parts if p["n"]])
    return out | {"cost": cost, "rank": rank}


class _Reader:
    """A task's sorted rows, one conversation after another."""

    def __init__(self, batches: Iterator[pa.RecordBatch]) -> None:
        self.rows = ([x.as_py() for x in row] for b in batches for row in zip(*b.columns, strict=True))

    def chunks(self, size: int) -> Iterator[tuple]:
        """(conv_id, rows, turns, first of its conversation, last of it)."""
        held, turns, conv, first, begun = [], [], None, True, False
        for c, turn, role, text, copies, again in self.rows:
            if begun and c != conv:
                yield conv, held, turns, first, True
                held, turns, first = [], [], True
            conv, begun = c, True
            for k in range(copies):
                if len(held) == size:
                    yield conv, held, turns, first, False
                    held, turns, first = [], [], False
                held.append(Row(role, text, again or k > 0))
                turns.append(turn)
        if begun:
            yield conv, held, turns, first, True


def repair_conversations(conversations: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` for each conversation, after damage."""
    id_type, id_arrow = dict(conversations.dtypes)["conv_id"], to_arrow_type(conversations.schema["conv_id"].dataType)
    spark = conversations.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_repeats(damaged(conversations))
    order = ["conv_id", "turn", "role", "text"]
    laid = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)

    edge = _EDGE.format(id_type)
    schema = f"{edge}, {_RESULT}, facts struct<{_colons(_FACTS)}>, payload binary"
    arrow = _arrow(schema, id_arrow)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out, seen, seq = [], 0, 0
        waiting = None  # the last chunk, which may be the task's last
        for item in _Reader(batches).chunks(chunk):
            if waiting:
                out.append(_answer(*waiting, part, seq, seen == 0))
                seen += waiting[4]
                seq += 1
            waiting = item
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if waiting:
            out.append(_answer(*waiting, part, seq, True))
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    columns = [*order, "copies", "again"]
    found = stored(laid.select(*columns).mapInArrow(search, schema), "conversation-chunks")
    whole = found.where("kind = 0").select("conv_id", *_COUNTS, "audit", "repaired_sha256")
    return whole.unionByName(_across(found.where("kind = 1"), id_type, id_arrow))


def _answer(conv, rows: list[Row], turns: list, first: bool, last: bool, part: int, seq: int, edge: bool) -> dict:
    """A whole conversation's result (kind 0), or a chunk of one that may go on
    in another task or chunk (kind 1)."""
    facts, search = _facts(rows, turns), Search(rows)
    base = {"conv_id": conv, "part": part, "seq": seq}
    if first and last and not edge:
        cost, audit = search.best()
        text = "\n".join(search.repaired(audit)).encode("utf-8", "surrogatepass")
        kept = {k: facts[k] for k in ("blank", "duplicate", "truncated", "illegal")}
        return base | kept | {"kind": 0, "gaps": _gaps(facts), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text).hexdigest()}
    if rows:
        facts["cost"], facts["rank"] = summary(rows)
    return base | {"kind": 1, "facts": facts, "payload": _packed(rows)}


def _packed(rows: list[Row]) -> bytes:
    return zlib.compress(json.dumps([(r.role, r.text, r.again) for r in rows]).encode(), 1)


def _unpacked(payload: bytes) -> list[Row]:
    return [Row(*r) for r in json.loads(zlib.decompress(payload))]


def _colons(fields: str) -> str:
    return ", ".join(": ".join(f.split(" ", 1)) for f in fields.split(", "))


def _arrow(schema: str, id_arrow: pa.DataType) -> pa.Schema:
    out = to_arrow_schema(StructType.fromDDL(schema))
    return out.set(0, pa.field("conv_id", id_arrow))


#: Chunks are combined by partition, by so many partitions, by conversation.
_LEVELS = ("part", "part div 1024", "0")


def _across(chunks: DataFrame, id_type: str, id_arrow: pa.DataType) -> DataFrame:
    """Results of the conversations that lie in several chunks or tasks."""
    spark = chunks.sparkSession
    levels = [chunks.selectExpr("conv_id", "part as g", "part", "seq as place", "facts")]
    up_schema = f"conv_id {id_type}, g int, part int, place int, facts struct<{_colons(_FACTS)}>"
    up_arrow = _arrow(up_schema, id_arrow)

    def join(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        facts = _merged([r["facts"] for r in rows])
        part = rows[0]["part"]
        return pa.Table.from_pylist([{"conv_id": key[0].as_py(), "g": 0, "part": part, "place": part, "facts": facts}], schema=up_arrow)

    for i, after in enumerate([*_LEVELS[1:], "0"]):
        above = levels[-1].groupBy("conv_id", "g").applyInArrow(join, up_schema)
        above = above.selectExpr("conv_id", f"cast({after} as int) as g", "part", "place", "facts")
        levels.append(stored(above, f"conversation-level-{i}"))

    # The states chosen, from the whole conversation down to its chunks.
    down_schema = f"conv_id {id_type}, part int, place int, before int, after int"
    down_arrow = _arrow(down_schema, id_arrow)

    def choose(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        state = rows[0]["before"]
        live = [r for r in rows if r["facts"]["n"]]
        _, states = route([(r["facts"]["cost"], r["facts"]["rank"]) for r in live], state, rows[0]["after"])
        chosen = iter(states)
        out = []
        for r in rows:
            then = next(chosen) if r["facts"]["n"] else state
            out.append({"conv_id": key[0].as_py(), "part": r["part"], "place": r["place"], "before": state, "after": then})
            state = then
        return pa.Table.from_pylist(out, schema=down_arrow)

    top = levels[-1]
    picked = top.selectExpr("conv_id", "0 as g", f"{NOTHING} as before", "cast(null as int) as after")
    for i in range(len(_LEVELS) - 1, -1, -1):
        own = levels[i]
        with_states = own.join(picked.selectExpr("conv_id as _c", "g as _g", "before", "after"), F.expr("conv_id <=> _c and g = _g")).drop("_c", "_g")
        picked = stored(with_states.groupBy("conv_id", "g").applyInArrow(choose, down_schema), f"conversation-states-{i}")
        if i:
            # A row of this level stands for a group of the level below.
            picked = picked.selectExpr("conv_id", f"cast({_LEVELS[i - 1]} as int) as g", "before", "after")

    # Each chunk's part of the answer, then the conversation's, chunk after chunk.
    part_schema = f"conv_id {id_type}, part int, seq int, cost long, audit string, repaired string, after int"
    part_arrow = _arrow(part_schema, id_arrow)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                conv, part, seq, payload, before, after = (x.as_py() for x in row)
                rows = _unpacked(payload)
                search, cost, audit = Search(rows), 0, ""
                if rows:
                    cost, audit = search.best(before, after)
                lines = search.repaired(audit, before)
                one = [conv, part, seq, cost, audit, "\n".join(lines) if lines else None, after]
                yield pa.RecordBatch.from_pylist([dict(zip(part_arrow.names, one, strict=True))], part_arrow)

    state = picked.selectExpr("conv_id as _c", "part as _p", "place as _s", "before", "after")
    open_ = chunks.select("conv_id", "part", "seq", "payload").join(state, F.expr("conv_id <=> _c and part = _p and seq = _s"))
    answers = open_.select("conv_id", "part", "seq", "payload", "before", "after").mapInArrow(answer, part_schema)
    result = f"conv_id {id_type}, cost long, audit string, repaired_sha256 string"
    result_arrow = _arrow(result, id_arrow)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        teller = None
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                conv, _, _, cost, audit, repaired, after = (x.as_py() for x in row)
                if teller is None or teller.conv != conv:
                    if teller is not None:
                        yield pa.RecordBatch.from_pylist([teller.result()], result_arrow)
                    teller = _Teller(conv)
                teller.add(cost, audit, repaired, after)
        if teller is not None:
            yield pa.RecordBatch.from_pylist([teller.result()], result_arrow)

    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = answers.repartition(count, "conv_id").sortWithinPartitions("conv_id", "part", "seq")
    results = in_order.mapInArrow(told, result).withColumnRenamed("conv_id", "_c")
    counted = top.selectExpr("conv_id", "coalesce(facts.high - facts.low + 1 - facts.turns, 0) as gaps", *[f"facts.{c} as {c}" for c in ("blank", "duplicate", "truncated", "illegal")])
    return counted.join(results, F.expr("conv_id <=> _c")).select("conv_id", *_COUNTS, "audit", "repaired_sha256")


class _Teller:
    """A conversation's result from the parts of its chunks, in order."""

    def __init__(self, conv) -> None:
        self.conv, self.cost, self.audit, self.digest, self.begun, self.state = conv, 0, [], hashlib.sha256(), False, NOTHING

    def add(self, cost: int, audit: str, repaired: str | None, state: int) -> None:
        self.cost += cost
        self.audit.append(audit)
        self.state = state
        if repaired is not None:
            self.digest.update(("\n" * self.begun + repaired).encode())
            self.begun = True

    def result(self) -> dict:
        while _END[self.state]:
            turn = _TURN[self.state]
            self.add(INSERT, "I", "user:" if turn == USER else "assistant:", turn)
        return {"conv_id": self.conv, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}
