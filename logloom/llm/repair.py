"""Cheapest repair of a conversation's structure, by branch and bound.

A conversation is its rows by turn (nulls first; rows of one turn by role, then
text). The first of these faults counts for a row: ``blank`` (no visible
character), ``duplicate`` (role and text seen earlier), ``truncated`` (the last visible
character ends no sentence). Blank and duplicate rows have to be deleted. Edits are

    Keep 0, Rerole to user or assistant 2, Delete 3, Insert an empty user or assistant row 2,

and 1 for each truncated row that stays. The repaired roles are an optional
system row and then pairs of user and assistant, or nothing. Of the cheapest edits those
whose initials (the audit) come first in ASCII order are taken. Since roles alternate,
an audit says which role each edit gives.

The search is depth first with an explicit stack. A node is how many rows are
done and the last role; a prefix is cut when its cost and a lower bound of the
remaining rows exceed the incumbent, when it equals the incumbent's cost with a
later audit, or when its node was reached before at a lower (cost, audit). It
ends when the stack is empty, so the incumbent is proved best.

Long conversations are cut into blocks of ``BLOCK`` rows; the search finds the best way through a
block for each pair of roles before and after it, and the blocks are chained over
these. That is exact: of two different prefixes of the same rows and cost neither
audit begins the other (an equal beginning would cost the same, and a further
insertion costs more), so the earlier prefix stays earlier whatever follows. Rows
are range-partitioned by conversation and turn: a conversation that holds a large
share of all rows is searched by many tasks, and only a few numbers per block are
chained in one. Its digest is by definition taken over its rows in order; that task
reads them as a stream.

Null roles and texts count as one space; the rows of a null ``conv_id`` are one
conversation. A role without an initial can't be kept. Repeated rows are
duplicates. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.store import stored

#: Rows of a block.
BLOCK = 32
#: Conversations up to this many rows and bytes that lie within a partition are chained on the spot.
LOCAL_ROWS = 4096
LOCAL_BYTES = 1 << 23

_SPACE = r"' \t\n\u000B\u000C\r'"
_KEEP, _REROLE, _DELETE, _INSERT, _CUT = 0, 2, 3, 2, 1

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_ROLES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_NEXT = (USER, USER, ASSISTANT, USER)  # the only role that may be given after each state
_CLOSING = ("", "II", "I", "")  # what completes each state
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_STATES = range(4)

FAULTS = "-bdt"  # none, blank, duplicate, truncated


@functools.lru_cache(maxsize=1 << 16)
def search(kinds: str, start: int, goal: int | None) -> tuple[int, str] | None:
    """The least (cost, audit) through rows of ``kinds`` from one state to another.

    ``kinds`` has an initial and a fault for each row. Without a goal the
    conversation ends here, complete; with one it goes on, and insertions are
    left to the next rows.
    """
    rows = [kinds[i : i + 2] for i in range(0, len(kinds), 2)]
    bound = [0] * (len(rows) + 1)
    for i in range(len(rows) - 1, -1, -1):
        initial, fault = rows[i]
        cut = _CUT if fault == "t" else 0
        least = _DELETE if fault in "bd" else min(_DELETE, cut + (_KEEP if initial in _ROLES else _REROLE))
        bound[i] = bound[i + 1] + least
    best = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        if best:
            least = cost + bound[at]
            if least > best[0] or least == best[0] and audit > best[1][: len(audit)]:
                continue
        before = reached.get((at, state))
        if before and before <= (cost, audit):
            continue
        reached[at, state] = cost, audit
        onward = []
        if at == len(rows):
            if goal is None:
                if state in (START, ASSISTANT):
                    best = min(best, (cost, audit)) if best else (cost, audit)
                else:
                    onward.append((at, _NEXT[state], cost + _INSERT, audit + "I"))
            elif state == goal and not audit.endswith("I"):
                best = min(best, (cost, audit)) if best else (cost, audit)
        else:
            initial, fault = rows[at]
            if fault not in "bd":
                cut = _CUT if fault == "t" else 0
                onward.append((at + 1, _NEXT[state], cost + cut + _REROLE, audit + "R"))
                if (state, initial) in _KEPT:
                    onward.append((at + 1, _KEPT[state, initial], cost + cut + _KEEP, audit + "K"))
            onward.append((at + 1, state, cost + _DELETE, audit + "D"))
            onward.append((at, _NEXT[state], cost + _INSERT, audit + "I"))
        stack += sorted(onward, key=lambda n: (n[2] + bound[n[0]], n[3]), reverse=True)  # the cheapest on top
    return best


def transfers(kinds: str) -> tuple[list[int | None], list[int]]:
    """Costs through a block for each pair of states, and how the audits of one start rank."""
    costs, ranks = [], []
    for i in _STATES:
        found = [search(kinds, i, j) for j in _STATES]
        order = sorted((f[1], j) for j, f in enumerate(found) if f)
        place = {j: n for n, (_, j) in enumerate(order)}
        costs += [f[0] if f else None for f in found]
        ranks += [place.get(j, 0) for j in _STATES]
    return costs, ranks


class Chain:
    """Blocks of one conversation, chained one after the other."""

    def __init__(self):
        self.best = {START: (0, 0)}  # state -> (cost, rank of the audit so far)
        self.back: list[tuple[int | None, ...]] = []

    def add(self, costs: list[int | None], ranks: list[int]) -> None:
        ways = {}
        for j in _STATES:
            found = [
                (cost + costs[4 * i + j], rank, i) for i, (cost, rank) in self.best.items() if costs[4 * i + j] is not None
            ]
            if found:
                ways[j] = min(found)
        order = sorted(ways, key=lambda j: (ways[j][1], ranks[4 * ways[j][2] + j]))
        self.best = {j: (ways[j][0], n) for n, j in enumerate(order)}
        self.back.append(tuple(ways[j][2] if j in ways else None for j in _STATES))

    def ways(self) -> tuple[int, list[tuple[int, int]], str]:
        """The cost, the states around each block, and the insertions that complete the last."""
        cost, _, state = min((c + _INSERT * len(_CLOSING[j]), rank, j) for j, (c, rank) in self.best.items())
        closing, path = _CLOSING[state], []
        for back in reversed(self.back):
            path.append((back[state], state))
            state = back[state]
        return cost, path[::-1], closing


def repaired(rows: list[tuple[str, str]], audit: str, state: int) -> Iterator[tuple[int, str, str]]:
    """State, role and text of each row that the edits leave."""
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        state = _KEPT[state, role[:1]] if edit == "K" else _NEXT[state]
        yield state, role if edit == "K" else _NAMES[state], text


class _Counts:
    """What is counted over the rows of a block, and over blocks in order."""

    def __init__(self):
        self.faults = dict.fromkeys(FAULTS, 0)
        self.illegal = self.turns = 0
        self.head = self.tail = self.low = self.high = None

    def add(self, faults, illegal: int, turns: int, head: str, tail: str, low, high) -> None:
        for fault, n in faults.items():
            self.faults[fault] += n
        self.illegal += illegal + (self.tail is not None and self.tail + head not in ("su", "ua", "au"))
        self.turns += turns - (low is not None and low == self.high)
        self.head, self.tail = head if self.head is None else self.head, tail
        self.low = low if self.low is None else self.low
        self.high = self.high if high is None else high

    def row(self, turn, initial: str, fault: str) -> None:
        self.add({fault: 1}, 0, turn is not None, initial, initial, turn, turn)

    def result(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {
            "gaps": gaps, "blank": self.faults["b"], "duplicate": self.faults["d"],
            "truncated": self.faults["t"], "illegal": self.illegal,
        }


_RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
RESULT = f"conv_id bigint, {_RESULT}"
# A whole conversation has a result, and so no block; a block has no result.
PARTS = (
    f"{RESULT}, part int, number int, kinds string, rows array<struct<role:string,text:string>>, costs array<int>,"
    " ranks array<int>, faults array<int>, turns int, head string, tail string, low bigint, high bigint"
)
CHOICES = "part int, number int, before int, after int, closing string, cost bigint"

_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32()),
    "array<struct<role:string,text:string>>": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])),
}


@functools.cache
def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (f.rsplit(" ", 1) for f in schema.split(", "))])


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _arrow(schema))


class _Digest:
    """SHA-256 of ``role:text`` of the repaired rows, a line each."""

    def __init__(self):
        self.sha, self.any = hashlib.sha256(), False

    def add(self, rows: Iterator[tuple[int, str, str]]) -> None:
        for _, role, text in rows:
            self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True


class _Conversation:
    """Rows of one conversation as they come; ``open`` if other partitions may hold more."""

    def __init__(self, conv_id, is_open: bool):
        self.conv_id, self.open = conv_id, is_open
        self.rows, self.last, self.size, self.number = [], None, 0, 0

    def add(self, turn, role: str, text: str, fault: str, later: bool) -> None:
        if fault != "b" and (later or self.last == (turn, role, text)):
            fault = "d"
        self.last = turn, role, text
        self.rows.append((turn, role, text, role[:1], fault))
        self.size += len(role) + len(text)
        self.open = self.open or len(self.rows) > LOCAL_ROWS or self.size > LOCAL_BYTES

    def _blocks(self):
        for at in range(0, len(self.rows), BLOCK):
            rows = self.rows[at : at + BLOCK]
            yield rows, "".join((i if i in _ROLES else "x") + f for *_, i, f in rows)

    def result(self) -> dict:
        """Edits and counts of a conversation that is here as a whole."""
        counts, digest, blocks, chain = _Counts(), _Digest(), list(self._blocks()), Chain()
        for turn, _, _, initial, fault in self.rows:
            counts.row(turn, initial, fault)
        if len(blocks) == 1:
            cost, audit = search(blocks[0][1], START, None)
            audits = [(START, audit)]
        else:
            for _, kinds in blocks:
                chain.add(*transfers(kinds))
            cost, ways, closing = chain.ways()
            audits = [(i, search(kinds, i, j)[1]) for (i, j), (_, kinds) in zip(ways, blocks)]
            audits[-1] = audits[-1][0], audits[-1][1] + closing
        for (state, audit), (rows, _) in zip(audits, blocks):
            digest.add(repaired([r[1:3] for r in rows], audit, state))
        return {
            "conv_id": self.conv_id, **counts.result(), "cost": cost,
            "audit": "".join(a for _, a in audits), "repaired_sha256": digest.sha.hexdigest(),
        }

    def parts(self, part: int, first: int) -> list[dict]:
        """Blocks for chaining elsewhere; the rows are let go."""
        out = []
        for rows, kinds in self._blocks():
            counts = _Counts()
            for turn, _, _, initial, fault in rows:
                counts.row(turn, initial, fault)
            costs, ranks = transfers(kinds)
            out.append({
                "conv_id": self.conv_id, "part": part, "number": first + len(out), "kinds": kinds,
                "rows": [{"role": r[1], "text": r[2]} for r in rows], "costs": costs, "ranks": ranks,
                "faults": [counts.faults[f] for f in FAULTS], "illegal": counts.illegal, "turns": counts.turns,
                "head": counts.head, "tail": counts.tail, "low": counts.low, "high": counts.high,
            })
        self.rows, self.size = [], 0
        return out


def _solve(batches: Iterator[pa.RecordBatch]):
    """Results of the conversations that a partition holds whole; blocks of the others."""
    part, number, now, out, held = TaskContext.get().partitionId(), 0, None, [], 0
    for batch in batches:
        for conv_id, *row in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "later"))):
            changed = now is None or conv_id != now.conv_id
            if now is not None and now.open and (changed or len(now.rows) >= BLOCK):
                held += now.size
                found = now.parts(part, number)
                number += len(found)
                out += found
            elif now is not None and changed:
                out.append(now.result())
            if changed:
                now = _Conversation(conv_id, now is None)
            now.add(*row)
            if len(out) >= 256 or held >= LOCAL_BYTES:
                yield _batch(out, PARTS)
                out, held = [], 0
    if now is not None:
        out += now.parts(part, number)  # the next partition may go on with it
    yield _batch(out, PARTS)


def _conversations(batches: Iterator[pa.RecordBatch]):
    """Rows of a partition that is sorted by conversation, and whether each begins one."""
    last = ()
    for batch in batches:
        for row in batch.to_pylist():
            yield row, last != (row["conv_id"],)
            last = (row["conv_id"],)


def _chain(batches: Iterator[pa.RecordBatch]):
    """The way through each block. A block costs the task four numbers and its name."""

    def choices():
        cost, ways, closing = chain.ways()
        last = len(ways) - 1
        for n, ((part, number), (i, j)) in enumerate(zip(names, ways)):
            yield {
                "part": part, "number": number, "before": i, "after": j,
                "closing": closing if n == last else "", "cost": cost,
            }

    def pages(rows):
        page = []
        for row in rows:
            page.append(row)
            if len(page) == 4096:
                yield _batch(page, CHOICES)
                page = []
        yield _batch(page, CHOICES)

    chain, names = None, []
    for row, begins in _conversations(batches):
        if begins:
            if chain:
                yield from pages(choices())
            chain, names = Chain(), []
        chain.add(row["costs"], row["ranks"])
        names.append((row["part"], row["number"]))
    if chain:
        yield from pages(choices())


def _join(batches: Iterator[pa.RecordBatch]):
    """Results from blocks in order, each with its way."""
    now = None

    def result():
        conv_id, counts, digest, audits, cost = now
        return _batch(
            [{"conv_id": conv_id, **counts.result(), "cost": cost, "audit": "".join(audits), "repaired_sha256": digest.sha.hexdigest()}],
            RESULT,
        )

    for row, begins in _conversations(batches):
        if begins:
            if now:
                yield result()
            now = row["conv_id"], _Counts(), _Digest(), [], row["cost"]
        _, counts, digest, audits, _ = now
        counts.add(
            dict(zip(FAULTS, row["faults"])), row["illegal"], row["turns"], row["head"], row["tail"], row["low"], row["high"]
        )
        audits.append(search(row["kinds"], row["before"], row["after"])[1] + row["closing"])
        digest.add(repaired([(r["role"], r["text"]) for r in row["rows"]], audits[-1], row["before"]))
    if now:
        yield result()


def _rows(turns: DataFrame) -> DataFrame:
    return turns.selectExpr(
        "CAST(conv_id AS BIGINT) AS conv_id", "CAST(turn AS BIGINT) AS turn",
        "coalesce(CAST(role AS STRING), ' ') AS role", "coalesce(CAST(text AS STRING), ' ') AS text",
    )


def _faulted(rows: DataFrame) -> DataFrame:
    """Rows with their own fault, and whether an earlier turn has their role and text.

    First turns are gathered by hashes, partially before the shuffle, and only of what
    occurs twice; rows of one turn that are equal are told apart when they are
    in order.
    """
    seen = rows.selectExpr("*", "right(rtrim({0}, text), 1) AS last".format(_SPACE)).selectExpr(
        "conv_id", "turn", "role", "text",
        "CASE WHEN last = '' THEN 'b' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault",
        "IF(last = '', NULL, sha2(text, 256)) AS digest", "struct(turn IS NOT NULL AS dated, turn) AS place",
    )
    firsts = (
        seen.where("digest IS NOT NULL").groupBy("conv_id", "role", "digest")
        .agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
        .selectExpr("conv_id AS c", "role AS r", "digest AS d", "first")
    )
    return seen.join(firsts, F.expr("conv_id <=> c AND role = r AND digest = d"), "left").selectExpr(
        "conv_id", "turn", "role", "text", "fault", "coalesce(place > first, false) AS later"
    )


def repair_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``).

    ``gaps`` are missing turn numbers, ``blank``, ``duplicate`` and ``truncated`` count rows by
    their fault, ``illegal`` adjacent roles that can't follow each other, all before the
    repair; ``cost`` and ``audit`` tell the repair, ``repaired_sha256`` its ``role:text`` lines.
    """
    order = ("conv_id", "turn", "role", "text")
    # Beginnings order like the whole and keep the sampled keys short.
    ranged = _faulted(_rows(turns)).repartitionByRange(
        "conv_id", "turn", F.substring("role", 1, 32), F.substring("text", 1, 32)
    )
    parts = stored(ranged.sortWithinPartitions(*order).mapInArrow(_solve, PARTS), "repairs")
    names = [f.split()[0] for f in RESULT.split(", ")]
    whole = parts.where("part IS NULL").select(names)
    blocks = parts.where("part IS NOT NULL").drop("cost", "audit", "repaired_sha256", "gaps", "blank", "duplicate", "truncated")
    place = ("conv_id", "part", "number")

    def together(df: DataFrame) -> DataFrame:
        return df.repartition("conv_id").sortWithinPartitions(*place)

    ways = together(blocks.select(*place, "costs", "ranks")).mapInArrow(_chain, CHOICES)
    long = together(blocks.drop("costs", "ranks").join(ways, ["part", "number"])).mapInArrow(_join, RESULT)
    return whole.union(long)


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with reproducible damage by a checksum of conversation and turn."""
    h = "crc32(concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' '))) % 20"
    return _rows(turns).withColumn("h", F.expr(h)).where("h <> 0").selectExpr(
        "conv_id", "turn", "IF(h = 4, 'user', role) AS role",
        "CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text",
        "explode(array_repeat(0, IF(h = 3, 2, 1))) AS copy",
    ).drop("copy")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """Repairs after ``damaged``; conversations of which no row is left have zeros."""
    found = repair_conversations(damaged(turns)).withColumnRenamed("conv_id", "c")
    every = _rows(turns).select("conv_id").distinct()
    zeros = [f"coalesce({n}, 0L) AS {n}" for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.expr("conv_id <=> c"), "left").selectExpr(
        "conv_id", *zeros, "coalesce(audit, '') AS audit", "coalesce(repaired_sha256, sha2('', 256)) AS repaired_sha256"
    )
