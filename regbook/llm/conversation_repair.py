"""Conversation structure repair by depth-first branch-and-bound.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?`` and no row in it
is blank, repeated or broken off. The cheapest edits that make it so are searched for:
the nodes are (rows read, last role), an explicit stack holds what is still to be
explored, a suffix bound tells what the remaining rows cost at least, the incumbent is the
best (cost, audit) so far, and a dominance table per node cuts every prefix that is not
better than one already seen there. The search ends when the stack is empty: nothing left
can beat the incumbent, so it is optimal, ties included.

Rows are sorted over the cluster by conversation and turn, so a conversation may lie in
several partitions. Stretches of at most ``ROWS`` rows are solved on their own: one that
is a whole conversation once, one that is a part of it for every pair of a role before
and a role behind it. The parts of a conversation are chained afterwards; what the chain
holds of a part are eleven costs and audits, no texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..storage import materialise
from .common import SPACES, arrow_map, quoted

# Rows, and bytes of text, of one stretch.
ROWS = 128
STRETCH_BYTES = 8 << 20
# Rows whose bound is exact; at the border of two such windows the role is free.
WINDOW = 32
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
# The last role of what has been repaired so far.
START, SYSTEM, USER, ASSISTANT = range(4)
# What an inserted or rerolled row becomes after each of them.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = ("", "system", "user", "assistant")
COMPLETE = frozenset((START, ASSISTANT))
FAR = 1 << 60
PLAIN, BROKEN, LOST = range(3)


def _moves(initial: str, fault: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """Edits of a row after a role, with their cost and the role they lead to."""
    out = [("D", DELETE, state)]
    if fault != LOST:
        extra = TRUNCATED if fault == BROKEN else 0
        if initial == "s" and state == START:
            out.append(("K", extra, SYSTEM))
        elif initial == "u" and state != USER:
            out.append(("K", extra, USER))
        elif initial == "a" and state == USER:
            out.append(("K", extra, ASSISTANT))
        out.append(("R", REROLE + extra, NEXT[state]))
    return tuple(out)


MOVES = {(c, f): [_moves(c, f, s) for s in range(4)] for c in "sua?" for f in (PLAIN, BROKEN, LOST)}


def _code(role: str, fault: int) -> tuple[str, int]:
    return (role[:1] if role[:1] in ("s", "u", "a") else "?", fault)


def _bounds(codes: list[tuple[str, int]], accept: frozenset[int]) -> list[list[int]]:
    """What the rows from each on cost at least after each role: exact up to the end of
    the row's window, and from there on the least over all roles."""
    last = []
    for state in range(4):
        steps, at = 0, state
        while at not in accept and steps < 4:
            steps, at = steps + 1, NEXT[at]
        last.append(INSERT * steps if steps < 4 else FAR)
    out = [last]
    for i in range(len(codes) - 1, -1, -1):
        after = out[-1]
        if (i + 1) % WINDOW == 0 and i + 1 < len(codes):
            after = [min(after)] * 4
        plain = [min(cost + after[to] for _, cost, to in moves) for moves in MOVES[codes[i]]]
        once = [min(plain[s], INSERT + plain[NEXT[s]]) for s in range(4)]
        out.append([min(plain[s], INSERT + once[NEXT[s]]) for s in range(4)])
    return out[::-1]


def search(codes: list[tuple[str, int]], entry: int, accept: frozenset[int]) -> tuple[int, str, int] | None:
    """The least (cost, audit) that leads from ``entry`` to a role of ``accept``, and
    that role; ``None`` if there is none."""
    bounds, n = _bounds(codes, accept), len(codes)
    if bounds[0][entry] >= FAR:
        return None
    cost, audit, end = FAR, "", START
    dominance: dict[int, tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, spent, path = stack.pop()
        least = spent + bounds[i][state]
        if least > cost or least == cost and path > audit[: len(path)]:
            continue
        held = dominance.get(4 * i + state)
        if held is not None and held <= (spent, path):
            continue
        dominance[4 * i + state] = (spent, path)
        if i == n and state in accept and (spent, path) < (cost, audit):
            cost, audit, end = spent, path, state
        nodes = [(i + 1, to, spent + c, path + letter) for letter, c, to in MOVES[codes[i]][state]] if i < n else []
        nodes.append((i, NEXT[state], spent + INSERT, path + "I"))
        nodes.sort(key=lambda x: (x[2] + bounds[x[0]][x[1]], x[3]), reverse=True)
        stack += [x for x in nodes if x[2] + bounds[x[0]][x[1]] <= cost]
    return cost, audit, end


def follow(turns: list[tuple[str, str]], audit: str, state: int = START) -> tuple[list[tuple[str, str]], int]:
    """The repaired turns that an audit makes of ``(role, text)`` rows, and the last role."""
    out, rows = [], iter(turns)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter != "K":
            state = NEXT[state]
            role = NAMES[state]
        else:
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
        out.append((role, text))
    return out, state


def _all_paths(codes: list[tuple[str, int]]) -> list[dict]:
    found = []
    for entry in range(4):
        for leave in range(4):
            best = search(codes, entry, frozenset((leave,)))
            if best is not None:
                found.append({"entry": entry, "leave": leave, "cost": best[0], "audit": best[1]})
    return found


def chain(parts: list[list[dict]]) -> tuple[int, list[tuple[int, str]]]:
    """The cost of a conversation from the paths through its parts, and for each part the
    role before it and its share of the audit.

    Of two prefixes that end in the same role at the same cost none starts the other, so
    the lesser one stays the lesser whatever follows. What all survivors share leaves the
    comparison, which keeps the compared ends short."""
    alive: dict[int, tuple] = {START: (0, "", None)}
    for paths in parts:
        after: dict[int, tuple] = {}
        for p in paths:
            if p["entry"] in alive:
                cost, tail, behind = alive[p["entry"]]
                found = (cost + p["cost"], tail + p["audit"])
                if p["leave"] not in after or found < after[p["leave"]][:2]:
                    after[p["leave"]] = (*found, (behind, p["entry"], p["audit"]))
        tails = [tail for _, tail, _ in after.values()]
        low, high = min(tails), max(tails)
        same = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        alive = {state: (cost, tail[same:], node) for state, (cost, tail, node) in after.items()}
    cost, _, node = min((alive[s] for s in sorted(COMPLETE) if s in alive), key=lambda x: x[:2])
    shares = []
    while node is not None:
        node, entry, audit = node
        shares.append((entry, audit))
    return cost, shares[::-1]


class Stretch:
    """Rows of one conversation in order, and what is counted about them."""

    def __init__(self, conversation, opens: bool):
        self.conversation, self.opens = conversation, opens
        self.turns: list[tuple[str, str]] = []
        self.codes: list[tuple[str, int]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.n_turns = self.size = 0
        self.first_turn = self.last_turn = None
        self.first, self.last = "", None

    def add(self, turn, role: str, text: str, blank: bool, repeated: bool, broken: bool) -> None:
        self.blank += blank
        self.duplicate += not blank and repeated
        self.truncated += not blank and not repeated and broken
        fault = LOST if blank or repeated else BROKEN if broken else PLAIN
        if turn is not None and turn != self.last_turn:
            self.n_turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if self.last is None:
            self.first = role[:1]
        else:
            self.illegal += self.last + role[:1] not in ("su", "ua", "au")
        self.last = role[:1]
        self.turns.append((role, text))
        self.codes.append(_code(role, fault))
        self.size += len(text)

    def row(self, number: int, closes: bool) -> dict:
        whole = self.opens and closes
        if whole:
            cost, audit, leave = search(self.codes, START, COMPLETE)
            paths = [{"entry": START, "leave": leave, "cost": cost, "audit": audit}]
            turns = follow(self.turns, audit)[0]
        else:
            paths, turns = _all_paths(self.codes), self.turns
        return {
            "conversation": self.conversation, "stretch": number, "whole": whole, "blank": self.blank,
            "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
            "n_turns": self.n_turns, "first_turn": self.first_turn, "last_turn": self.last_turn,
            "first": self.first, "last": self.last, "paths": paths,
            "turns": [{"role": r, "text": t} for r, t in turns],
        }


TURNS = "array<struct<role: string, text: string>>"
COUNTS = "blank long, duplicate long, truncated long, illegal long, n_turns long, first_turn long, last_turn long"
STRETCH = (
    f"stretch long, whole boolean, {COUNTS}, first string, last string, "
    f"paths array<struct<entry: int, leave: int, cost: long, audit: string>>, turns {TURNS}"
)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Stretch, bool]]:
    """Stretches of sorted rows, and whether the conversation surely ends with them. What
    the first one continues and what continues the last one cannot be known here, so
    those count as parts."""
    held, before = None, None
    for batch in batches:
        for conversation, turn, role, text, blank, later, broken in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or conversation != held.conversation:
                if held is not None:
                    yield held, True
                held, before = Stretch(conversation, held is not None), None
            elif len(held.turns) >= ROWS or held.size >= STRETCH_BYTES:
                yield held, False
                held = Stretch(conversation, False)
            same = before == (turn, role, text)
            before = (turn, role, text)
            held.add(turn, role, text, blank, later or same, broken)
    if held is not None:
        yield held, False


def _solve(batches: Iterator[pa.RecordBatch], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 32
    rows, size = [], 0
    for number, (stretch, closes) in enumerate(_stretches(batches)):
        rows.append(stretch.row(base + number, closes))
        size += stretch.size + 100 * len(stretch.turns)
        if size >= STRETCH_BYTES:
            yield from pa.Table.from_pylist(rows, schema=kind).to_batches()
            rows, size = [], 0
    if rows:
        yield from pa.Table.from_pylist(rows, schema=kind).to_batches()


def _chain_parts(table: pa.Table) -> pa.Table:
    """The parts of one conversation, each with its share of the audit; what is counted
    between two parts is added to the later one."""
    parts = sorted(table.to_pylist(), key=lambda r: r["stretch"])
    cost, shares = chain([p["paths"] for p in parts])
    out = {name: [] for name in table.column_names if name != "paths"} | {"entry": [], "audit": [], "cost": []}
    for i, (part, (entry, audit)) in enumerate(zip(parts, shares)):
        turns = [p["last_turn"] for p in parts[:i][-1:]]
        if i:
            part["illegal"] += parts[i - 1]["last"] + part["first"] not in ("su", "ua", "au")
            if turns[0] is not None and turns[0] == part["first_turn"]:
                part["n_turns"] -= 1
        part |= {"entry": entry, "audit": audit, "cost": 0 if i else cost}
        for name, column in out.items():
            column.append(part[name])
    kept = [f for f in table.schema if f.name != "paths"]
    own = [pa.field("entry", pa.int32()), pa.field("audit", pa.string()), pa.field("cost", pa.int64())]
    return pa.table(out, schema=pa.schema([*kept, *own]))


def _follow_batches(batches: Iterator[pa.RecordBatch], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            turns = follow([(t["role"], t["text"]) for t in row["turns"]], row["audit"], row["entry"])[0]
            done = {k: row[k] for k in ("conversation", "stretch")}
            done["turns"] = [{"role": r, "text": t} for r, t in turns]
            yield pa.RecordBatch.from_pylist([done], schema=kind)


@dataclass(frozen=True)
class Repaired:
    """``report`` has one row per conversation: gaps, counts of faults, cost and audit.
    ``turns`` has the repaired turns in stretches: a conversation's stretches in order of
    ``stretch`` are its repaired form, and most conversations have one."""

    report: DataFrame
    turns: DataFrame


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of ``(conv_id, turn, role, text)`` damaged by the CRC-32 of ``conv_id:turn``
    modulo 20: 0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and
    question marks away, 3 repeats it, 4 makes its role user. Nulls count as one blank."""
    blank = F.lit(" ")
    number = [F.coalesce(quoted(c).cast("string"), blank) for c in ("conv_id", "turn")]
    rows = conversations.select(
        quoted("conv_id"),
        quoted("turn"),
        F.coalesce(quoted("role").cast("string"), blank).alias("role"),
        F.coalesce(quoted("text").cast("string"), blank).alias("text"),
        (F.crc32(F.concat_ws(":", *number)) % 20).alias("_kind"),
    ).filter("_kind != 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    damaged = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_copy"),
    )
    return damaged.drop("_copy")


def repair(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repaired:
    """The cheapest repair of every conversation of ``conversations``.

    A conversation's rows go by turn, nulls first, and within a turn by role and text. A row
    is *blank* without a character but white space, *duplicate* if its role and text came
    before, *truncated* if its last character but white space is none of ``.!?``; the first
    of these counts. Keeping a row costs 0, giving it the role that must follow 1,
    deleting it 2 (blank and duplicate rows must go), inserting an empty turn 5, and a
    truncated row that stays 5. Of audits at the same cost the least in ASCII order is taken.

    Null roles and texts count as one blank, a null conversation is one conversation, null
    turns come first and leave no gap. Other columns are not looked at, whatever their
    name. An empty table gives empty results. An audit is one string, which limits a
    conversation to 2^31 rows.
    """
    blank = F.lit(" ")
    rows = conversations.select(
        quoted(conv_col).alias("conversation"),
        quoted(turn_col).cast("long").alias("turn"),
        F.coalesce(quoted(role_col).cast("string"), blank).alias("role"),
        F.coalesce(quoted(text_col).cast("string"), blank).alias("text"),
    )
    content = [F.col("conversation").isNull(), F.col("conversation"), F.col("role"), F.col("text")]
    rows = rows.select("*", *[F.xxhash64(F.lit(i), *content).alias(f"key{i}") for i in (1, 2)])
    # Contents that occur at more than one turn; copies within a turn are neighbours.
    null_turn = F.max(F.col("turn").isNull())
    contents = rows.groupBy("key1", "key2").agg(null_turn.alias("nulls"), F.min("turn").alias("least"), F.max("turn").alias("most"))
    repeats = contents.filter("least < most or (nulls and least is not null)").withColumn("known", F.lit(True))
    later = F.col("known").isNotNull() & F.col("turn").isNotNull() & (F.col("nulls") | (F.col("turn") > F.col("least")))
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    flagged = rows.join(repeats, ["key1", "key2"], "left").select(
        "conversation",
        "turn",
        "role",
        "text",
        (bare == "").alias("blank"),
        later.alias("later"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("broken"),
    )
    # A very long text may not become a partition's border.
    dealt = flagged.repartitionByRange("conversation", "turn", "role", F.substring("text", 1, 100))
    ordered = dealt.sortWithinPartitions("conversation", "turn", "role", "text")
    kind = rows.schema["conversation"].dataType
    schema = f"conversation {kind.simpleString()}, {STRETCH}"
    stretches = materialise(arrow_map(ordered, _typed(schema, _solve), schema), "stretches")

    counts = ("blank", "duplicate", "truncated", "illegal", "n_turns", "first_turn", "last_turn")
    path = F.col("paths")[0]
    whole = stretches.filter("whole").select("conversation", "stretch", *counts, path["cost"].alias("cost"), path["audit"].alias("audit"))
    parts = stretches.filter("not whole")
    chained = parts.select("conversation", "stretch", *counts, "first", "last", "paths").groupBy("conversation")
    chained = chained.applyInArrow(
        _chain_parts,
        f"conversation {kind.simpleString()}, stretch long, {COUNTS}, first string, last string, entry int, audit string, cost long",
    )
    chained = materialise(chained, "chained")
    summed = chained.groupBy("conversation").agg(
        *[F.sum(c).alias(c) for c in counts[:5]],
        F.min("first_turn").alias("first_turn"),
        F.max("last_turn").alias("last_turn"),
        F.sum("cost").alias("cost"),
        F.array_join(F.sort_array(F.collect_list(F.struct("stretch", "audit")))["audit"], "").alias("audit"),
    )
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0))
    report = whole.drop("stretch").unionByName(summed).select(
        F.col("conversation").alias(conv_col), gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )
    pending = parts.select("conversation", "stretch", "turns").join(chained.select("stretch", "entry", "audit"), "stretch")
    done = f"conversation {kind.simpleString()}, stretch long, turns {TURNS}"
    followed = arrow_map(pending.select("conversation", "stretch", "turns", "entry", "audit"), _typed(done, _follow_batches), done)
    turns = stretches.filter("whole").select("conversation", "stretch", "turns").unionByName(followed)
    return Repaired(report, turns.withColumnRenamed("conversation", conv_col))


def _typed(schema: str, function):
    """``function`` with the Arrow form of a schema."""
    return partial(function, kind=to_arrow_schema(StructType.fromDDL(schema)))


def _digest_batches(batches: Iterator[pa.RecordBatch], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    state, current, empty = None, None, True
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if state is None or row["conversation"] != current:
                if state is not None:
                    done.append({"conversation": current, "sha256": state.hexdigest()})
                state, current, empty = hashlib.sha256(), row["conversation"], True
            for turn in row["turns"]:
                state.update(("" if empty else "\n").encode() + f"{turn['role']}:{turn['text']}".encode())
                empty = False
        yield pa.RecordBatch.from_pylist(done, schema=kind)
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"conversation": current, "sha256": state.hexdigest()}], schema=kind)


def digest(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``(conv_col, sha256)``: the hash of every repaired conversation's ``role:text``
    lines. The stretches of a conversation pass one task in order, one after the other,
    since the hash of a text cannot be put together from hashes of its parts; nothing but
    the hash's state is held."""
    rows = turns.select(quoted(conv_col).alias("conversation"), "stretch", "turns")
    kind = f"conversation {rows.schema['conversation'].dataType.simpleString()}, sha256 string"
    ordered = rows.repartition("conversation").sortWithinPartitions("conversation", "stretch")
    out = arrow_map(ordered, _typed(kind, _digest_batches), kind)
    return out.withColumnRenamed("conversation", conv_col)
