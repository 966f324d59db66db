"""Conversation repair against exhaustive search, over long conversations and odd rows."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from regbook.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile("(s?(ua)+)?")


def every_repair(codes):
    """The least (cost, audit) over all edits with up to two insertions at any place."""
    best = None
    for letters in itertools.product(*["D" if f == cr.LOST else "DKR" for _, f in codes]):
        for inserts in itertools.product(range(3), repeat=len(codes) + 1):
            roles, cost, audit = "", 0, ""
            for i in range(len(codes) + 1):
                cost += 5 * inserts[i]
                audit += "I" * inserts[i]
                roles += "?" * inserts[i]
                if i < len(codes):
                    (initial, fault), letter = codes[i], letters[i]
                    audit += letter
                    cost += {"D": 2, "K": 0, "R": 1}[letter] + 5 * (letter != "D" and fault == cr.BROKEN)
                    roles += {"D": "", "K": initial.replace("?", "x"), "R": "?"}[letter]
            # Rerolled and inserted rows may become user or assistant.
            fits = re.fullmatch("(s?(ua)+)?", roles) if "?" not in roles else any(
                LEGAL.fullmatch(roles_of(roles, first)) for first in "ua"
            )
            if fits and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def roles_of(roles, first):
    """The free roles filled in by alternation, the only way that can be legal."""
    out, following = "", first
    for c in roles:
        c = following if c == "?" else c
        out += c
        following = {"s": "u", "u": "a", "a": "u"}.get(c, "u")
    return out


def codes_of(rng, n):
    return [(rng.choice("suuaa?"), rng.choice((cr.PLAIN, cr.PLAIN, cr.PLAIN, cr.BROKEN, cr.LOST))) for _ in range(n)]


def test_search_is_exhaustive():
    rng = random.Random(3)
    for _ in range(150):
        codes = codes_of(rng, rng.randint(0, 4))
        assert cr.search(codes, cr.START, cr.COMPLETE)[:2] == every_repair(codes), codes


def by_steps(codes):
    """All rows at once, every role's least (cost, audit) after each row."""
    states = {0: (0, "")}

    def opened(states):
        out = dict(states)
        for _ in range(3):
            for s, (cost, audit) in list(out.items()):
                new = (cost + 5, audit + "I")
                out[cr.NEXT[s]] = min(out.get(cr.NEXT[s], new), new)
        return out

    for code in codes:
        after = {}
        for s, (cost, audit) in opened(states).items():
            for letter, extra, to in cr.MOVES[code][s]:
                new = (cost + extra, audit + letter)
                after[to] = min(after.get(to, new), new)
        states = after
    return min(v for s, v in opened(states).items() if s in cr.COMPLETE)


@pytest.mark.parametrize("n", [17, 40, 200, 500])
def test_long_conversations(n):
    rng = random.Random(n)
    for _ in range(20):
        codes = codes_of(rng, n)
        assert cr.search(codes, cr.START, cr.COMPLETE)[:2] == by_steps(codes)


def test_chained_parts_equal_the_whole():
    rng = random.Random(8)
    for _ in range(60):
        codes = codes_of(rng, rng.randint(1, 60))
        size = rng.randint(1, 20)
        parts = [codes[i : i + size] for i in range(0, len(codes), size)]
        cost, shares = cr.chain([cr._all_paths(p) for p in parts])
        assert (cost, "".join(a for _, a in shares)) == cr.search(codes, cr.START, cr.COMPLETE)[:2]
        state = cr.START
        for part, (entry, audit) in zip(parts, shares):
            assert entry == state and len(audit.replace("I", "")) == len(part)
            state = cr.follow([({"?": "x"}.get(c, c), "") for c, _ in part], audit, state)[1]


def expected(rows):
    """What must come out for the rows of one conversation, in order."""
    codes, seen, blank, duplicate, truncated = [], set(), 0, 0, 0
    for turn, role, text in rows:
        bare = text.strip(cr.SPACES)
        fault = cr.PLAIN
        if not bare:
            blank, fault = blank + 1, cr.LOST
        elif (role, text) in seen:
            duplicate, fault = duplicate + 1, cr.LOST
        elif bare[-1] not in ".!?":
            truncated, fault = truncated + 1, cr.BROKEN
        seen.add((role, text))
        codes.append(cr._code(role, fault))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = by_steps(codes)
    text = "\n".join(f"{r}:{t}" for r, t in cr.follow([(r, t) for _, r, t in rows], audit)[0])
    return gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def result(spark, df):
    repaired = cr.repair(df)
    hashes = {r[0]: r[1] for r in cr.digest(repaired.turns).collect()}
    return {r[0]: (*r[1:], hashes[r[0]]) for r in repaired.report.collect()}


def test_tables(spark):
    rng = random.Random(21)
    rows = []
    for conv in [*range(30), None, 77]:
        for turn in range(1500 if conv == 77 else rng.randint(1, 12)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", "User"])
            text = rng.choice(["Yes.", "No", "Why? ", " \t\n", "", "a b\x0b", f"t{turn}.", f"t{turn}", "x. "])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 5]), role, text))
    rows += rows[:40]
    got = result(spark, spark.createDataFrame(rows, SCHEMA).repartition(5))
    for conv in {r[0] for r in rows}:
        own = in_order([r[1:] for r in rows if r[0] == conv])
        assert got[conv] == expected(own), conv
    assert len(got) == len({r[0] for r in rows})


def test_nulls_empty_and_extra_columns(spark):
    odd = spark.createDataFrame([(None, None, None, None), (1, 1, None, "Hi."), (1, 2, "assistant", None)], SCHEMA)
    clash = odd
    for name in ("conversation", "stretch", "later", "a.b", "key1", "_kind"):
        clash = clash.withColumn(name, F.lit(name))
    got = result(spark, clash)
    assert got[None] == expected([(None, " ", " ")])
    assert got[1] == expected([(1, " ", "Hi."), (2, "assistant", " ")])
    assert cr.damage(clash).columns == ["conv_id", "turn", "role", "text"]
    empty = cr.repair(odd.limit(0))
    assert empty.report.count() == 0 and cr.digest(empty.turns).count() == 0


def test_damage(spark):
    import zlib

    rows = [(c, t, "system", "A. b! c?") for c in range(8) for t in range(8)] + [(None, None, None, None)]
    expect = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if kind:
            text = {1: "", 2: "A b c"}.get(kind, text) if text != " " or kind == 1 else text
            expect += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    got = [tuple(r) for r in cr.damage(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=repr) == sorted(expect, key=repr)
