import hashlib
import itertools
import random
import re
import zlib

import pytest
from helpers import with_clashes

from assetrank.llm import conversation_repair
from assetrank.llm.catalog import op13_survivor_viterbi

PATTERN = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    """(conv, turn or None, role, text) rows after the damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    """blank, duplicate, truncated or None for each (role, text), in order."""
    seen, out = set(), []
    for role, text in rows:
        last = text.strip(" \t\n\x0b\x0c\r")[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None)
        seen.add((role, text))
    return out


def repairs(rows, named):
    """(cost, audit, lines) of the cheapest repair, the ASCII-least audit first: a dynamic
    program that keeps whole audits and compares them from their first letter."""
    # state: (end of the roles' initials, at most what the pattern can tell apart); whole audits are kept
    best = {"": {(0, "", ())}}

    def legal(roles):
        return re.fullmatch(r"s?(ua)*u?", roles) is not None

    def folded(roles):
        while len(roles) > 3:
            roles = roles[0] + roles[3:] if roles[0] == "s" else roles[2:]
        return roles

    def inserted(front):
        out = {}
        for roles, options in front.items():
            for extra in range(3):
                more = "".join(itertools.islice(itertools.cycle("ua" if not roles or roles[-1] in "sa" else "au"), extra))
                if legal(roles + more):
                    lines = tuple(f"{'user' if x == 'u' else 'assistant'}:" for x in more)
                    for cost, audit, done in options:
                        out.setdefault(folded(roles + more), set()).add((cost + 3 * extra, audit + "I" * extra, done + lines))
        return out

    for (role, text), fault in zip(rows, named, strict=True):
        new = {}
        for roles, options in inserted(best).items():
            steps = [(roles, 4, "D", ())]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                steps.append((roles + role[:1], more, "K", (f"{role}:{text}",)) if role[:1] else (roles + "?", 0, "K", ()))
                steps += [(roles + x[0], 3 + more, "R", (f"{x}:{text}",)) for x in ("user", "assistant")]
            for end, cost, edit, lines in steps:
                if legal(end):
                    new.setdefault(folded(end), set()).update((c + cost, a + edit, d + lines) for c, a, d in options)
        # of options that end alike the cheapest can win, of ties the one whose whole audit is least: each
        # audit ends in a row's edit here, so none is the beginning of another
        best = {r: {min(options)} for r, options in new.items()}
    ends = [o for roles, options in inserted(best).items() if PATTERN.fullmatch(roles) for o in options]
    return min(ends)


def exhaustive(rows, named):
    """The same by trying every edit of every row, with up to two inserts anywhere."""
    best = None
    slots = ["", "I", "II"]
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(named, edits, strict=True)):
            continue
        for ins in itertools.product(slots, repeat=len(rows) + 1):
            cost = sum({"K": 0, "R": 3, "D": 4}[e] + (3 if f == "truncated" and e != "D" else 0) for e, f in zip(edits, named, strict=True)) + 3 * sum(map(len, ins))
            audit = "".join(i + e for i, e in zip(ins, [*edits, ""], strict=True))
            if best is not None and (cost, audit) >= best:
                continue
            kept = [role[:1] if e == "K" else "*" for (role, _), e in zip(rows, edits, strict=True)]
            shape = "".join("*" * len(i) + ("" if e == "D" else k) for i, e, k in zip(ins, [*edits, "D"], [*kept, ""], strict=True))
            if any(len(k) == 0 for k, e in zip(kept, edits, strict=True) if e != "D"):
                continue
            fits = any(
                len(p) == len(shape) and all(a == b or (a == "*" and b in "ua") for a, b in zip(shape, p, strict=True))
                for p in ("ua" * (len(shape) // 2), "s" + "ua" * (len(shape) // 2)) if p != "s"
            )
            if fits:
                best = (cost, audit)
    return best


def expected(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = damage([r for r in rows if r[0] == conv])
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in own if r[1] is not None]
        pairs = [(r[2], r[3]) for r in own]
        named = faults(pairs)
        cost, audit, lines = repairs(pairs, named)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, named.count("blank"), named.count("duplicate"),
            named.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def got(df):
    found = conversation_repair.repair(conversation_repair.damaged(df))
    return sorted((tuple(r)[:9] for r in found.collect()), key=str)


def searched(pairs):
    conv = conversation_repair.Conversation(1)
    for k, (role, text) in enumerate(pairs):
        conv.feed(k, role, text, text.strip(" \t\n\x0b\x0c\r")[-1:])
    return conv.result()


ROLES = ["user", "assistant", "system", "tool", "", "unknown"]


def random_pairs(rng, size, roles=ROLES):
    return [(rng.choice(roles), rng.choice(["Hi.", "Hi", "", " ", "Why?", f"t{rng.randrange(50)}.", f"t{rng.randrange(50)}"])) for _ in range(size)]


def test_plain_program_equals_trying_everything():
    rng = random.Random(1)
    for size in (0, 1, 1, 2, 2, 2, 3, 3, 3):
        for _ in range(6):
            pairs = random_pairs(rng, size)
            assert repairs(pairs, faults(pairs))[:2] == exhaustive(pairs, faults(pairs)), pairs


@pytest.mark.parametrize("roles", [ROLES, ["user"], ["assistant"], ["system", "user"], ["user", "assistant"], ["tool"]])
def test_search_equals_plain_program(roles):
    rng = random.Random(len(roles))
    for _ in range(250):
        pairs = random_pairs(rng, rng.randrange(14), roles)
        cost, audit, lines = repairs(pairs, faults(pairs))
        found = searched(pairs)
        assert (found[6], found[7]) == (cost, audit), pairs
        assert found[8] == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_open_rows_stay_few():
    """Survivors coalesce: a long conversation with faults is never held."""
    rng = random.Random(4)
    pairs = []
    for k in range(20_000):
        role = rng.choice(ROLES) if rng.random() < 0.1 else ("user", "assistant")[k % 2]
        pairs.append((role, rng.choice(["Hi.", "no end", ""]) if rng.random() < 0.1 else f"t{k}."))
    found = searched(pairs)
    assert found[9] == 20_000
    assert found[10] < 500
    # rows that must all go keep nothing open either
    assert searched([("user", "")] * 5000)[10] < 10
    # two readings that stay equally cheap are compared over all of their open rows
    tied = searched([("user", f"t{k}.") for k in range(301)])
    assert tied[6:8] == repairs([("user", f"t{k}.") for k in range(301)], [None] * 301)[:2]


def rows_of(rng, convs):
    rows = []
    for c in range(convs):
        for turn in range(rng.randrange(1, 12)):
            rows.append((c, None if rng.random() < 0.05 else turn + (rng.random() < 0.1), rng.choice([*ROLES, None]), rng.choice(["Hi. There.", "Hi", "", None, " \n", f"t{turn}!"])))
    return rows


def test_whole_tables(spark):
    rng = random.Random(7)
    rows = rows_of(rng, 150)
    rows += [(None, t, "user", "a.") for t in (None, 1, 2, 2)]
    rows += [(9999, t, ("user", "assistant")[t % 2], f"text {t}.") for t in range(900)]  # a third of all rows
    rows += [(8888, 0, "assistant", "x " * 200_000 + "end")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = expected(rows)
    assert got(frame) == want
    assert got(with_clashes(frame)) == want
    # conversations of which nothing is left
    gone = [c for c in range(5000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:5]
    empty = hashlib.sha256(b"").hexdigest()
    assert got(spark.createDataFrame([(c, 0, "user", "a.") for c in gone], SCHEMA)) == sorted(((c, 0, 0, 0, 0, 0, 0, "", empty) for c in gone), key=str)
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_query(spark):
    found = op13_survivor_viterbi(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)
