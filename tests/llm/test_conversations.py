"""op11 against a plain search over edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest

from eventloom.llm import conversation_repair as C

BLANK = " \t\n\x0b\x0c\r"


def plain_repair(steps):
    """(cost, audit, roles kept) by a search over all edits: rows are (letter, forced, truncated)."""
    n = len(steps)
    nxt = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @cache
    def best(i, q, inserted):
        """Least (cost, audit, ((row, role), ...)) from here; at most three insertions in a row are ever of use."""
        out = []
        if i == n:
            if q in (0, 3):
                out.append((0, "", ()))
        else:
            letter, forced, truncated = steps[i]
            if x := best(i + 1, q, 0):
                out.append((x[0] + 2, "D" + x[1], x[2]))
            if not forced:
                for role in (None, "user", "assistant"):
                    to = nxt.get((q, letter if role is None else role[0]))
                    if to is not None and (x := best(i + 1, to, 0)):
                        out.append((x[0] + (role is not None) + 5 * truncated, ("K" if role is None else "R") + x[1], ((i, role), *x[2])))
        if inserted < 3:
            for role in ("user", "assistant"):
                to = nxt.get((q, role[0]))
                if to is not None and (x := best(i, to, inserted + 1)):
                    out.append((x[0] + 5, "I" + x[1], ((None, role), *x[2])))
        return min(out, key=lambda x: x[:2]) if out else None

    return best(0, 0, 0)


def plain(rows):
    """The contract, row by row. rows: (conv_id, turn, role, text)."""
    said = lambda v: " " if v is None else str(v)
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, said(role), said(text)))
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        live = []
        for turn, role, text in own:
            kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            live += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        turns = [t for t, _, _ in live if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, steps, count = set(), [], [0, 0, 0]
        for _, role, text in live:
            end = text.rstrip(BLANK)
            fault = 0 if not end else 1 if (role, text) in seen else 2 if end[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                count[fault] += 1
            steps.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(steps, steps[1:]))
        cost, audit, kept = plain_repair(tuple(steps))
        lines = [f"{role}:" if i is None else f"{role or live[i][1]}:{live[i][2]}" for i, role in kept]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out.append((conv, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def table(seed, conversations, longest, ties=False):
    rng = random.Random(seed)
    out = []
    for c in [None, *range(conversations)]:
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, t + 1, None]) if ties else t
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None] if t % 3 == 0 else ["user", "assistant"])
            out.append((c, turn, role, rng.choice(["Yes.", "No!", "so", "é?\n", "", " \t", None, "a. b", f"t{t}.", f"t{t}"])))
            if ties and rng.random() < 0.2:
                out += [out[-1]] * rng.randint(1, 3)
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("ties", [False, True])
def test_repair_is_the_plain_search(spark, ties):
    rows = table(3 + ties, 150, 9, ties)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as cost", "'x' as audit", "0 as n")
    got = C.repaired(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert rows_of(got) == sorted(plain(rows), key=repr)


def test_a_conversation_in_many_ranges(spark, monkeypatch):
    """Conversations with more rows than a range holds; one of equal rows only."""
    monkeypatch.setattr(C, "RANGE_BYTES", 3000)
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Yes.", "no", f"{t}!", f"{t}", ""])) for t in range(400)]
    rows += [(8, t // 2, rng.choice(["user", "assistant"]), rng.choice([f"{t}.", f"{t}"])) for t in range(300)]
    rows += [(9, 1, "user", "same.")] * 200 + table(6, 20, 6)
    assert rows_of(C.repaired(spark.createDataFrame(rows, SCHEMA))) == sorted(plain(rows), key=repr)


def test_repair_of_the_table(spark, documents):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert rows_of(C.repaired(df)) == sorted(plain([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]), key=repr)


def test_repair_of_nothing(spark):
    assert C.repaired(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    assert rows_of(C.repaired(spark.createDataFrame([(5, gone, "user", "x.")], SCHEMA))) == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_layers_and_matrix_are_the_plain_costs():
    rng = random.Random(9)
    for _ in range(300):
        steps = [(rng.choice("suuaax"), rng.choice([0, 0, 0, 1, 2, 3]), rng.choice([1, 1, 1, 3])) for _ in range(rng.randint(0, 12))]
        flat = tuple((letter, fault in (1, 2) or k > 0, fault == 3) for letter, fault, times in steps for k in range(times))
        found = C.layers(steps, C.END)
        audit, state, _ = C.trace(steps, found, 0, True)
        assert (C.costs_of(*found[0])[0], audit) == plain_repair(flat)[:2]
        cut = rng.randint(0, len(steps))
        a, b = C.matrix(steps[:cut]), C.matrix(steps[cut:])
        assert min(a[q] + b[4 * q + e] for q in range(4) for e in (0, 3)) == C.costs_of(*found[0])[0]
