"""Repair of conversations: the cheapest edits that make the roles read (s?(ua)+)?, and the least audit of them.

The search runs in layers of cost, as in approximate matching by bit-parallel automata: for each turn a word holds, for
each cost above the turn's least one, the set of grammar states from which the rest can be completed at that cost. An
edit of cost c moves a whole word c layers up, so all layers of a turn are computed by a few shifts and masks. The
first layer that has the start state is the cost. The audit is traced through the words from the start: of the edits
whose cost fits, the least letter. From any state the others are reached by two insertions or a deletion, so the least
costs of a turn's states lie within LAYERS and the words keep their size however long a conversation is: time is linear.

Equal rows of a conversation are counted first and stand next to each other, so a run of them is one step. Rows are then sorted
over the whole table by conversation and turn (a range partition, so a long conversation lies in many partitions). Each
partition solves the conversations that it has to itself. For a conversation in several partitions each gives the least
costs from any state at its begin to any at its end; these matrices, at most two a partition, are multiplied from the end;
then each part traces its own piece. SHA-256 has no parallel form: kept texts of such a conversation pass through
one task part by part, never all at once.

Null conv_id, turn, role or text reads as one space where a string is needed; null turns come first. Rows of the same turn
are ordered by role and text as they were before any damage. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Grammar states: nothing yet, after s, after u, after ua. The first and the last accept.
STATES, ACCEPTING = 4, (0, 3)
LAYERS = 16
_WORD = (1 << (STATES * LAYERS)) - 1
_AT = [sum(1 << (STATES * c + q) for c in range(LAYERS + 8)) for q in range(STATES)]
_NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: What the next letter of an inserted or changed row has to be in a state, and the state after it.
_WANTED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
BLANK = " \t\n\x0b\x0c\r"
#: Bytes of text in a range of the sorted rows.
RANGE_BYTES = 8 << 20
NONE, IS_BLANK, IS_DUPLICATE, IS_TRUNCATED = 0, 1, 2, 3
_FAR = 1 << 60


def _user(w: int) -> int:
    """States from which u leads into the states of w, layer by layer."""
    x = w & _AT[2]
    return x >> 2 | x >> 1 | x << 1


def _assistant(w: int) -> int:
    return (w & _AT[3]) >> 1


def _before(w: int, letter: str) -> int:
    return _user(w) if letter == "u" else _assistant(w) if letter == "a" else (w & _AT[1]) >> 1 if letter == "s" else 0


def _with_inserts(w: int) -> int:
    for _ in range(LAYERS // INSERT):
        w |= (_user(w) | _assistant(w)) << (STATES * INSERT)
    return w & _WORD


def _word(costs: list[int]) -> tuple[int, int]:
    """Least cost and word of the states' costs."""
    base = min(costs)
    return base, sum(1 << (STATES * (c - base) + q) for q, c in enumerate(costs) if c - base < LAYERS)


def costs_of(base: int, w: int) -> list[int]:
    """The least cost of each state; _FAR if there is none."""
    out = []
    for q in range(STATES):
        x = w & _AT[q]
        out.append(base + ((x & -x).bit_length() - 1) // STATES if x else _FAR)
    return out


def layers(rows: list[tuple[str, int, int]], end: list[int]) -> list[tuple[int, int]]:
    """For each row and the end (least cost, word of states). rows: role's first letter, fault, times; end: costs at the end."""
    base, w = _word(end)
    w = _with_inserts(w)
    out = [(base, w)]
    for letter, fault, times in reversed(rows):
        again = times if fault in (IS_BLANK, IS_DUPLICATE) else times - 1  # equal rows after the first are duplicates
        base += DELETE * again
        if fault not in (IS_BLANK, IS_DUPLICATE):
            more = TRUNCATED if fault == IS_TRUNCATED else 0
            w = w << (STATES * DELETE) | _before(w, letter) << (STATES * (KEEP + more)) | (_user(w) | _assistant(w)) << (STATES * (REROLE + more))
            low = ((w & -w).bit_length() - 1) // STATES
            base, w = base + low, _with_inserts(w >> (STATES * low) & _WORD)
        out.append((base, w))
    return out[::-1]


def trace(rows: list[tuple[str, int, int]], found: list[tuple[int, int]], state: int, last: bool) -> tuple[str, int, list]:
    """Audit, state at the end and (row, role or None to keep) of what stays; row is None for an insertion."""
    audit, kept = [], []
    i, cost = 0, [costs_of(*x) for x in found]
    while i < len(rows):
        letter, fault, times = rows[i]
        forced = fault in (IS_BLANK, IS_DUPLICATE)
        again = DELETE * (times - (not forced))  # the run's duplicates, which follow its first row
        here, after = cost[i][state], cost[i + 1]
        more = TRUNCATED if fault == IS_TRUNCATED else 0
        role, changed = _WANTED[state]
        to = _NEXT.get(letter, {}).get(state)
        if here == after[state] + again + (0 if forced else DELETE):
            audit.append("D" * times)
            i += 1
        elif here == cost[i][changed] + INSERT:
            audit.append("I")
            kept.append((None, role))
            state = changed
        elif to is not None and here == after[to] + again + KEEP + more:
            audit.append("K" + "D" * (times - 1))
            kept.append((i, None))
            state, i = to, i + 1
        else:
            audit.append("R" + "D" * (times - 1))
            kept.append((i, role))
            state, i = changed, i + 1
    while last and state not in ACCEPTING:
        role, state = _WANTED[state]
        audit.append("I")
        kept.append((None, role))
    return "".join(audit), state, kept


END = [0 if q in ACCEPTING else _FAR for q in range(STATES)]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of all rows after damage by crc32 of conv_id:turn modulo 20; of a dropped row n is 0.

    n: how often the row stands there. order_role, order_text: what they were, for the order within a turn.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role").alias("order_role"), said("text").alias("order_text"))
    rows = rows.groupBy("conv_id", "turn", "order_role", "order_text").agg(F.count("*").alias("n"))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("order_role"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("order_text", "[.!?]", "")).otherwise(F.col("order_text"))
    n = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, F.col("n") * 2).otherwise(F.col("n"))
    return rows.withColumn("kind", kind).withColumns({"role": role, "text": text, "n": n.cast("long")}).drop("kind")


def with_faults(rows: DataFrame) -> DataFrame:
    """rows and each one's first fault. A duplicate's earlier row is found by an aggregate over role and text, joined back."""
    end = F.rtrim("text", F.lit(BLANK))
    same = ["conv_id", "role", "said"]
    place = F.struct("turn", "order_role", "order_text")
    rows = rows.withColumns({"end": end, "said": F.sha2(F.col("text").cast("binary"), 256)})
    live = rows.where("n > 0 and end <> ''")
    first = live.groupBy(*same).agg(F.min(place).alias("first"), F.count("*").alias("m")).where("m > 1").drop("m")
    rows = rows.join(first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("said").alias("s"), "first"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("said") == F.col("s")), "left")
    fault = F.when(F.col("end") == "", IS_BLANK).when(F.col("first").isNotNull() & (place != F.col("first")), IS_DUPLICATE).when(~F.right("end", F.lit(1)).isin(".", "!", "?"), IS_TRUNCATED).otherwise(NONE)
    return rows.withColumn("fault", fault).drop("end", "said", "c", "r", "s", "first")


STATS = ["blank", "duplicate", "truncated", "illegal", "low", "high", "turns"]
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PIECE = RESULT + ", repaired string, block long, ends boolean, first string, last string, low long, high long, turns long, matrix array<long>"


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def piece_stats(rows: list[dict]) -> dict:
    """Counts of a conversation's rows that stand together, and what is needed to add those of its neighbours."""
    live = [r for r in rows if r["n"]]
    c: Counter = Counter()
    before = None
    for r in live:
        letter = r["role"][:1]
        c["blank"] += r["n"] if r["fault"] == IS_BLANK else 0
        c["duplicate"] += r["n"] if r["fault"] == IS_DUPLICATE else 0 if r["fault"] == IS_BLANK else r["n"] - 1
        c["truncated"] += r["fault"] == IS_TRUNCATED
        c["illegal"] += (before is not None and not _legal(before, letter)) + (r["n"] - 1) * (not _legal(letter, letter))
        before = letter
    turns = [r["turn"] for r in live if r["turn"] is not None]
    return {k: c[k] for k in ("blank", "duplicate", "truncated", "illegal")} | {"first": live[0]["role"][:1] if live else None, "last": before, "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns))}


def added(a: dict, b: dict) -> dict:
    """piece_stats of two neighbouring pieces as one."""
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += a["last"] is not None and b["first"] is not None and not _legal(a["last"], b["first"])
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    out["low"], out["high"] = (a["low"] if a["low"] is not None else b["low"]), (b["high"] if b["high"] is not None else a["high"])
    out["first"], out["last"] = (a["first"] if a["first"] is not None else b["first"]), (b["last"] if b["last"] is not None else a["last"])
    return out


def _gaps(s: dict) -> int:
    return 0 if s["low"] is None else s["high"] - s["low"] + 1 - s["turns"]


def _steps(rows: list[dict]) -> list[tuple[str, int, int]]:
    return [(r["role"][:1], r["fault"], r["n"]) for r in rows if r["n"]]


def _lines(rows: list[dict], kept: list) -> list[str]:
    live = [r for r in rows if r["n"]]
    return [f"{role}:" if i is None else f"{role or live[i]['role']}:{live[i]['text']}" for i, role in kept]


def matrix(rows: list[tuple[str, int, int]]) -> list[int]:
    """The least costs from each state before the rows to each state after them, row by row."""
    ends = [costs_of(*layers(rows, [0 if q == to else _FAR for q in range(STATES)])[0]) for to in range(STATES)]
    return [ends[to][q] for q in range(STATES) for to in range(STATES)]


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds[k]) for n, k in fields], [n for n, _ in fields])


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[list[dict]]:
    """Neighbouring rows that agree in by."""
    held: list[dict] = []
    for b in batches:
        for r in b.to_pylist():
            if held and any(r[c] != held[0][c] for c in by):
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def solved(rows: list[dict], memo: dict) -> dict:
    """The result of a conversation whose rows are all here."""
    steps = _steps(rows)
    known = tuple(steps) if len(steps) <= 16 else None
    if (found := memo.get(known)) is None or known is None:
        words = layers(steps, END)
        audit, _, kept = trace(steps, words, 0, True)
        found = costs_of(*words[0])[0], audit, kept
        if known is not None and len(memo) < 100_000:
            memo[known] = found
    s, lines = piece_stats(rows), "\n".join(_lines(rows, found[2]))
    return s | {"conv_id": rows[0]["conv_id"], "gaps": _gaps(s), "cost": found[0], "audit": found[1], "repaired": lines, "repaired_sha256": hashlib.sha256(lines.encode()).hexdigest()}


def solve_ranges(rows: DataFrame) -> DataFrame:
    """A row for each conversation of a block; those at a block's begin or end also as a piece, with its matrix. rows: sorted, with block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        out, of, group = [], None, None

        def close(g, ends):
            r = solved(g, memo) | {"block": g[0]["block"], "ends": ends}
            return r | {"matrix": matrix(_steps(g))} if ends else r

        for g in _groups(batches, ["block", "conv_id"]):
            if group is not None:
                out.append(close(group, group[0]["block"] != of or g[0]["block"] != group[0]["block"]))
                of = group[0]["block"]
            group = g
            if len(out) >= 2000:
                yield _batch(out, PIECE)
                out = []
        if group is not None:
            out.append(close(group, True))
        if out:
            yield _batch(out, PIECE)

    return rows.mapInArrow(run, PIECE)


def joined_pieces(pieces: list[dict]) -> tuple[dict, list[list[int]], list[dict]]:
    """Of a conversation's pieces in order: its counts and cost, the costs at each piece's end."""
    total = pieces[0]
    for p in pieces[1:]:
        total = added(total, p)
    ends, costs = [], END
    for p in reversed(pieces):
        ends.append(costs)
        m = p["matrix"]
        costs = [min(m[q * STATES + to] + costs[to] for to in range(STATES)) for q in range(STATES)]
        costs = [min(c, _FAR) for c in costs]
    return total | {"gaps": _gaps(total), "cost": costs[0]}, ends[::-1]


LINK = "conv_id long, block long, state long, last boolean, goal array<long>"


def repair(conversations: DataFrame) -> DataFrame:
    """Every conv_id with gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 and, if it lies in one range, repaired (the text)."""
    spark = conversations.sparkSession
    store = common.Durable(spark, "repair")
    rows = store.put(with_faults(damaged(conversations)))
    size = rows.agg(F.sum(F.octet_length("text") + F.octet_length("role") + 64)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // RANGE_BYTES))
    order = ["conv_id", "turn", "order_role", "order_text"]
    # rows that share their key in all columns were merged, so the ranges can cut any conversation
    spread = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    spread = store.put(spread.withColumn("block", F.spark_partition_id().cast("long")).drop("order_text", "order_role").withColumn("at", F.monotonically_increasing_id()))
    ordered = spread.repartition(parts, "block").sortWithinPartitions("at")
    pieces = store.put(solve_ranges(ordered.select("block", "conv_id", "turn", "role", "text", "n", "fault")))
    ends = pieces.where("ends")  # two for each range at most
    cut = ends.groupBy("conv_id").agg(F.count("*").alias("m")).where("m > 1").select(F.col("conv_id").alias("c"))
    cut = store.put(cut)
    whole = pieces.join(store.light(cut), F.col("conv_id").eqNullSafe(F.col("c")), "left_anti")
    columns = [f.split()[0] for f in RESULT.split(", ")]
    whole = whole.select(*columns, "repaired")
    if cut.isEmpty():
        return whole
    return whole.unionByName(_repair_long(store, ordered, ends, cut).select(*columns, F.lit(None).cast("string").alias("repaired")))


def _repair_long(store: common.Durable, ordered: DataFrame, ends: DataFrame, cut: DataFrame) -> DataFrame:
    """Conversations that lie in several ranges."""
    own = F.col("conv_id").eqNullSafe(F.col("c"))
    light = F.col("conv_id").alias("c2"), F.col("block").alias("b2")
    numbers = ["conv_id", "block", *STATS, "first", "last", "matrix"]

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, ["conv_id"]):
            total, goals = joined_pieces(g)
            yield _batch([total | {"conv_id": g[0]["conv_id"], "block": p["block"], "goal": goal, "last": p is g[-1], "first": p is g[0]} for p, goal in zip(g, goals, strict=True)], TOTAL)

    TOTAL = "conv_id long, block long, goal array<long>, last boolean, first boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    tasks = int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    known = ends.join(store.light(cut), own, "left_semi").select(numbers).repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "block")
    known = store.put(known.mapInArrow(costs, TOTAL))
    mine = ordered.join(store.light(known).select(*light, "goal", "last", "first"), F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("block") == F.col("b2")))
    mine = store.put(mine.select("conv_id", "block", "at", "turn", "role", "text", "n", "fault", "goal", F.col("last").alias("is_last"), F.col("first").alias("is_first")))

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, ["conv_id", "block"]):
            steps = _steps(g)
            words = layers(steps, g[0]["goal"])
            to = [trace(steps, words, q, False)[1] if costs_of(*words[0])[q] < _FAR else -1 for q in range(STATES)]
            yield _batch([{"conv_id": g[0]["conv_id"], "block": g[0]["block"], "to": to}], "conv_id long, block long, to array<long>")

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, ["conv_id"]):
            state, out = 0, []
            for p in g:
                out.append({"conv_id": p["conv_id"], "block": p["block"], "state": state})
                state = p["to"][state]
            yield _batch(out, "conv_id long, block long, state long")

    by_piece = mine.repartition(tasks, "conv_id", "block").sortWithinPartitions("conv_id", "block", "at")
    begins = by_piece.mapInArrow(moves, "conv_id long, block long, to array<long>").repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(states, "conv_id long, block long, state long")
    begins = store.put(begins)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, ["conv_id", "block"]):
            steps = _steps(g)
            audit, _, kept = trace(steps, layers(steps, g[0]["goal"]), g[0]["state"], g[0]["is_last"])
            lines = _lines(g, kept)
            yield _batch([{"conv_id": g[0]["conv_id"], "block": g[0]["block"], "audit": audit, "lines": "\n".join(lines) if lines else None}], "conv_id long, block long, audit string, lines string")

    with_state = mine.join(store.light(begins).select(*light, "state"), F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("block") == F.col("b2"))).drop("c2", "b2")
    said = with_state.repartition(tasks, "conv_id", "block").sortWithinPartitions("conv_id", "block", "at").mapInArrow(texts, "conv_id long, block long, audit string, lines string")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            for r in b.to_pylist():
                if held is None or held[0] != r["conv_id"]:
                    if held:
                        yield close(held)
                    held = (r["conv_id"], [], hashlib.sha256(), [])
                held[1].append(r["audit"])
                if r["lines"] is not None:
                    held[2].update(("\n" if held[3] else "").encode() + r["lines"].encode())
                    held[3][:] = [True]
        if held:
            yield close(held)

    def close(held) -> pa.RecordBatch:
        return _batch([{"c2": held[0], "audit": "".join(held[1]), "repaired_sha256": held[2].hexdigest()}], "c2 long, audit string, repaired_sha256 string")

    done = said.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(digests, "c2 long, audit string, repaired_sha256 string")
    return known.where("first").join(done, F.col("conv_id").eqNullSafe(F.col("c2")))


def repaired(conversations: DataFrame) -> DataFrame:
    """repair without the texts."""
    return repair(conversations).drop("repaired")
