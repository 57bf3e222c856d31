"""Repair the structure of conversations by the cheapest edits, with Hirschberg's divide and conquer.

A conversation's roles, read as initials, must form ``(s?(ua)+)?``. Reading left to right, four states
suffice: START, after ``s``, after ``u``, after ``a``. Forward and backward vectors of four costs meet in the
middle; of the crossings with the least cost the one whose audit is the least is taken, and both halves are
solved the same way, in space that grows with the rows alone.

Rows are sorted over all partitions by conversation and turn. A conversation's stretch within a partition is
a segment; a segment is known from outside by its costs between the four states at its ends. The same meeting
in the middle, over segments, fixes the states at their borders, then every segment is solved by itself.
Only the digest of a repaired conversation reads its texts one after the other, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gneiss.llm.common import stored

START, S, U, A = range(4)
STATES = range(4)
INF = 1 << 60
#: State reached by keeping a row of an initial, and by putting a user or assistant there.
KEEP = {"s": {START: S}, "u": {START: U, S: U, A: U}, "a": {U: A}}
NEXT = {START: U, S: U, A: U, U: A}
ROLE = {U: "user", A: "assistant"}
#: Class of a row: 8 must go, else 2 times its initial's place here and 1 if truncated.
INITIALS, GONE = "sua?", 8

WHITE = r"[\x20\x09-\x0D]"


class Step:
    """The least (cost, audit) of getting from each state to each state across one or more rows.

    Audits stand in ``rank``: of two audits from one state the one with the smaller rank is ASCII-less.
    All audits from a state consume the same rows, so none begins another.
    """

    __slots__ = ("cost", "rank", "text")

    def __init__(self, cost: list, rank: list, text: list | None = None):
        self.cost, self.rank, self.text = cost, rank, text


def _row_step(row_class: int) -> Step:
    """Inserts before a row and what becomes of it. Inserts before a deletion could as well follow it, which is ASCII-less."""
    cost, text = [[INF] * 4 for _ in STATES], [[""] * 4 for _ in STATES]
    for p in STATES:
        found = [(3, "D", p)]
        at = p
        for inserts in range(3):
            if row_class != GONE:
                own = INITIALS[row_class // 2]
                if at in KEEP.get(own, {}):
                    found.append((2 * inserts + row_class % 2, "I" * inserts + "K", KEEP[own][at]))
                found.append((2 * inserts + 2 + row_class % 2, "I" * inserts + "R", NEXT[at]))
            at = NEXT[at]
        for c, t, q in found:
            if (c, t) < (cost[p][q], text[p][q]) or cost[p][q] == INF:
                cost[p][q], text[p][q] = c, t
    rank = [[sorted(row).index(x) for x in row] for row in text]
    return Step(cost, rank, text)


ROWS = [_row_step(c) for c in range(9)]
#: Inserts behind the last row: cost and audit, by state.
END_COST, END_TEXT = [0, 4, 2, 0], ["", "II", "I", ""]


def forward(steps: list, lo: int, hi: int, state: int) -> tuple[list, list]:
    """The least cost from ``state`` to every state across steps ``lo`` to ``hi``, and the order of their audits."""
    cost, rank = [INF] * 4, [0] * 4
    cost[state] = 0
    for i in range(lo, hi):
        step = steps[i]
        best = []
        for q in STATES:
            best.append(min((cost[p] + step.cost[p][q], rank[p], step.rank[p][q]) for p in STATES))
        cost = [min(b[0], INF) for b in best]
        order = sorted({b[1:] for b in best})
        rank = [order.index(b[1:]) for b in best]
    return cost, rank


def backward(steps: list, lo: int, hi: int, cost: list) -> list:
    """The least cost from every state before step ``lo`` to the end, given the costs behind step ``hi - 1``."""
    for i in range(hi - 1, lo - 1, -1):
        across = steps[i].cost
        cost = [min(INF, min(across[p][q] + cost[q] for q in STATES)) for p in STATES]
    return cost


def crossings(steps: list, first: int, last: list) -> list[int]:
    """The state before every step and behind the last of the audit-least of the cheapest ways.

    ``last`` has the cost of ending in each state.
    """
    out = [first] * (len(steps) + 1)
    todo = [(0, len(steps), first, last)]
    while todo:
        lo, hi, state, end = todo.pop()
        mid = hi if hi - lo < 2 else (lo + hi) // 2
        cost, rank = forward(steps, lo, mid, state)
        rest = backward(steps, mid, hi, end)
        out[mid] = cross = min(STATES, key=lambda q: (cost[q] + rest[q], rank[q]))
        if mid < hi:
            todo.append((mid, hi, cross, end))
        if mid - lo > 1:
            todo.append((lo, mid, state, [0 if q == cross else INF for q in STATES]))
    return out


def joined(steps: list) -> Step:
    """Several steps as one."""
    ways = [forward(steps, 0, len(steps), p) for p in STATES]
    return Step([c for c, _ in ways], [r for _, r in ways])


def edits(classes: bytes, first: int, last: int) -> list[tuple[str, int]]:
    """For each row its part of the audit and the state before it, for given states at both ends."""
    steps = [ROWS[c] for c in classes]
    states = crossings(steps, first, [0 if q == last else INF for q in STATES])
    return [(step.text[p][q], p) for step, p, q in zip(steps, states, states[1:])]


def pieces(audit: str, state: int, role: str, text: str) -> tuple[list[str], int]:
    """The repaired ``role:text`` pieces of a part of an audit, and the state behind it."""
    out = []
    for letter in audit:
        if letter == "D":
            continue
        if letter == "K":
            state = KEEP[role[:1]][state]
            out.append(f"{role}:{text}")
        else:
            state = NEXT[state]
            out.append(f"{ROLE[state]}:{text if letter == 'R' else ''}")
    return out, state


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after the faults that ``crc32(conv_id:turn) % 20`` names; a dropped row stays with a null role.

    A null is one space, in the hashed string and in role and text.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    named = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 part("role").alias("role"), part("text").alias("text"),
                                 (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").when(F.col("fault") != 0, F.col("role"))
    return named.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"))


#: What sorts the rows of a conversation; rows that agree in all are equal.
ORDER = ["conv_null", "conv", "numbered", "turn", "role", "h1", "h2"]
KEYS = ("conv_null boolean, conv long, numbered boolean, turn long, role string, h1 long, h2 long")
SEGMENT = ("conv_null boolean, conv long, part int, classes binary, keys array<struct<numbered:boolean,turn:long,role:string,h1:long,h2:long,copies:long>>, "
           "counts array<long>, ends array<string>, cost array<array<long>>, rank array<array<long>>")
SOLVED = "conv_null boolean, conv long, part int, first int, last int, tail boolean, stats array<long>"
EDIT = f"{KEYS}, phase int, audit string, state int, copies long"
OUT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def slim(rows: DataFrame) -> DataFrame:
    """Rows without their texts, equal ones once with their number, and whether each is blank, truncated or seen earlier.

    Texts are compared by 128 bits of hashes. What is counted is summed before it is shuffled, so a common row is no hot key.
    """
    keyed = keyed_rows(rows)
    once = keyed.groupBy(*ORDER).agg(F.sum("copies").cast("long").alias("copies"),
                                     F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    same = ["conv_null", "conv", "role", "h1", "h2"]
    earliest = keyed.groupBy(*same).agg(F.min(F.struct("numbered", "turn")).alias("earliest"))
    return once.join(earliest, same).withColumn("repeated", F.struct("numbered", "turn") != F.col("earliest")).drop("earliest")


def keyed_rows(rows: DataFrame) -> DataFrame:
    """Rows with the columns of ``ORDER``; nulls are told apart by a flag, so that keys compare plainly."""
    mark = lambda c: F.col(c).isNull().alias(f"{c.removesuffix('_id')}_null")
    value = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c.removesuffix("_id"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return rows.where("role IS NOT NULL").select(
        mark("conv_id"), value("conv_id"), F.col("turn").isNotNull().alias("numbered"), value("turn"), "role",
        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("text"), "text").alias("h2"), "copies",
        blank.alias("blank"), (~F.col("text").rlike(rf"[.!?]{WHITE}*\z")).alias("truncated"), "text")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of a sorted partition: its rows' classes and keys, what it counts, and its costs."""
    schema = pa.schema([
        ("conv_null", pa.bool_()), ("conv", pa.int64()), ("part", pa.int32()), ("classes", pa.binary()),
        ("keys", pa.list_(pa.struct([("numbered", pa.bool_()), ("turn", pa.int64()), ("role", pa.string()), ("h1", pa.int64()), ("h2", pa.int64()), ("copies", pa.int64())]))),
        ("counts", pa.list_(pa.int64())), ("ends", pa.list_(pa.string())), ("cost", pa.list_(pa.list_(pa.int64()))), ("rank", pa.list_(pa.list_(pa.int64())))])

    def segment(rows: list[dict]) -> dict:
        classes, blank, duplicate, truncated, illegal, turns, before = bytearray(), 0, 0, 0, 0, 0, None
        for r in rows:
            copies = r["copies"]
            gone = r["blank"] or r["repeated"]
            classes.append(GONE if gone else 2 * (INITIALS.find(r["role"][:1] or "?") % 4) + r["truncated"])
            blank += copies if r["blank"] else 0
            duplicate += 0 if r["blank"] else copies - (not r["repeated"])
            truncated += not gone and r["truncated"]
            own = r["role"][:1]
            illegal += before is not None and before["role"][:1] + own not in ("su", "ua", "au")
            illegal += copies - 1  # two of a kind are never legal neighbours
            if r["numbered"]:
                turns += before is None or not before["numbered"] or before["turn"] != r["turn"]
            before = r
        whole = joined([ROWS[c] for c in classes])
        numbered = [r["turn"] for r in rows if r["numbered"]]
        low, high = (numbered[0], numbered[-1]) if numbered else (None, None)
        extra = sum(r["copies"] - 1 for r in rows)
        return {"conv_null": rows[0]["conv_null"], "conv": rows[0]["conv"], "part": rows[0]["part"], "classes": bytes(classes), "keys": rows,
                "counts": [blank, duplicate, truncated, illegal, turns, low, high, extra], "ends": [rows[0]["role"][:1], rows[-1]["role"][:1]],
                "cost": whole.cost, "rank": whole.rank}

    out, held, rows = [], 0, []
    for batch in batches:
        for r in batch.to_pylist():
            if rows and (r["conv_null"], r["conv"]) != (rows[0]["conv_null"], rows[0]["conv"]):
                out.append(segment(rows))
                held += len(rows)
                rows = []
                if held > 5000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
            rows.append(r)
    if rows:
        out.append(segment(rows))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states at both ends of each segment, and on a conversation's last segment what it counts in all."""
    schema = pa.schema([("conv_null", pa.bool_()), ("conv", pa.int64()), ("part", pa.int32()), ("first", pa.int32()), ("last", pa.int32()),
                        ("tail", pa.bool_()), ("stats", pa.list_(pa.int64()))])

    def solve(rows: list[dict]) -> list[dict]:
        steps = [Step(r["cost"], r["rank"]) for r in rows]
        states = crossings(steps, START, END_COST)
        cost = sum(s.cost[p][q] for s, p, q in zip(steps, states, states[1:])) + END_COST[states[-1]]
        blank, duplicate, truncated, illegal, turns = (sum(r["counts"][k] for r in rows) for k in range(5))
        for one, two in zip(rows, rows[1:]):
            illegal += one["ends"][1] + two["ends"][0] not in ("su", "ua", "au")
            turns -= one["counts"][6] is not None and one["counts"][6] == two["counts"][5]
        numbered = [r["counts"] for r in rows if r["counts"][5] is not None]
        gaps = numbered[-1][6] - numbered[0][5] + 1 - turns if numbered else 0
        cost += 3 * sum(r["counts"][7] for r in rows)
        last = len(rows) - 1
        return [{"conv_null": r["conv_null"], "conv": r["conv"], "part": r["part"], "first": states[i], "last": states[i + 1], "tail": i == last,
                 "stats": [gaps, blank, duplicate, truncated, illegal, cost] if i == last else None} for i, r in enumerate(rows)]

    out, rows = [], []
    for batch in batches:
        for r in batch.to_pylist():
            if rows and (r["conv_null"], r["conv"]) != (rows[0]["conv_null"], rows[0]["conv"]):
                out += solve(rows)
                rows = []
                if len(out) > 5000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            rows.append(r)
    if rows:
        out += solve(rows)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row of solved segments its part of the audit; behind the last row the inserts that end the conversation."""
    names = [*ORDER, "phase", "audit", "state", "copies"]
    kinds = [pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64()]
    for batch in batches:
        for r in batch.to_pylist():
            conv = r["conv_null"], r["conv"]
            out = [(*conv, k["numbered"], k["turn"], k["role"], k["h1"], k["h2"], 1, audit, state, k["copies"])
                   for k, (audit, state) in zip(r["keys"], edits(r["classes"], r["first"], r["last"]))]
            if r["tail"]:
                out.append((*conv, False, 0, "", 0, 0, 2, END_TEXT[r["last"]], r["last"], 1))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition, streamed: per conversation a header, each row's edit before its texts, and the end."""
    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in OUT.split(", ")])
    out, conv = [], None

    def close() -> None:
        out.append((*conv, "".join(audit), digest.hexdigest()))

    def add(parts: list[str]) -> None:
        nonlocal begun
        for part in parts:
            digest.update(b"\n" * begun + part.encode())
            begun = True

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_null", "conv", "phase", "kind", "audit", "state", "copies", "role", "text", "stats")]
        for is_null, own, phase, kind, letters, state, copies, role, text, stats in zip(*columns):
            if phase == 0:
                if kind == 0:  # the original conversation; what is counted follows unless no row is left
                    if conv is not None:
                        close()
                        if len(out) > 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                            out = []
                    conv, audit, digest, begun, edit = (None if is_null else own, 0, 0, 0, 0, 0, 0), [], hashlib.sha256(), False, None
                else:
                    conv = (conv[0], *stats)
            elif kind == 0:
                edit = letters, state
                audit.append(letters + "D" * (copies - 1))
                if phase == 2:
                    add(pieces(letters, state, "", "")[0])
            elif edit is not None:  # the first of equal rows has their text
                add(pieces(*edit, role, text)[0])
                edit = None
    if conv is not None:
        close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def repair(damaged: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    ``damaged`` has conv_id, turn, role, text and copies (adjacent repeats of a row); a null role marks a
    conversation of which that row is gone. Rows go by turn, nulls first, and among equal turns by role and a hash
    of the text; equal rows of a turn are neighbours. Null conv_ids are one conversation. A conversation without
    rows has zeros, an empty audit and the digest of the empty string. An empty table gives no rows.
    """
    rows = stored(damaged, "damaged")
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = slim(rows).repartitionByRange(width, *ORDER).sortWithinPartitions(*ORDER).withColumn("part", F.spark_partition_id())
    segments = stored(ordered.mapInArrow(_segments, SEGMENT), "segments")
    heads = segments.select("conv_null", "conv", "part", "counts", "ends", "cost", "rank").repartition(width, "conv_null", "conv")
    solved = stored(heads.sortWithinPartitions("conv_null", "conv", "part").mapInArrow(_solved, SOLVED), "solved")
    found = segments.select("conv_null", "conv", "part", "classes", "keys").join(solved.drop("stats"), ["conv_null", "conv", "part"])
    edit = found.mapInArrow(_edited, EDIT)

    none = lambda kind: F.lit(None).cast(kind)
    key = [F.lit(False).alias("numbered"), F.lit(0).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2")]
    shape = [*ORDER, "phase", "kind", "audit", "state", "copies", "text", "stats"]

    def shaped(df: DataFrame, **columns: Column) -> DataFrame:
        kinds = {"audit": "string", "state": "int", "copies": "long", "text": "string", "stats": "array<long>"}
        return df.withColumns({c: none(t) for c, t in kinds.items() if c not in df.columns} | columns).select(*shape)

    originals = rows.select(F.col("conv_id").isNull().alias("conv_null"), F.coalesce("conv_id", F.lit(0)).alias("conv")).distinct()
    stream = shaped(originals.select("*", *key), phase=F.lit(0), kind=F.lit(0))
    stream = stream.union(shaped(solved.where("tail").select("conv_null", "conv", "stats", *key), phase=F.lit(0), kind=F.lit(1)))
    stream = stream.union(shaped(edit, kind=F.lit(0)))
    stream = stream.union(shaped(keyed_rows(rows).select(*ORDER, "text"), phase=F.lit(1), kind=F.lit(1)))
    stream = stream.repartition(width, "conv_null", "conv").sortWithinPartitions("conv_null", "conv", "phase", *ORDER[2:], "kind")
    return stream.mapInArrow(_digested, OUT)
