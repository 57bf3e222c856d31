"""The repair equals a search over all edits; the rows go through Spark in a few partitions."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from gneiss.llm import conversations as c

COLUMNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
NAMES = [x.split()[0] for x in c.OUT.split(", ")]


def cheapest(kinds):
    """(cost, audit) over all edits of rows (initial, must go, truncated), by trying every first edit."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, state, inserted):
        found = [(0, "")] if i == len(kinds) and state in ("", "a") else []
        if inserted < 4:
            for x in "ua":
                if x in legal[state]:
                    n, audit = best(i, x, inserted + 1)
                    found.append((n + 2, "I" + audit))
        if i < len(kinds):
            initial, gone, cut = kinds[i]
            n, audit = best(i + 1, state, 0)
            found.append((n + 3, "D" + audit))
            if not gone:
                if initial in "sua" and initial in legal[state]:
                    n, audit = best(i + 1, initial, 0)
                    found.append((n + cut, "K" + audit))
                for x in "ua":
                    if x in legal[state]:
                        n, audit = best(i + 1, x, 0)
                        found.append((n + cut + 2, "R" + audit))
        return min(found, default=(10**9, ""))

    for i in range(len(kinds), 0, -100):
        best(i, "", 0)
    return best(0, "", 0)


def applied(audit, rows):
    """The repaired pieces; the grammar tells the role of every changed row."""
    out, left, before = [], list(rows), ""
    for letter in audit:
        role = "assistant" if before == "u" else "user"
        if letter == "I":
            out.append(f"{role}:")
        else:
            own, text = left.pop(0)
            if letter == "D":
                continue
            role = own if letter == "K" else role
            out.append(f"{role}:{text}")
        before = role[0]
    assert not left and re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    return "\n".join(out)


def brute(rows):
    white = "\x20\x09-\x0d"
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        text, role = (" " if x is None else x for x in (text, role))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        kept += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, kinds, counts = set(), [], [0, 0, 0]
        for _, role, text in kept:
            blank = not re.search(f"[^{white}]", text)
            again = not blank and (role, text) in seen
            cut = not blank and not again and re.sub(f"[{white}]+$", "", text)[-1] not in ".!?"
            seen.add((role, text))
            counts = [a + b for a, b in zip(counts, (blank, again, cut))]
            kinds.append((role[:1] if role[:1] in list("sua") else "?", blank or again, int(cut)))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit = cheapest(tuple(kinds))
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(applied(audit, [r[1:] for r in kept]).encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(rng, n_convs, turns):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "System"]
    texts = ["Yes.", "No", "Why? ", "", "  ", None, "Go on!\n", "a.b", "Yes.", " "]
    rows = []
    for conv in range(n_convs):
        for turn in range(rng.randint(1, turns)):
            if rng.random() < 0.93:
                alternate = ["user", "assistant"][turn % 2]
                # One row at most of a conversation has no turn, so that no order is left to hashes.
                turn = turn if rng.random() < 0.97 or any(r[:2] == (conv, None) for r in rows) else None
                rows.append((conv, turn, alternate if rng.random() < 0.6 else rng.choice(roles), rng.choice(texts + [f"t{turn}."] * 6)))
    return rows


@pytest.mark.parametrize("seed", range(40))
def test_meeting_in_the_middle_equals_all_edits(seed):
    rng = random.Random(seed)
    for _ in range(25):
        classes = bytes(rng.choices(range(9), k=rng.randint(0, 14)))
        kinds = tuple((c.INITIALS[x // 2] if x != c.GONE else "u", x == c.GONE, 0 if x == c.GONE else x % 2) for x in classes)
        steps = [c.ROWS[x] for x in classes]
        cut = sorted(rng.choices(range(len(classes) + 1), k=3))
        bounds = [a for a in zip([0, *cut], [*cut, len(classes)]) if a[0] < a[1]]
        parts = [c.joined(steps[i:j]) for i, j in bounds]
        states = c.crossings(parts, c.START, c.END_COST)
        audit = "".join(t for (i, j), p, q in zip(bounds, states, states[1:]) for t, _ in c.edits(classes[i:j], p, q)) + c.END_TEXT[states[-1]]
        cost = sum(x.cost[p][q] for x, p, q in zip(parts, states, states[1:])) + c.END_COST[states[-1]]
        assert (cost, audit) == cheapest(kinds)


def test_conversations_equal_brute_force(spark, rows):
    source = random_rows(random.Random(12), 120, 12)
    got = rows(c.repair(c.damage(spark.createDataFrame(source, COLUMNS).repartition(3))), *NAMES)
    assert got == brute(source)
    assert {"D", "I", "K", "R"} <= set("".join(r[7] for r in got))


def test_a_long_conversation_spans_partitions(spark, rows):
    rng = random.Random(8)
    source = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"line {t}.", f"cut {t}"])) for t in range(900)] + random_rows(rng, 5, 6)
    source = [r for r in source if r[0] == 7] + [(r[0] + 100, *r[1:]) for r in source if r[0] != 7]
    damaged = c.damage(spark.createDataFrame(source, COLUMNS).repartition(5))
    parts = c.slim(damaged).repartitionByRange(4, *c.ORDER).select("conv", c.F.spark_partition_id().alias("part")).where("conv = 7").distinct().count()
    assert parts > 1
    assert rows(c.repair(damaged), *NAMES) == brute(source)


def test_odd_rows(spark, rows):
    source = [(None, None, None, None), (None, 3, "user", "Hi."), (1, None, "user", "A."), (1, None, "system", "B."), (1, 2, "assistant", "C"), (1, 2, "assistant", "C"),
              (2, 5, "user", "long " * 50_000 + "."), (3, 1, "", ""), (4, 9, "user", "Same."), (4, 9, "user", "Same."), (4, 9, "user", "Same.")]
    # A conversation of which every row is dropped.
    gone = next(i for i in range(10, 10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    source.append((gone, 0, "user", "x."))
    table = spark.createDataFrame(source, COLUMNS).withColumn("part", c.F.lit("x")).withColumn("copies", c.F.lit("y"))
    got = rows(c.repair(c.damage(table)), *NAMES)
    assert got == brute(source)
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got
    assert c.repair(c.damage(table.limit(0))).count() == 0
