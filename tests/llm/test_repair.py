"""Operator 12 against all edits that are cheap enough, on many short conversations, and streamed long ones."""

import hashlib
import random
import zlib
from itertools import groupby

from annoframe.llm import repair

KIND = "conv_id long, turn long, role string, text string, fault string, nth long"


def faults(rows):
    """rows of (turn, role, text), in order: their faults."""
    seen, out = set(), []
    for _, role, text in rows:
        tail = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def brute(rows):
    """cost, audit, repaired text: of all edits that are no dearer than deleting everything, cheapest first, then by letters."""
    told, best = faults(rows), (4 * len(rows), "D" * len(rows), [])

    def go(at, state, cost, audit, out):
        nonlocal best
        if cost > best[0]:
            return
        if at == len(rows) and state in (0, 3) and (cost, audit) < best[:2]:
            best = (cost, audit, out)
        due = "assistant" if state == 2 else "user"
        then = 3 if state == 2 else 2
        go_on = [(at, then, cost + 3, audit + "I", out + [due + ":"])]
        if at < len(rows):
            _, role, text = rows[at]
            go_on.append((at + 1, state, cost + 4, audit + "D", out))
            if told[at] not in ("blank", "duplicate"):
                stay = cost + 3 * (told[at] == "truncated")
                go_on.append((at + 1, then, stay + 3, audit + "R", out + [f"{due}:{text}"]))
                if role[:1] == due[0] or role[:1] == "s" and state == 0:
                    go_on.append((at + 1, then if role[:1] == due[0] else 1, stay, audit + "K", out + [f"{role}:{text}"]))
        for x in go_on:
            go(*x)

    go(0, 0, 0, "", [])
    return best[0], best[1], "\n".join(best[2])


def expected(rows):
    told, turns = faults(rows), {t for t, _, _ in rows if t is not None}
    cost, audit, text = brute(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(told.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def test_against_all_edits(spark):
    rng, rows = random.Random(11), []
    for conv in range(400):
        for _ in range(rng.randint(1, 6)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""])
            rows.append((conv if conv else None, rng.choice([None, 0, 1, 2, 3, 4, 9]), role, rng.choice(["Yes.", "No", " \n", "One. ", "Ü!", "", "Why?\t", "x", "yes.", "two ."]), "clash", 7))
    got = {r.conv_id: tuple(r)[1:] for r in repair.digested(repair.repaired(spark.createDataFrame(rows, KIND).repartition(3))).collect()}
    for conv, own in groupby(sorted(rows, key=lambda r: r[0] or 0), key=lambda r: r[0]):
        assert got.pop(conv) == expected(ordered([r[1:4] for r in own])), conv
    assert not got


def test_long_conversations_keep_few_edits():
    """Survivors part and meet; what stays unresolved is short, and the cost is that of a plain table."""
    rng, walk = random.Random(2), repair.Survivors()
    most, total = 0, 0
    rows = [(k, rng.choice(["user", "assistant"]), f"text {k}" + rng.choice([".", ""]), None) for k in range(20_000)]
    rows = [(*r[:3], None if r[2][-1] == "." else "truncated") for r in rows]
    plain = {0: 0, 2: 3, 3: 6}
    for row in rows:
        total += sum(e[-1] for e in walk.take(row))
        most = max(most, len(walk.rows))
        more = 3 * (row[3] is not None)
        new = {s: c + 4 for s, c in plain.items()}
        for s, c in plain.items():
            to = 3 if s == 2 else 2
            new[to] = min(new.get(to, 10**9), c + more + (0 if row[1][0] == ("a" if s == 2 else "u") else 3))
        new[2] = min(new[2], new[0] + 3, new.get(3, 10**9) + 3)
        new[3] = min(new.get(3, 10**9), new[2] + 3)
        plain = new
    total += sum(e[-1] for e in walk.end())
    assert total == min(plain[0], plain[3]) and most < 100 and not walk.rows


def test_ties_are_compared_over_all_that_is_unresolved():
    for n in range(1, 9):
        rows = [(k, "user", f"{k}.") for k in range(n)]
        walk, edits = repair.Survivors(), []
        for turn, role, text in rows:
            edits += walk.take((turn, role, text, None))
        edits += walk.end()
        assert "".join(e[0] for e in edits) == brute(rows)[1]


def test_edits_in_order_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"{k % 50}." if k % 10 else "cut", "", 0) for k in range(500)]
        edits = repair.repaired(spark.createDataFrame(rows, KIND).repartition(4)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [e.nth for e in edits] == list(range(len(edits)))
    assert [e.turn for e in edits if e.edit != "I"] == list(range(500))
    assert {e.fault for e in edits if e.turn is not None and e.turn >= 50} == {"duplicate"}
    assert [e.old_role for e in edits if e.edit == "K"] == [e.role for e in edits if e.edit == "K"]


def test_damage(spark):
    rows = [(k, t, "system", "A b. C!", "", 0) for k in range(40) for t in range(5)] + [(None, None, None, None, "", 0)]
    got = sorted((str(r.conv_id), str(r.turn), r.role, r.text) for r in repair.damaged(spark.createDataFrame(rows, KIND)).collect())
    want = []
    for conv, turn, role, text, *_ in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else (text or " ").translate({ord(c): None for c in ".!?"}) if kind == 2 else text or " "
        want += [(str(conv), str(turn), "user" if kind == 4 else role or " ", text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(want)


def test_empty(spark):
    rows = spark.createDataFrame([], KIND)
    edits = repair.repaired(rows)
    assert edits.count() == 0 and repair.with_all(rows, repair.digested(edits)).count() == 0
    all_dropped = spark.createDataFrame([(5, 1, "user", "x", "", 0)], KIND)
    got = repair.with_all(all_dropped, repair.digested(edits)).collect()
    assert tuple(got[0]) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
