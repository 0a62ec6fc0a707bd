"""Conversation repair against an exhaustive search."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from ledgerloom.llm.conversations import ENDS, Joined, damaged, repair_reports, repaired_turns, solve

SCHEMA = "copies_of string, conv_id long, turn long, role string, text string, mark int, codes string"
BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")
WHOLE, BEGINNING = re.compile(r"(s?(ua)+)?\Z"), re.compile(r"s?(ua)*u?\Z")


def cheapest(rows):
    """(cost, audit, turns) of rows (role, text, has to go, truncated), by trying all edits."""
    best = None

    def go(i, cost, audit, out, inserts):
        nonlocal best
        initials = "".join(role[:1] or "?" for role, _ in out)
        if not BEGINNING.match(initials) or (best and cost > best[0]):
            return
        if i == len(rows) and WHOLE.match(initials) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, out)
        if i < len(rows):
            role, text, gone, late = rows[i]
            go(i + 1, cost + 4, audit + "D", out, 0)
            if not gone:
                go(i + 1, cost + 3 * late, audit + "K", [*out, (role, text)], 0)
                for other in ("user", "assistant"):
                    go(i + 1, cost + 3 + 3 * late, audit + "R", [*out, (other, text)], 0)
        if inserts < 3:
            for other in ("user", "assistant"):
                go(i, cost + 3, audit + "I", [*out, (other, "")], inserts + 1)

    go(0, 0, "", [], 0)
    return best


def damage(rows):
    """{conv_id: rows (turn, role, text) after damage}."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        number = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv] += [(turn, "user" if number == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(number, text))] * {0: 0, 3: 2}.get(number, 1)
    return out


def brute(conversations):
    for conv, rows in conversations.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, flagged, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in rows:
            fault = None
            if BLANK.match(text):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            flagged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, out = cheapest(flagged)
        text = "\n".join(f"{role}:{text}" for role, text in out)
        yield (conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), out


def invented(seed, conversations, most=6):
    pick = random.Random(seed)
    texts = ["Yes.", "No", "Well then!\n", "and", " ", "", None, "?", "long " * 50 + ".", "é…", "Yes. "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(pick.randint(1, most)):
            rows.append((conv, pick.choice([turn, turn, turn, 2 * turn, None]), pick.choice(roles), pick.choice(texts)))
    return rows + [(7, 0, "user", "Twice.")] * 3


def frame_of(spark, rows):
    return spark.createDataFrame([("x", *r, 1, "y") for r in rows], SCHEMA).repartition(3)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("run_rows", [1, 2, 512])
def test_reports_and_turns(spark, run_rows):
    rows = invented(3, 120)
    want = list(brute(damage(rows)))
    got = repair_reports(damaged(frame_of(spark, rows)), run_rows).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([w for w, _ in want], key=repr)
    turns = defaultdict(list)
    for r in sorted(repaired_turns(damaged(frame_of(spark, rows)), run_rows).collect(), key=lambda r: r.position):
        turns[r.conv_id].append((r.role, r.text))
    assert turns == {w[0]: out for w, out in want if out}


def test_undamaged_rows_need_no_copies_column(spark):
    rows = [(1, 0, "user", "A?"), (1, 1, "assistant", "B."), (1, 2, "user", "C.")]
    got = repair_reports(frame_of(spark, rows)).first()
    assert (got.cost, got.audit) == (3, "KKKI")


def test_nothing(spark):
    assert repair_reports(damaged(frame_of(spark, []).limit(0))).count() == 0
    assert repaired_turns(damaged(frame_of(spark, []).limit(0))).count() == 0


def test_a_conversation_of_dropped_rows_stays(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = repair_reports(damaged(frame_of(spark, [(5, turn, "user", "Hm.")]))).select(*COLUMNS).first()
    assert tuple(got) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_the_least_weight_is_the_least_repair():
    names = {"u": "user", "a": "assistant", "s": "system", "o": "tool", "x": "user"}
    pick = random.Random(1)
    for i in range(400):
        codes = "".join(pick.choice("uasoUASOx" if i % 2 else "uuaas") for _ in range(pick.randint(0, 5)))
        best = min(v for s, v in solve(codes).items() if s in ENDS)
        assert best == cheapest([(names[c.lower()], "t", c == "x", c.isupper()) for c in codes])[:2], codes


def test_runs_join_to_the_same_repair():
    pick = random.Random(2)
    for i in range(400):
        codes = "".join(pick.choice("uasoUASOx" if i % 2 else "uuuuas") for _ in range(pick.randint(1, 60)))
        joined, at = Joined(), 0
        while at < len(codes):
            size = pick.randint(1, 9)
            joined.add([(a, b, *v) for a in range(4) for b, v in solve(codes[at : at + size], a).items()])
            at += size
        cost, audits = joined.result()
        assert (cost, "".join(audits)) == min(v for s, v in solve(codes).items() if s in ENDS)


def test_a_long_conversation_spans_tasks(spark):
    rows = spark.range(30_000).selectExpr(
        "9L AS conv_id", "id AS turn", "CASE WHEN id % 7 = 0 THEN 'system' WHEN id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role",
        "concat('text ', id % 20000, CASE WHEN id % 5 = 0 THEN '' ELSE '.' END) AS text",
    )
    got = repair_reports(rows).first()
    codes = "".join(
        "x" if i >= 20_000 and _role(i) == _role(i - 20_000) else (_role(i)[0].upper() if i % 5 == 0 else _role(i)[0]) for i in range(30_000)
    )
    joined = Joined()
    for at in range(0, 30_000, 100):
        joined.add([(a, b, *v) for a in range(4) for b, v in solve(codes[at : at + 100], a).items()])
    cost, audits = joined.result()
    assert (got.cost, got.audit, got.gaps) == (cost, "".join(audits), 0)


def _role(i):
    return "system" if i % 7 == 0 else "user" if i % 2 == 0 else "assistant"
