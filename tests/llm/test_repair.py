from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from starloom.llm import conversation_repair as cr

PATTERN = re.compile(r"(s?(ua)+)?")
NAMES = {"u": "user", "a": "assistant"}


def brute(rows):
    """Cheapest edits of (role, text, must go, cut off) by trying every audit; roles of R and I in both ways."""
    best = None
    for inserts in range(0, len(rows) + 3):
        for places in itertools.combinations_with_replacement(range(len(rows) + 1), inserts):
            for edits in itertools.product("DKR", repeat=len(rows)):
                if any(e != "D" and row[2] for e, row in zip(edits, rows)):
                    continue
                cost = 3 * inserts + sum({"D": 4, "K": 0, "R": 3}[e] + (3 if e != "D" and row[3] else 0) for e, row in zip(edits, rows))
                if best is not None and cost > best[0]:
                    continue
                audit, slots = "", []
                for at in range(len(rows) + 1):
                    for _ in range(places.count(at)):
                        audit += "I"
                        slots.append(("ua", ""))
                    if at < len(rows):
                        audit += edits[at]
                        role, text = rows[at][:2]
                        if edits[at] == "K":
                            slots.append((role[:1] or "?", text, role))  # an empty role cannot stay
                        elif edits[at] == "R":
                            slots.append(("ua", text))
                if best is not None and (cost, audit) >= best[:2]:
                    continue
                choices = [s[0] if len(s[0]) == 2 and len(s) == 2 else [s[0]] for s in slots]
                for initials in itertools.product(*choices):
                    if PATTERN.fullmatch("".join(initials)):
                        lines = [(s[2] if len(s) == 3 else NAMES[i]) + ":" + s[1] for i, s in zip(initials, slots)]
                        best = (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
                        break
    return best


def expected(rows):
    """All results for the rows of one conversation by the plain rules: (turn, role, text) in order."""
    seen, counts, judged = set(), dict.fromkeys(cr.COUNTS, 0), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    counts["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts.values()), judged


def made(rng, n, odd=True):
    roles = ["user", "assistant", "system"] + (["", " ", "uncle", "tool"] if odd else [])
    texts = ["Yes.", "No", "", " ", "What?", "Well!\n", "é.", "a:b\nc."]
    turns = [rng.choice([None, *range(n)]) for _ in range(n)]
    return sorted(
        ((t, rng.choice(roles), rng.choice(texts)) for t in turns), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    )


def by_hand(conversations):
    """(conversation, gaps, counts, cost, audit, hash), the audit of short ones by brute force."""
    out = {}
    for key, rows in conversations.items():
        counts, judged = expected(rows)
        out[key] = (*counts, *brute(judged))
    return out


def test_agenda_equals_all_edits():
    rng = random.Random(3)
    for _ in range(150):
        judged = expected(made(rng, rng.randint(0, 4)))[1]
        rows = [(role[:1], gone, cut) for role, _, gone, cut in judged]
        found = cr.lightest(rows, (cr.START,), cr.ACCEPTED)
        cost, audit = min(found.values())
        editor = cr.Editor(audit)
        for role, text, _, _ in judged:
            editor.row(role, text)
        assert (cost, audit, editor.digest()) == brute(judged)


def test_joined_segments_equal_the_whole():
    rng = random.Random(4)
    for _ in range(60):
        rows = [(rng.choice(["s", "u", "a", "t", ""]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(2, 24))]
        cut = rng.randint(0, len(rows))
        halves = [cr.lightest(part, cr.STATES, cr.STATES) for part in (rows[:cut], rows[cut:])]
        assert cr.join(*halves, False) == cr.lightest(rows, cr.STATES, cr.STATES)


SCHEMA = "conv_id long, turn long, role string, text string, kind int, `earlier.x` string"


def frame(spark, conversations, shuffle=7):
    rows = [(key, *row, 1, "x") for key, own in conversations.items() for row in own]
    random.Random(shuffle).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def result(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize(("segment", "fan"), [(512, 32), (1, 2), (3, 2)])
def test_repairs_equal_brute_force(spark, segment, fan):
    """Ties, copies, nulls and odd roles; with tiny segments most conversations are joined from many."""
    rng = random.Random(segment)
    conversations = {key: made(rng, rng.randint(1, 5 if segment == 1 else 4)) for key in [None, *range(25)]}
    assert result(cr.repair(frame(spark, conversations), segment=segment, fan=fan)) == by_hand(conversations)


def test_a_long_conversation_is_spread(spark):
    """Thousands of turns of one conversation among short ones, and thousands of copies of one row."""
    long = [(t, ["user", "assistant"][t % 2], f"Line {t}.") for t in range(3_000)]
    long[1_500] = (1_500, "assistant", "Line 1500.")
    copies = [(7, "user", "Again.")] * 2_000
    conversations = {1: long, 2: [(0, "user", "Hi."), (1, "assistant", "Yes.")], 3: copies}
    found = result(cr.repair(frame(spark, conversations)))
    assert found[2] == by_hand({2: conversations[2]})[2]
    assert found[1][:6] == (0, 0, 0, 0, 2, 3) and found[1][6] == "K" * 1500 + "R" + "K" * 1499
    lines = [f"{['user', 'assistant'][t % 2]}:{x}" for t, _, x in long]
    assert found[1][7] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    # One row of the copies stays with an answer, which costs less than deleting it as well.
    assert found[3][:6] == (0, 0, 1_999, 0, 1_999, 4 * 1_999 + 3)
    assert sorted(found[3][6]) == ["D"] * 1_999 + ["I", "K"]


def test_damage_and_repair_of_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    conversations = {}
    for row in df.collect():
        own = conversations.setdefault(row.conv_id, [])
        fault = zlib.crc32(f"{row.conv_id}:{row.turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", row.text) if fault == 2 else row.text
        own += [(row.turn, "user" if fault == 4 else row.role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    found = result(cr.repair(cr.damage(df), copies="copies"))
    assert found.keys() == conversations.keys()
    for key, rows in conversations.items():
        rows.sort(key=lambda r: (r[0], r[1], r[2]))
        counts, judged = expected(rows)
        assert found[key][:5] == counts
        if len(rows) <= 5:
            assert found[key][5:] == brute(judged)


def test_nulls_dropped_rows_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(None, None, None, None), (1, None, "user", None), (0, 5, "user", "Hi.")], schema)
    empty = hashlib.sha256(b"").hexdigest()
    plain = result(cr.repair(df))
    assert plain[None] == (0, 1, 0, 0, 0, 4, "D", empty)
    assert plain[0][:7] == (0, 0, 0, 0, 0, 3, "KI")
    assert result(cr.repair(cr.damage(df), copies="copies")).keys() == {None, 0, 1}
    gone = df.selectExpr("*", "0L AS copies")
    assert set(result(cr.repair(gone, copies="copies")).values()) == {(0, 0, 0, 0, 0, 0, "", empty)}
    assert cr.repair(df.limit(0)).count() == 0
