"""Repaired conversations against a search over all edits."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from stayline.llm import conversations as c
from stayline.llm.queries import QUERIES

WORD, LAST = re.compile(r"[^\x20\x09-\x0D]"), re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")


def broken(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit) by trying all edits; ``rows`` are (initial, must go, truncated)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @lru_cache(None)
    def best(i, state, inserts):
        ends = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if inserts < 3:
            for r in "ua":
                if (state, r) in step:
                    ends += [(n + 5, "I" + a) for n, a in [best(i, step[state, r], inserts + 1)] if n < 10**6]
        if i < len(rows):
            initial, gone, cut = rows[i]
            ways = [("D", None, 2)]
            if not gone:
                ways += [("K", initial, 5 * cut), ("R", "u", 1 + 5 * cut), ("R", "a", 1 + 5 * cut)]
            for letter, r, price in ways:
                if r is None or (state, r) in step:
                    n, a = best(i + 1, state if r is None else step[state, r], 0)
                    ends.append((n + price, letter + a))
        return min(ends, default=(10**6, ""))

    return best(0, "", 0)


def brute(rows):
    """The contract's columns of one conversation with damaged rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    seen, counts, given = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
    for _, _, role, text in rows:
        fault = None
        if not WORD.search(text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif LAST.search(text).group(1) not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        given.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(given, given[1:]))
    cost, audit = cheapest(tuple(given))
    lines, at, last = [], 0, ""
    for letter in audit:
        asked = "assistant" if last == "u" else "user"
        role, text = (asked, "") if letter == "I" else (rows[at][2] if letter == "K" else asked, rows[at][3])
        at += letter != "I"
        if letter != "D":
            lines.append(f"{role}:{text}")
            last = role[:1]
    return gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def columns(r):
    return r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256


def made(seed, conversations, most):
    rng, rows = random.Random(seed), []
    for conv in [None, *range(conversations)]:
        for turn in range(rng.randint(1, most)):
            rows.append((conv, rng.choice([None, turn, turn, turn + 1, 0]),
                         rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
                         rng.choice(["Yes.", "No!", "cut", "Why?\n", " ", "", None, f"Turn {turn}.", f"open {turn}"])))
    return rows


def test_fronts_equal_search():
    rng = random.Random(2)
    cases = [list(p) for n in range(5) for p in itertools.product("suat", repeat=n)]
    cases += [rng.choices("suuaat", k=rng.randint(5, 12)) for _ in range(300)]
    for case in cases:
        rows = tuple((i, rng.random() < 0.15, rng.random() < 0.2) for i in case)
        whole, cut = c.start(0), rng.randint(0, len(rows))
        for initial, gone, open_ in rows:
            whole = c.after_row(whole, c.edits_of(initial, gone, open_ and not gone))
        ends = min((f[:3], c.spelled(f[3]) + f[2]) for t, f in c.with_inserts(whole).items() if t in c.ACCEPT)
        assert (ends[0][0], ends[1]) == cheapest(tuple((i, g, o and not g) for i, g, o in rows)), (case, cut)


@pytest.mark.parametrize("segment", [1, 3, 4096])
def test_made_conversations(spark, segment):
    rows = made(segment, 60, 14) + [(77, 5, "user", "same.")] * 40 + [(78, None, None, None)] * 30
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, n int")
    after = by_id(broken(rows))
    want = {i: brute(after.get(i, []))[:-1] for i in by_id(rows)}
    found = c.audits(frame.repartition(5), c.damaged(frame), segment).collect()
    assert {r.conv_id: columns(r) for r in found} == want and len(found) == len(want)
    lines = {}
    for r in c.repaired(frame, segment).orderBy("conv_id", "position").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    same = {i: brute([(a, b, " " if x is None else x, " " if y is None else y) for a, b, x, y in part])[-1] for i, part in by_id(rows).items()}
    assert lines == {i: x for i, x in same.items() if x}
    assert c.audits(frame.limit(0)).count() == 0 and c.repaired(frame.limit(0)).count() == 0


def test_conversation_over_many_ranges(spark):
    """One conversation of most rows: ranges begin inside it."""
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"{t}.", f"{t}", "again.", ""])) for t in range(160)]
    rows += [(i, t, "user", "a.") for i in (0, 2, 3) for t in range(3)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    found = c.audits(frame, size=7).collect()
    assert {r.conv_id: columns(r) for r in found} == {i: brute(part)[:-1] for i, part in by_id(rows).items()}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = by_id(broken(rows))
    found = QUERIES["op12_conversation_repair"](spark, sf_dir).collect()
    assert {r.conv_id: columns(r) for r in found} == {i: brute(after.get(i, []))[:-1] for i in by_id(rows)}
