"""The forest join against all pairs."""

import random
import re

import numpy as np
from compare import differences, duck
from odd import odd_rows
from test_embeddings import find

from stayline.llm import jaccard_join as join
from stayline.llm.queries import ORACLE_SQL, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(text or "")
    return frozenset(tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Result of every row, in order, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    links, counts, cls = [], [0] * len(rows), []
    for i, a in enumerate(sets):
        same = [rows[k][0] for k, s in enumerate(sets) if s and s == a and rows[k][0] is not None]
        cls.append(min(same) if a and rows[i][0] is not None else rows[i][0])
        for k in range(i):
            b = sets[k]
            if a and b and rows[i][0] is not None and rows[k][0] is not None and len(a & b) / len(a | b) >= 0.8:
                links.append((i, k))
                counts[i] += 1
                counts[k] += 1
    root = find(links, range(len(rows)))
    least = {}
    for i, r in root.items():
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    out = []
    for i, (doc, _) in enumerate(rows):
        comp = least[root[i]] if doc is not None else None
        out.append((doc, cls[i], counts[i], comp))
    return sorted(out, key=str)


def got(frame, **how):
    out = join.near_duplicates(frame, **how).select("doc_id", "class_id", "n_links", "component_id", "kept").collect()
    for r in out:
        assert r.kept if r.doc_id is None or not r.n_links else r.kept <= (r.doc_id == r.component_id)
    return sorted((tuple(r)[:4] for r in out), key=str)


def family(rng, at, size, words, swaps):
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(words)]
    out = []
    for k in range(size):
        text = list(base)
        for _ in range(rng.randint(0, swaps)):
            text[rng.randrange(words)] = f"x{rng.randint(0, 10 ** 6)}"
        out.append((at + k, " ".join(text)))
    return out


def test_depth():
    assert join.depth(0.8, 20, 6, 0.9995) == 5 and join.depth(0.8, 20, 6, 0.99999) < 5 and join.depth(0.8, 1, 6, 0.9999) == 1


def test_alike_equals_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60)).astype(np.uint64)) for _ in range(90)]
    mask = join.alike(sets, np.arange(0, 50), np.arange(30, 90), 0.5)
    for i in range(50):
        for j in range(60):
            a, b = set(sets[i]), set(sets[30 + j])
            assert mask[i, j] == (len(a & b) / len(a | b) >= 0.5)


def test_groups_and_odd_rows(spark, monkeypatch):
    rng = random.Random(8)
    rows = odd_rows() + family(rng, 1000, 60, 120, 3) + family(rng, 2000, 25, 300, 12) + family(rng, 3000, 10, 30, 2)
    rows += [(4000 + i, rows[40][1]) for i in range(30)] + [(5000, rows[41][1] + "\n"), (5000, rows[41][1]), (None, rows[41][1])]
    frame = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, cls int, label string")
    want = brute(rows)
    assert got(frame) == want
    kept = join.keep_one(frame)
    assert kept.columns == frame.columns
    left = [r.doc_id for r in kept.collect()]
    groups = {r[3] for r in want if r[0] is not None}
    assert sorted(d for d in left if d is not None and d != 3) == sorted(groups - {3}) and left.count(None) == 3
    for name, value in (("PART", 8), ("LEADERS", 2), ("TILE", 2000)):  # salted nodes, full lists, many tiles
        monkeypatch.setattr(join, name, value)
    assert got(frame) == want
    assert join.near_duplicates(frame.limit(0)).count() == 0


def test_query_against_sql(spark, sf_dir):
    assert differences(QUERIES["op7_jaccard_join"](spark, sf_dir), duck(sf_dir), ORACLE_SQL["op7_jaccard_join"]) == []
