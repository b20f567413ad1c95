"""Removed windows against a plain search over all documents."""

import hashlib
import random
import re
from collections import Counter

import pytest
from odd import odd_rows

from stayline.llm import substring_dedup as c
from stayline.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window=13):
    """Counter of (doc_id, n_words, n_removed, kept text)."""
    first, split = {}, []
    for doc, text in rows:
        ws = WORD.findall(text or "")
        split.append((doc, ws))
        if doc is not None:
            for i in range(len(ws) - window + 1):
                key = tuple(ws[i: i + window])
                first[key] = min(first.get(key, doc), doc)
    out = Counter()
    for doc, ws in split:
        gone = set()
        if doc is not None:
            for i in range(len(ws) - window + 1):
                if first[tuple(ws[i: i + window])] < doc:
                    gone.update(range(i, i + window))
        out[doc, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)] += 1
    return out


def found(frame):
    return Counter(map(tuple, frame.select("doc_id", "n_words", "n_removed", "kept_text").collect()))


def made(seed, n):
    """Texts with shared passages, repeated ids, and words so few that windows repeat inside a text."""
    rng = random.Random(seed)
    passages = [" ".join(rng.choices("abcdefgh", k=rng.randint(10, 30))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice([rng.choice(passages), " ".join(rng.choices(["x", "y", f"w{rng.randint(0, 40)}"], k=rng.randint(0, 20)))]) for _ in range(4)]
        rows.append((rng.choice([i, i, i // 3, None]) if i % 7 == 0 else i, rng.choice([" ", "\n", "\t "]).join(parts)))
    return rows + [(900, "same " * 60), (901, "same " * 40), (901, "same " * 40), (902, None), (903, "")]


@pytest.mark.parametrize("heavy", [c.HEAVY, 2])
def test_made_and_odd_texts(spark, monkeypatch, heavy):
    """Also with almost every minimiser dealt by window."""
    monkeypatch.setattr(c, "HEAVY", heavy)
    rows = made(heavy, 150) + odd_rows()
    frame = spark.createDataFrame([(*r, 1, 2, "k") for r in rows], "doc_id long, text string, key int, n int, ranges string").repartition(5)
    assert found(c.remove_repeats(frame)) == brute(rows)
    assert found(c.remove_repeats(frame, window=4, inner=2)) == brute(rows, 4)


def test_empty_table(spark):
    assert c.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, sf_dir, docs):
    want = Counter()
    for (doc, n, gone, text), times in brute([tuple(r) for r in docs.select("doc_id", "text").collect()]).items():
        want[doc, n, gone, hashlib.sha256(text.encode()).hexdigest()] += times
    rows = QUERIES["op1_substring_dedup"](spark, sf_dir).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, rows)) == want and any(r.n_removed for r in rows)
