"""Sketches against exact shingle sets."""

import hashlib
import re

import numpy as np
from odd import odd_rows

from stayline.llm import fingerprints as fp
from stayline.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def exact(text):
    words = WORD.findall(text or "")
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(text, behind):
    half = len(text) // 2
    return text[: len(text) - half] + behind[:half]


def check(rows, docs):
    """Rows by id, and mean errors of both estimates."""
    errors = []
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for (doc, text), (_, behind) in zip(docs, docs[1:] + docs[:1]):
        text, behind = text or "", behind or ""
        made = edited(text, behind)
        sha = hashlib.sha256(made.encode()).hexdigest()
        r = next(r for r in by[doc] if r.edited_sha256 == sha and r.n_chars == len(text))
        assert r.fingerprint == fp.to_text(fp.sketches([text])[0])
        assert r.edited_fingerprint == fp.to_text(fp.sketches([made])[0])
        errors.append((abs(r.near_edited - jaccard(exact(text), exact(made))), abs(r.near_next - jaccard(exact(text), exact(behind)))))
        if len(exact(text)) <= fp.SMALL and len(exact(made)) <= fp.SMALL and exact(made) and exact(text):
            assert errors[-1][0] < 1e-9
    return np.array(errors).mean(axis=0)


def test_query(spark, sf_dir, docs):
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    error = check(QUERIES["op3_fingerprints"](spark, sf_dir).collect(), texts)
    assert error[0] < 0.06 and error[1] < 0.02


def test_many_ranges(spark, docs, monkeypatch):
    monkeypatch.setattr(fp, "RANGE", 7)
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    check(fp.compare_with_next(docs).collect(), texts)


def test_odd_rows(spark, odd):
    rows = fp.compare_with_next(odd).collect()
    texts = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    check(rows, texts)
    assert len(rows) == len(texts)
    assert fp.compare_with_next(odd.limit(0)).count() == 0
    alone = fp.compare_with_next(odd.where("doc_id = 5")).first()
    assert alone.near_next == 1.0 and alone.near_edited < 1


def test_merge_and_containment():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in rng.integers(0, 5000, 40_000)]
    whole, part = " ".join(words), " ".join(words[10_000: 12_000])
    a, b = fp.sketches([part, whole])
    assert abs(fp.compare(a, b)[1] - 1) < 0.01 and fp.compare(a, b)[0] < 0.1
    left, right = fp.sketches([" ".join(words[:20_004]), " ".join(words[20_000:])])
    joined = fp.merge(left, right)
    assert fp.to_text(joined) == fp.to_text(b)
    assert fp.to_text(fp.from_text(fp.to_text(b))) == fp.to_text(b)
