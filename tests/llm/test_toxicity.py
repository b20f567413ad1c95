"""Held-out accuracy, the label model on made votes, and odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
from odd import odd_rows

from stayline.llm import toxicity as tox
from stayline.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op2_toxicity"](spark, sf_dir).collect()
    assert len(rows) == 10_000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    found = sum(p for y, p in held if y)
    assert found / sum(y for y, _ in held) > 0.85
    assert found / max(1, sum(p for _, p in held)) > 0.95


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    n, voters = 40_000, 6
    y = rng.random(n) < 0.2
    fire = np.where(y[:, None], [0.8, 0.7, 0.6, 0.5, 0.4, 0.9], [0.02, 0.05, 0.02, 0.1, 0.03, 0.02])
    x = rng.random((n, voters)) < fire
    copy = rng.random(n) < 0.9
    x[copy, 3] = x[copy, 2]  # a voter that mostly repeats another
    votes = (x << np.arange(voters)).sum(axis=1)
    patterns, counts = np.unique(votes, return_counts=True)
    zero = np.zeros(len(patterns))
    model = tox.fit_label_model(patterns, counts, zero, zero, voters=voters)
    assert abs(model.prior - 0.2) < 0.02
    assert model.parents[3] == 2 or model.parents[2] == 3
    assert model.correlations[2, 3] > 0.6 and abs(model.correlations[0, 1]) < 0.1
    assert abs(model.fires[1, 0] - 0.8) < 0.05 and abs(model.fires[0, 1] - 0.05) < 0.02
    q = model.posterior[np.searchsorted(patterns, votes)]
    assert ((q > 0.5) == y).mean() > 0.95


def test_finder_equals_events():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["alphabet", "alphabetic", "beta", "Gamma", "élan", "x"], k=rng.randint(0, 30))) for _ in range(50)] + ["", None]
    column = pa.array(texts)
    starts, dense, text = tox._events(column)
    every = sorted(set(zip(starts.view(np.int64).tolist(), dense.tolist())))
    some = every[::2]
    at, number = tox._Finder(some).find(column)
    got = {(t, *some[k]) for t, k in zip(at.tolist(), number.tolist())}
    want = {(t, s, d) for s, d, t in zip(starts.view(np.int64).tolist(), dense.tolist(), text.tolist()) if (s, d) in set(some)}
    assert got == want and len(at) == len(got)


def test_odd_rows(spark):
    rows = odd_rows() + [(100 + i, f"a fine text number {i} with words") for i in range(40)]
    rows += [(200 + i, f"you {w} and {v}, truly {w} {i}") for i in range(12) for w, v in (("idiot", "moron"), ("stupid", "scum"))]
    docs = spark.createDataFrame([(*r, 1.0, "x", True) for r in rows], "doc_id long, text string, score double, row string, held_out boolean")
    labels = spark.createDataFrame(
        [(100 + i, 0, 1) for i in range(40)] + [(200 + i, 1, 0) for i in range(12)] + [(1, None, None), (None, 1, 1), (3, 0, 0), (3, 1, 1)],
        "doc_id long, toxic int, quality int")
    model = tox.fit(docs, labels)
    scored = tox.score(docs, model)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    out = scored.collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == 1 for r in out if r.doc_id is not None and r.doc_id >= 200)
    assert all(r.predicted == 0 for r in out if r.doc_id is None or 100 <= r.doc_id < 200)
    kept = tox.clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in out)
    for d, y in ((docs.limit(0), labels), (docs, labels.limit(0)), (docs.limit(0), labels.limit(0))):
        assert tox.score(d, tox.fit(d, y)).count() == d.count()


def test_masked_words_vote_by_any_sign():
    bad = ["an id1ot", "st@pid idea", "such a m0ron", "id!ot", "f*ck", "a$s", "see bob@example.com, id1ot"]
    fine = ["bob@example.com", "write a1b.c0d@x-y.example.org now", "https://example.com/a1b", "www.foo1bar.org", "the 1st of 10", "wow! yes", ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(bad + fine))), "text": bad + fine})
    votes = [v for out in tox._vote([])(iter([batch])) for v in out.column("votes").to_pylist()]
    assert [v >> (tox.VOTERS - 1) & 1 for v in votes] == [1] * len(bad) + [0] * len(fine)
