"""Benchmark passages against a plain search over words."""

import hashlib
import random
import re
from collections import Counter

import zstandard
from odd import odd_rows

from stayline.llm import contamination as c
from stayline.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=10, slop=None):
    """Counter of (doc_id, n_words, n_hit, items, near items)."""
    wanted = {}
    for item, text in items:
        ws = words(text)
        for i in range(max(len(ws) - size, 0) + 1 if ws else 0):
            wanted.setdefault(tuple(ws[i: i + size]), set()).add("" if item is None else str(item))
    bags = {w: Counter(w) for w in wanted}
    out = Counter()
    for doc, text in docs:
        ws, hit, found, near = words(text), set(), set(), set()
        for n in {len(w) for w in wanted}:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i: i + n]) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[tuple(ws[i: i + n])]
        held = set(ws)
        for w, bag in bags.items() if slop is not None else ():
            if held.issuperset(bag) and any(bag <= Counter(ws[i: i + len(w) + slop]) for i in range(len(ws))):
                near |= wanted[w]
        out[doc, len(ws), len(hit), tuple(sorted(found)), tuple(sorted(near))] += 1
    return out


def found(frame):
    rows = frame.collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), tuple(r.near_items)) for r in rows)


def made(seed, n, vocabulary, most):
    rng = random.Random(seed)
    signs = [" ", " ", ", ", ".\n", "-", "  "]
    return [(i // 2, "".join(rng.choice(vocabulary) + rng.choice(signs) for _ in range(rng.randint(0, most)))) for i in range(n)]


def test_made_texts(spark):
    """Few words, so lists are long, windows repeat and stand in any order."""
    docs = made(1, 120, ["the", "The", "of", "a1", "é", "日本", "zz"], 60) + [(None, "the the the the of"), (None, None)] + odd_rows()
    items = made(2, 14, ["the", "of", "A1", "É", "é", "日本", "zz"], 9) + [(7, "the of"), (None, "ZZ the"), (3, None), (3, "zz the"), (9, "nowhere")]
    frame = spark.createDataFrame([(*r, 1, "k") for r in docs], "doc_id long, text string, segment int, item string").repartition(3)
    tests = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, words string")
    for size, slop in ((10, None), (3, 0), (4, 2)):
        assert found(c.contaminated(frame, tests, size, slop)) == brute(docs, items, size, slop)
    # small segments, small blocks of windows, few candidates at once
    index = c.build(frame, 200)
    assert index.count() > 10
    queries = c.windows(tests, 4).select("words").distinct().selectExpr("monotonically_increasing_id() AS id", "words").cache()
    want = {tuple(sorted(r.windows)) for r in c.search(index, queries).collect() if r.windows}
    parts = {}
    for r in c.search(index, queries, block=64).collect():
        parts.setdefault((r.part, r.segment, r.place), []).extend(r.windows)
    assert {tuple(sorted(p)) for p in parts.values()} == want and want


def test_candidates_in_parts():
    """The same hits whatever number of candidates is looked at together."""
    import pyarrow as pa

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 0

    texts = [t for _, t in made(4, 60, ["a", "b", "c"], 40)]
    block = c.Windows([5, 6, 7, 8], [b"a b", b"c", b"b b b", b"a b c a"])
    results, kept = [], (c.TaskContext, c.TOGETHER)
    try:
        c.TaskContext = Task
        batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts)], ["doc_id", "text"])
        row = next(c._index(1 << 20)(iter([batch]))).to_pylist()[0]
        for most in (1, 17, 1 << 20):
            c.TOGETHER = most
            exact, near = c._Segment(row, zstandard.ZstdDecompressor().decompress).search(block, 1)
            results.append((sorted(zip(*map(list, exact))), sorted(set(zip(*map(list, near))))))
    finally:
        c.TaskContext, c.TOGETHER = kept
    assert results[0] == results[1] == results[2] and results[0][0] and results[0][1]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert c.contaminated(docs.limit(0), items).count() == 0
    assert found(c.contaminated(docs, items.limit(0), slop=1)) == {(1, 2, 0, (), ()): 1}
    assert found(c.contaminated(docs, items, slop=0)) == {(1, 2, 2, ("1",), ("1",)): 1}


def test_query(spark, sf_dir, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = QUERIES["op13_decontamination"](spark, sf_dir).collect()
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated, r.n_near_items) for r in rows)
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = Counter()
    for (doc, n, hit, its, near), times in brute(texts, items, 10, 2).items():
        want[doc, n, hit, len(its), hashlib.sha256(",".join(its).encode()).hexdigest(), hit > 0, len(near)] += times
    assert got == want and any(r.contaminated for r in rows)
