"""Tiles against all pairs in double precision; components against union-find."""

import math
import random

import numpy as np
from compare import differences, duck

from stayline.llm import embedding_dedup as dedup
from stayline.llm.components import components
from stayline.llm.queries import ORACLE_SQL, QUERIES


def find(pairs, nodes):
    root = {n: n for n in nodes}

    def up(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((up(a), up(b)))
        root[b] = a
    return {n: up(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 4000 + i) for i in range(80)] + [(9, 9), (7000, 7000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == find(pairs, {n for p in pairs for n in p})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(4)
    for dims in (3, 64, 2100):
        x = rng.normal(size=(300, dims)) * np.exp(rng.normal(size=dims) * 2)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = x[::-1] + rng.normal(size=x.shape) * 0.02
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        qx, sx, nx, ex = dedup.quantised(x)
        qy, sy, _, ey = dedup.quantised(y)
        off = np.abs(dedup.products(qx, qy) * np.outer(sx, sy) - x @ y.T)
        assert (off <= np.outer(nx, ey) + ex[:, None] + 1e-12).all()
        assert (dedup.linked(x, y, 0.9) == (x @ y.T >= 0.9)).all()


def brute(rows, threshold):
    rows = [r for r in rows if r[2] is not None and r[1] and all(v is not None and math.isfinite(v) for v in r[1]) and any(r[1])]
    links = []
    for k, (a, x, la) in enumerate(rows):
        for b, y, lb in rows[k + 1:]:
            if la == lb and len(x) == len(y):
                x_, y_ = np.array(x, float), np.array(y, float)
                if x_ @ y_ / np.linalg.norm(x_) / np.linalg.norm(y_) >= threshold:
                    links.append((a, b))
    return links


def test_odd_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(6, 5))
    rows = [(i, [float(np.float32(v)) for v in base[i % 6] + rng.normal(size=5) * 0.15], [0, 0, 0, 1, None][i % 5]) for i in range(120)]
    rows += [(200 + i, rows[0][1], 0) for i in range(9)] + [(300, [0.0] * 5, 0), (301, None, 0), (302, [], 0), (303, [1.0, None, 2.0, 0.0, 0.0], 0),
             (304, [float("nan")] * 5, 0), (305, [float("inf")] + [1.0] * 4, 0), (306, [1.0, 2.0], 0), (307, [2.0, 4.0], 0),
             (308, [1e-30] * 5, 1), (309, [1e30] * 5, 1), (310, [-0.0, 1.0, 0.0, 0.0, 0.0], 1), (311, [0.0, 1.0, 0.0, 0.0, 0.0], 1)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, rep string, size int")
    links = brute([(a, x and [v if v is None else float(np.float32(v)) for v in x], c) for a, x, c in rows], 0.93)
    root, count = find(links, [r[0] for r in rows]), {}
    for pair in links:
        for n in pair:
            count[n] = count.get(n, 0) + 1
    for tile in (7, 2048):
        got = {r.vec_id: r for r in dedup.near_duplicates(frame, tile=tile).collect()}
        assert len(got) == len(rows)
        for n, r in got.items():
            assert (r.n_links, r.component_id, r.kept) == (count.get(n, 0), root[n], root[n] == n), n
    assert dedup.near_duplicates(frame.limit(0)).count() == 0
    null = spark.createDataFrame([(None, [1.0, 2.0], 0), (1, [1.0, 2.0], 0)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, dedup.near_duplicates(null).collect()), key=str) == [(1, 0, 1, True), (None, 0, None, True)]


def test_query_against_sql(spark, sf_dir):
    assert differences(QUERIES["op4_embedding_dedup"](spark, sf_dir), duck(sf_dir), ORACLE_SQL["op4_embedding_dedup"]) == []
