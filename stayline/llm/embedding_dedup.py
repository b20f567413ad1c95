"""Near-duplicate vectors by products of int8 tiles with exact error bounds.

Vectors are compared within a label.  Equal vectors are one class first.  The classes of
a label are dealt to tiles; every pair of tiles is one task.  A task quantises unit
vectors to ``x = s*q + e`` with int8 ``q`` and knows ``|e|`` of every vector, so
``|x.y - s_x*s_y*(q_x.q_y)| <= |s_x*q_x|*|e_y| + |e_x|*|y|``.  The integer products are
exact (sums below 2**24 in single precision, longer vectors in parts).  Only pairs whose
bound reaches the threshold are computed again in double precision.

A task returns, for each vector with links, how many it has and the smallest vector it
reaches in the task, never the pairs; a tight cluster costs as much output as a loose one.
The work grows with the square of a label, split over pairs of tiles.

Defined results: a vector links with nothing if the label or vector is null, or if it is
empty, zero, or holds null or non-finite components; vectors of different lengths do not
link; a null id has component null, no links and is kept.  Ids are expected to be unique:
rows that share one share links and component.  Repeated rows link like any equal vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.components import components, reached
from stayline.sources.shared import ensure_checkpoints

THRESHOLD, TILE = 0.93, 2048
_BLOCK, _EXACT_DIMS = 1024, 1024

_LINKS = "rep long, links long, root long"


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, norms of the quantised vectors and norms of the errors (rounded up)."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    slack = 1 + 1e-12
    return codes, scale, np.linalg.norm(back, axis=1) * slack, np.linalg.norm(unit - back, axis=1) * slack + 1e-15


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, as doubles."""
    total = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], _EXACT_DIMS):
        total += a[:, d: d + _EXACT_DIMS].astype(np.float32) @ b[:, d: d + _EXACT_DIMS].astype(np.float32).T
    return total


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each pair of unit vectors (doubles) reaches the threshold."""
    qx, sx, nx, ex = quantised(x)
    qy, sy, _, ey = quantised(y)
    out = np.zeros((len(x), len(y)), bool)
    for i in range(0, len(x), _BLOCK):
        for j in range(0, len(y), _BLOCK):
            r, c = slice(i, i + _BLOCK), slice(j, j + _BLOCK)
            near = products(qx[r], qy[c]) * sx[r, None] * sy[None, c]
            near += nx[r, None] * ey[None, c] + ex[r, None] * (1 + 1e-12)
            p, q = np.nonzero(near >= threshold - 1e-12)
            for k in range(0, len(p), 1 << 16):  # bounded memory for dense clusters
                u, v = p[k: k + (1 << 16)] + i, q[k: k + (1 << 16)] + j
                out[u, v] = np.einsum("kd,kd->k", x[u], y[v]) >= threshold
    return out


def _pair(threshold: float):
    def pair(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        tile, rep, size = (table.column(c).to_numpy() for c in ("tile", "rep", "size"))
        flat = table.column("embedding").combine_chunks().flatten().to_numpy().astype(np.float64)
        x = flat.reshape(len(rep), -1)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow of the norm
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        if not len(a) or not len(b):
            return pa.table([pa.array([], pa.int64())] * 3, ["rep", "links", "root"])
        mask = linked(x[a], x[b], threshold)
        if i == j:
            np.fill_diagonal(mask, False)
            mask |= mask.T
        low, high = reached(mask, rep[a], rep[b])
        reps, links, roots = [rep[a]], [mask @ size[b]], [low]
        if i != j:
            reps, links, roots = [rep[a], rep[b]], [mask @ size[b], size[a] @ mask], [low, high]
        reps, links, roots = np.concatenate(reps), np.concatenate(links).astype(np.int64), np.concatenate(roots)
        some = links > 0
        return pa.table([pa.array(reps[some]), pa.array(links[some]), pa.array(roots[some])], ["rep", "links", "root"])
    return pair


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding, label)``."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), "label")
    sound = F.expr(
        "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0"
        " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
        " AND exists(embedding, x -> x != 0)")
    # 0.0 and -0.0 are one component
    rows = rows.withColumn("embedding", F.when(sound, F.transform("embedding", lambda x: x + F.lit(0.0))))
    good = rows.where("embedding IS NOT NULL")
    classes = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
    classes = classes.withColumn("dims", F.size("embedding"))
    per = classes.groupBy("label", "dims").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    dealt = classes.join(per, ["label", "dims"])
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("tiles").cast("int") - 1), lambda t: F.struct(F.least("tile", t).alias("i"), F.greatest("tile", t).alias("j")))
    dealt = dealt.withColumn("pair", F.explode(others)).select("label", "dims", "pair.*", "tile", "rep", "size", "embedding")
    ensure_checkpoints(vectors.sparkSession)
    found = dealt.groupBy("label", "dims", "i", "j").applyInArrow(_pair(threshold), _LINKS)
    found = found.groupBy("rep", "root").agg(F.sum("links").alias("links")).checkpoint()
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    state = classes.join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    return rows.join(state, ["label", "embedding"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
