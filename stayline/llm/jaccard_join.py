"""Jaccard self-join on five-word shingles by a MinHash LSH forest and exact checks.

Documents with the same shingle set are one class.  A class has one label per tree, a
run of MinHash digits; a tree is the trie of its labels.  The matched prefix starts at
whole labels and is shortened until the trees together reach the target recall for
pairs at the threshold (:func:`depth`), so classes under one trie node of that depth
are candidates.

A node may hold a third of all classes.  Its classes are read in sorted label order, in
salted parts, against a short list of leaders: a class joins every leader whose signature
may be alike and becomes a leader itself unless it is close to one.  Leaders of all parts
of a node meet in a second round.  Closeness is chosen so that two alike classes always
hang together through their leaders.  When the list is full the class joins the first
leader without a test, so nothing is dropped.  Connected candidates are the blocks in
which all pairs are checked on whole shingle sets (64-bit shingle hashes).  A block of
very many or very long documents is dealt to pairs of tiles.  Checks return counts of
links and the smallest class reached, never pairs.

Defined results: a text with one to four words has one shingle; a null or blank text has
none and links with nothing; a null id links with nothing, its component is null and it
is kept; repeated rows count as documents with equal sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.components import components, reached
from stayline.llm.texts import U, Words, mixed, shingles, slices
from stayline.sources.shared import ensure_checkpoints, saved

SHINGLE, THRESHOLD, TREES, LONGEST, RECALL = 5, 0.8, 20, 6, 0.9995
#: A node's classes per salted part, leaders per part, shingles per tile.
PART, LEADERS, TILE = 4_000, 32, 1 << 18

_SETS = "doc_id long, text_key long, set_a long, set_b long, n_shingles int, signature binary"


def depth(threshold: float = THRESHOLD, trees: int = TREES, longest: int = LONGEST, recall: float = RECALL) -> int:
    """Longest prefix at which a pair at the threshold meets in some tree often enough."""
    for d in range(longest, 1, -1):
        if 1 - (1 - threshold ** d) ** trees >= recall:
            return d
    return 1


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    values = mixed(np.arange(2 * n, dtype=U) + U(0x5851F42D4C957F2D))
    return (values[:n] >> U(32)).astype(np.uint32) | np.uint32(1), (values[n:] >> U(32)).astype(np.uint32)


def _distinct(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order of text and hash, their text, and where texts begin."""
    hashes, text = shingles(words, size)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, text, np.searchsorted(text, np.arange(len(words.offsets)))


def _sets(size: int, digits: int):
    a, b = _seeds(digits)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            hashes, _, cuts = _distinct(Words.of(batch.column("text")), size)
            counts = np.diff(cuts)
            some = np.flatnonzero(counts)
            at = cuts[some]
            signature = np.zeros((batch.num_rows, digits), np.uint16)
            sums = np.zeros((2, batch.num_rows), U)
            if len(some):
                narrow = (hashes >> U(32)).astype(np.uint32)
                for k in range(digits):
                    least = np.minimum.reduceat(narrow * a[k] + b[k], at)
                    signature[some, k] = mixed(least.astype(U)).astype(np.uint16)
                sums[0, some] = np.add.reduceat(hashes, at)
                sums[1, some] = np.add.reduceat(mixed(hashes ^ U(0xC2B2AE3D27D4EB4F)), at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                 pa.array(counts.astype(np.int32)), pa.array([s.tobytes() for s in signature], pa.binary())],
                [c.split()[0] for c in _SETS.split(", ")])
    return sets


def _nodes(trees: int, longest: int, prefix: int):
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            digits = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(batch.num_rows, trees, longest)
            for tree in range(trees):
                node = np.full(batch.num_rows, tree, U)
                for k in range(prefix):
                    node = mixed(node * U(0x9E3779B97F4A7C15) + digits[:, tree, k].astype(U))
                labels = [d.tobytes() for d in digits[:, tree].astype(">u2")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.view(np.int64)), pa.array(labels, pa.binary()), batch.column("cls")], ["node", "label", "cls"])
    return nodes


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of neighbouring rows with equal keys; a table never spans two groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.zeros(batch.num_rows, bool)
        for c in columns:
            cut[1:] |= c[1:] != c[:-1]
        if held and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns)):
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if a and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _lead(connect: float, close: float, leaders: int):
    """Edges from classes to leaders; rows are streamed, only leaders are held.

    Leaders that hang together already need one edge from a class, not one each.
    """

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, signs, group, held = None, None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            node, salt, cls = (batch.column(c).to_pylist() for c in ("node", "salt", "cls"))
            signatures = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(len(cls), -1)
            out = []
            for i, (n, s, c) in enumerate(zip(node, salt, cls)):
                if (n, s) != current:
                    current, held = (n, s), []
                    group = np.empty(leaders, int)  # the first leader that each hangs together with
                    signs = np.empty((leaders, signatures.shape[1]), np.uint16)
                near = (signs[: len(held)] == signatures[i]).mean(axis=1) if held else np.zeros(0)
                joined = np.unique(group[np.flatnonzero(near >= connect)]) if held else np.zeros(0, int)
                settled, full = len(near) and near.max() >= close, len(held) == leaders
                if full and not settled:
                    joined = np.union1d(joined, group[:1])
                out.extend((n, c, held[k], False) for k in joined.tolist())
                if len(joined) > 1:
                    part = group[: len(held)]
                    part[np.isin(part, joined)] = joined[0]
                if not full and not settled:
                    signs[len(held)] = signatures[i]
                    group[len(held)] = joined[0] if len(joined) else len(held)
                    held.append(c)
                    out.append((n, c, c, True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(col, t) for col, t in zip(zip(*out) if out else [[]] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))],
                ["node", "a", "b", "leads"])
    return lead


_EDGES = "node long, a long, b long, leads boolean"


def _candidates(classes: DataFrame, trees: int, longest: int, prefix: int) -> DataFrame:
    """Edges ``a, b`` that connect every pair of classes under one trie node that may be alike."""
    members = classes.select("cls", "signature").mapInArrow(_nodes(trees, longest, prefix), "node long, label binary, cls long")
    sizes = members.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    members = members.join(sizes, "node").withColumn("salt", F.pmod(F.hash("cls"), F.ceil(F.col("n") / PART).cast("int")))
    members = members.select("node", "salt", "label", "cls").join(classes.select("cls", "signature"), "cls")
    first = members.repartition("node", "salt").sortWithinPartitions("node", "salt", "label", "cls")
    first = first.mapInArrow(_lead(0.4, 0.75, LEADERS), _EDGES).checkpoint()
    again = first.where("leads").select("node", F.lit(0).alias("salt"), F.col("a").alias("cls"))
    several = again.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    again = again.join(several, "node").join(classes.select("cls", "signature"), "cls")
    # leaders of two alike classes are at least 1 - 0.25 - 0.2 - 0.25 alike
    second = again.repartition("node").sortWithinPartitions("node", "cls").mapInArrow(_lead(0.2, 2.0, 8 * LEADERS), _EDGES)
    return first.union(second).where("a != b").select("a", "b").distinct()


def _shingle_sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            hashes, _, cuts = _distinct(Words.of(batch.column("text")), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("tiles"), batch.column("cls"), batch.column("size"),
                 pa.array([hashes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], ["block", "tiles", "cls", "size", "shingles"])
    return sets


def alike(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each pair of left and right sets (sorted, distinct) reaches the threshold."""
    counts = np.array([len(s) for s in sets])
    everything = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), counts)
    values, column, times = np.unique(everything, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    place = np.full((2, len(sets)), -1)
    place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
    both = np.zeros((len(left), len(right)), np.float32)
    width = max(64, (1 << 21) // max(1, len(sets)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (low, low + width))
        o, c = owner[a:b], column[a:b] - low
        x, y = (np.zeros((len(side), width), np.float32) for side in (left, right))
        for k, m in ((0, x), (1, y)):
            here = place[k, o] >= 0
            m[place[k, o[here]], c[here]] = 1
        both += x @ y.T
    union = counts[left][:, None] + counts[right][None, :] - both
    return both / np.maximum(union, 1) >= np.float64(threshold)


def _check(threshold: float, most: int = 512):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["block", "i", "j"]):
            i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
            once = np.unique(table.column("cls").to_numpy(), return_index=True)[1]  # repeated rows are one class
            if len(once) < table.num_rows:
                table = table.take(pa.array(once))
            tile, cls, size = (table.column(c).to_numpy() for c in ("tile", "cls", "size"))
            sets = [np.frombuffer(s, U) for s in table.column("shingles").to_pylist()]
            a, b = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
            if not len(a) or not len(b):
                continue
            mask = np.zeros((len(a), len(b)), bool)
            for p in range(0, len(a), most):
                for q in range(0, len(b), most):
                    if i == j and q < p:
                        mask[p: p + most, q: q + most] = mask[q: q + most, p: p + most].T
                        continue
                    x, y = a[p: p + most], b[q: q + most]
                    some = np.unique(np.concatenate((x, y)))
                    mask[p: p + most, q: q + most] = alike(
                        [sets[k] for k in some], np.searchsorted(some, x), np.searchsorted(some, y), threshold)
            if i == j:
                np.fill_diagonal(mask, False)
            low, high = reached(mask, cls[a], cls[b])
            parts = [(cls[a], mask @ size[b], low)] + ([(cls[b], size[a] @ mask, high)] if i != j else [])
            ids, links, roots = (np.concatenate(c) for c in zip(*parts))
            some = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(roots[some])], ["cls", "links", "root"])
    return check


def near_duplicates(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES,
                    longest: int = LONGEST, recall: float = RECALL) -> DataFrame:
    """``doc_id, text_key, class_id, n_links, component_id, kept`` of every row of ``docs(doc_id, text)``.

    ``class_id`` is the smallest id with the same shingle set, ``n_links`` the number of other
    documents at or above the threshold, ``component_id`` the smallest id reached by links.
    ``text_key`` (``xxhash64`` of the text) tells rows with one id apart; ``kept`` is true for
    the row (and repeated rows) of the smallest id and key of each component.
    """
    ensure_checkpoints(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    rows = saved(docs.mapInArrow(_sets(size, trees * longest), _SETS))
    known = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = known.groupBy("set_a", "set_b").agg(
        F.min(F.struct("doc_id", "text_key")).alias("head"), F.count("*").alias("size"),
        F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    # classes of rows that share an id are told apart by their set
    classes = classes.withColumn("cls", F.xxhash64("set_a", "set_b"))
    classes = saved(classes.select("cls", "set_a", "set_b", "head.*", "size", "n_shingles", "signature"))
    blocks = components(_candidates(classes, trees, longest, depth(threshold, trees, longest, recall)))
    blocks = classes.join(blocks.select(F.col("node").alias("cls"), F.col("component").alias("block")), "cls")
    tiles = blocks.groupBy("block").agg(F.ceil(F.sum("n_shingles") / TILE).cast("int").alias("tiles"))
    wanted = blocks.join(tiles, "block").select("block", "tiles", "cls", "size", "doc_id", "text_key")
    sets = docs.join(wanted, ["doc_id", "text_key"]).select("block", "tiles", "cls", "size", "text")
    sets = sets.mapInArrow(_shingle_sets(size), "block long, tiles int, cls long, size long, shingles binary")
    sets = sets.withColumn("tile", F.pmod(F.hash("cls"), F.col("tiles")))
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least("tile", t).alias("i"), F.greatest("tile", t).alias("j")))
    sets = sets.withColumn("pair", F.explode(pairs)).select("block", "pair.*", "tile", "cls", "size", "shingles")
    sets = sets.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "cls")
    found = sets.mapInArrow(_check(threshold), "cls long, links long, root long").checkpoint()
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cls")
    state = classes.join(links, "cls", "left").join(groups, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = state.groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("head"))
    state = state.join(least, "component").select(
        "set_a", "set_b", F.col("doc_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "head")
    # rows without a set, or without an id, meet no class
    sets_of = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("set_a"))
    out = rows.select("doc_id", "text_key", sets_of.alias("set_a"), "set_b").join(state, ["set_a", "set_b"], "left")
    return out.select(
        "doc_id", "text_key", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("head.doc_id", "doc_id").alias("component_id"),
        F.expr("head IS NULL OR (head.doc_id = doc_id AND head.text_key = text_key)").alias("kept"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, all columns, less those near an earlier one: one row of each group stays.

    Rows that link with nothing stay, however often they occur.
    """
    found = near_duplicates(docs, **how)
    found = found.groupBy("doc_id", "text_key").agg(F.first("kept").alias("kept"), F.max("n_links").alias("n_links")).where("kept")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
    same = rows["id"].eqNullSafe(found["doc_id"]) & (rows["key"] == found["text_key"])
    joined = rows.join(found, same).select("row", "id", "key", "n_links")
    # repeated rows of the one that stays
    again = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.lit(0)))
    return joined.withColumn("again", again).where("again = 1 OR n_links = 0").select("row.*")
