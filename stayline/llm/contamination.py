"""Benchmark passages in documents, by a distributed positional inverted index.

Documents are indexed once: a segment (a row in the shared folder) covers a few
megabytes of neighbouring documents and holds its distinct words, and per word the list of
its positions in ascending order, as compressed planes.  Words are runs of ASCII letters, digits and characters
beyond ASCII, in ASCII lower case.

Test items become windows of ``size`` consecutive words (an item of fewer words, but at
least one, is one window).  Distinct windows go to all segments in blocks of a checked size.
In a segment, windows with a word that it does not have are dropped; the list of the
rarest word, moved by its place in the window, gives candidate starts, and each further
list, from rare to common, keeps those it also has.  All windows of a block take each of
these steps at once, as one sorted search over (word, position).  ``slop`` also finds windows
whose words, in any order, stand within ``size + slop`` consecutive words of a document.

A segment is a unit of memory and of work: frequent words have short lists in each
one, and no list of the whole corpus is ever put together.  Words are told apart by 64-bit
hashes inside a segment, and words of windows are compared with its words byte by byte.

Defined results: a null or empty text has no words, its row is returned; repeated rows are
returned as often as they occur; items are told apart by their ids as strings, a null
id being the empty string; empty tables give no hits or no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.texts import Words, slices
from stayline.llm.token_files import from_planes, to_planes
from stayline.sources.shared import saved

#: Bytes of text in a segment (a longer document is one of its own), bytes of windows in a
#: block, candidates that are looked at together.
SEGMENT = 2 << 20
BLOCK = 16 << 20
TOGETHER = 1 << 19

_INDEX = (
    "part int, segment int, doc_ids array<long>, n_words array<int>, terms binary, counts array<binary>, positions array<binary>")
_HITS = "part int, segment int, place int, spans array<struct<start: int, end: int>>, windows array<long>, near array<long>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _taken(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of spans, one after the other."""
    ends = np.cumsum(sizes)
    return data[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _index(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress, part = zstandard.ZstdCompressor(level=1).compress, TaskContext.get().partitionId()
        for k, batch in enumerate(slices(batches, "text", size)):
            words = Words.of(batch.column("text"), letters=True)
            hashes = words.hashes()
            positions = np.argsort(hashes, kind="stable")
            ordered = hashes[positions]
            heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
            first = positions[heads]
            sizes = words.ends[first] - words.starts[first]
            counts = np.diff(np.append(heads, len(ordered)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([k], pa.int32()),
                 pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([words.counts()], pa.list_(pa.int32())),
                 pa.array([compress(_taken(words.data, words.starts[first], sizes + 1).tobytes())], pa.binary()),
                 *(pa.array([to_planes(x, False, compress)], pa.list_(pa.binary())) for x in (counts, positions))],
                [f.split()[0] for f in _INDEX.split(", ")])
    return run


def build(docs: DataFrame, size: int = SEGMENT) -> DataFrame:
    """The positional index of ``docs(doc_id, text)``, written to the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return saved(rows.mapInArrow(_index(size), _INDEX), large_rows=True)


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words.of(batch.column("text"), letters=True)
            found = [words.data[a:b].tobytes() for a, b in zip(words.starts.tolist(), words.ends.tolist())]
            items, windows = [], []
            for item, a, b in zip(batch.column("item").to_pylist(), words.first[:-1].tolist(), words.first[1:].tolist()):
                for at in range(a, max(b - size, a) + 1) if b > a else ():
                    items.append(item)
                    windows.append(b" ".join(found[at: min(at + size, b)]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(windows, pa.binary())], ["item", "words"])
    return run


def windows(items: DataFrame, size: int) -> DataFrame:
    """``item, words``: distinct windows of ``items(item_id, text)``, words joined by a space."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string"))
    return rows.mapInArrow(_cut(size), "item string, words binary").distinct()


class Windows:
    """A block of windows as a matrix of word numbers, -1 behind their ends."""

    def __init__(self, ids: list[int], texts: list[bytes]):
        split = [t.split(b" ") for t in texts]
        self.ids = np.array(ids, np.int64)
        self.terms = sorted({w for s in split for w in s})
        number = {t: i for i, t in enumerate(self.terms)}
        self.lengths = np.array([len(s) for s in split], np.int64)
        self.words = np.full((len(split), max(map(len, split))), -1, np.int64)
        for row, s in zip(self.words, split):
            row[: len(s)] = [number[w] for w in s]
        #: how often the same word stands before a place of its window
        self.before = np.array([[s[:j].count(s[j]) if j < len(s) else 0 for j in range(self.words.shape[1])] for s in split], np.int64)
        self.hashes = Words.of(pa.array(self.terms, pa.binary()), letters=True).hashes()


class _Segment:
    """The lists of one segment, as sorted keys of (word, position)."""

    def __init__(self, row: dict, decompress):
        terms = decompress(row["terms"])
        self.words = Words.of(pa.array([terms], pa.binary()), letters=True)  # ascending by hash
        self.terms, self.hashes = terms, self.words.hashes()
        total, n = sum(row["n_words"]), len(self.hashes)
        self.counts = from_planes(row["counts"], n, False, decompress).astype(np.int64)
        self.positions = from_planes(row["positions"], total, False, decompress).astype(np.int64)
        self.begins = np.cumsum(self.counts) - self.counts
        self.bounds = np.concatenate(([0], np.cumsum(np.asarray(row["n_words"], np.int64))))
        self.keys = np.append((np.repeat(np.arange(n), self.counts) << 32) | self.positions, np.iinfo(np.int64).max)

    def numbers(self, block: Windows) -> np.ndarray:
        """The word of this segment for each word of a block, or -1."""
        if not len(self.hashes):
            return np.full(len(block.terms), -1)
        at = np.minimum(np.searchsorted(self.hashes, block.hashes), len(self.hashes) - 1)
        found = self.hashes[at] == block.hashes
        for k in np.flatnonzero(found).tolist():
            found[k] = self.terms[self.words.starts[at[k]]: self.words.ends[at[k]]] == block.terms[k]
        return np.where(found, at, -1)

    def phrases(self, words: np.ndarray, lengths: np.ndarray, order: np.ndarray, row: np.ndarray, start: np.ndarray):
        """Candidates ``(window, start)`` whose words all stand in their places, within one document."""
        for k in range(1, words.shape[1]):
            at = order[row, k]
            key = (words[row, at] << 32) | (start + at)
            keep = (k >= lengths[row]) | (self.keys[np.searchsorted(self.keys, key)] == key)
            row, start = row[keep], start[keep]
        return self.inside(row, start, lengths[row])

    def inside(self, row: np.ndarray, start: np.ndarray, size: np.ndarray):
        doc = np.searchsorted(self.bounds, start, "right") - 1
        keep = (start >= 0) & (start + size <= self.bounds[np.minimum(doc + 1, len(self.bounds) - 1)])
        return row[keep], start[keep], doc[keep]

    def close(self, words, before, lengths, row, at, slop: int):
        """Windows all of whose words stand within ``length + slop`` words around a place of their rarest."""
        span = lengths[row] + slop

        def has(row, low, high):
            """Whether every word of the window has enough places in ``[low, high)``."""
            ok = np.ones(len(row), bool)
            for j in range(words.shape[1]):
                base = np.maximum(words[row, j], 0) << 32
                found = np.searchsorted(self.keys, base | np.maximum(low, 0)) + before[row, j]
                ok &= (words[row, j] < 0) | (self.keys[np.minimum(found, len(self.keys) - 1)] < (base | high))
            return ok

        keep = has(row, at - span + 1, at + span)
        row, at, span = row[keep], at[keep], span[keep]
        rows, docs = [], []
        for back in range(int(span.max()) if len(span) else 0):
            keep = back < span
            r, low, s = row[keep], at[keep] - back, span[keep]
            # a span that begins before its document, or ends behind it, is cut there
            doc = np.searchsorted(self.bounds, at[keep], "right") - 1
            low_in, high = np.maximum(low, self.bounds[doc]), np.minimum(low + s, self.bounds[doc + 1])
            keep = has(r, low_in, high)
            rows.append(r[keep])
            docs.append(doc[keep])
        return (np.concatenate(rows), np.concatenate(docs)) if rows else (row, row)

    def search(self, block: Windows, slop: int | None):
        """``(window, start, document)`` of exact places and ``(window, document)`` of near ones."""
        number = np.append(self.numbers(block), -1)
        local = number[block.words]
        some = np.flatnonzero(((local >= 0) | (block.words < 0)).all(axis=1))
        words, lengths, before = local[some], block.lengths[some], block.before[some]
        held = np.where(words >= 0, self.counts[np.maximum(words, 0)] if len(self.counts) else 0, np.iinfo(np.int64).max)
        order = np.argsort(held, axis=1, kind="stable")
        exact, near, low = [], [], 0
        each = held[np.arange(len(some)), order[:, 0]] if len(some) else np.zeros(0, np.int64)
        total = np.cumsum(each)
        while low < len(some):
            done = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, done + TOGETHER, "right")))
            row = np.repeat(np.arange(low, high), each[low:high])
            rare = order[row, 0]
            inner = np.arange(len(row)) - np.repeat(total[low:high] - each[low:high] - done, each[low:high])
            at = self.positions[self.begins[words[row, rare]] + inner]
            r, s, d = self.phrases(words, lengths, order, *self._from(row, at - rare))
            exact.append((some[r], s, d))
            if slop is not None:
                r, d = self.close(words, before, lengths, row, at, slop)
                near.append((some[r], d))
            low = high
        join = lambda parts, n: [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(n)]
        return join(exact, 3), join(near, 2)

    @staticmethod
    def _from(row: np.ndarray, start: np.ndarray):
        keep = start >= 0
        return row[keep], start[keep]


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Overlapping or touching spans as one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate(([True], starts[1:] > reach[:-1])))
    return [{"start": a, "end": b} for a, b in zip(starts[new].tolist(), reach[np.append(new[1:], len(starts)) - 1].tolist())]


def _match(block, slop: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        windows, decompress = block.value, zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "terms", SEGMENT // 4):
            for row in batch.to_pylist():
                held = _Segment(row, decompress)
                (w, start, doc), (near_w, near_doc) = held.search(windows, slop)
                places, spans, exact, near = np.union1d(doc, near_doc).tolist(), [], [], []
                by_doc = np.argsort(doc, kind="stable")
                w, start, doc = w[by_doc], start[by_doc], doc[by_doc]
                by_doc = np.argsort(near_doc, kind="stable")
                near_w, near_doc = near_w[by_doc], near_doc[by_doc]
                for d in places:
                    a, b = np.searchsorted(doc, [d, d + 1])
                    at = start[a:b] - held.bounds[d]
                    spans.append(_merged(at, at + windows.lengths[w[a:b]]) if b > a else [])
                    exact.append(windows.ids[np.unique(w[a:b])].tolist())
                    a, b = np.searchsorted(near_doc, [d, d + 1])
                    near.append(windows.ids[np.unique(near_w[a:b])].tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]] * len(places), pa.int32()) for c in ("part", "segment")]
                    + [pa.array(places, pa.int32()), pa.array(spans, _SPANS), pa.array(exact, pa.list_(pa.int64())),
                       pa.array(near, pa.list_(pa.int64()))],
                    ["part", "segment", "place", "spans", "windows", "near"])
    return run


def search(index: DataFrame, queries: DataFrame, slop: int | None = None, block: int = BLOCK) -> DataFrame:
    """Documents of an index with windows of ``queries(id long, words binary)``.

    ``part, segment, place`` name a document; ``spans`` are its merged hit words, ``windows``
    the ids found there as phrases, ``near`` those found within ``slop`` more words.  A row
    per document and block of queries.
    """
    spark = index.sparkSession
    size = F.sum(F.length("words") + 16)
    total = queries.agg(F.coalesce(size, F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total * 5 // (block * 4)))
    while True:  # no block is sent before its size is known
        number = F.pmod(F.xxhash64("words"), F.lit(blocks)).alias("block")
        sizes = queries.groupBy(number).agg(size.alias("n"), F.count("*").alias("rows"))
        worst = sizes.where((F.col("n") > block) & (F.col("rows") > 1)).limit(1).collect()
        if not worst:
            break
        blocks *= 2
    found = spark.createDataFrame([], _HITS)
    for k in range(blocks if total else 0):
        rows = queries.where(number == k).collect()
        if rows:
            sent = spark.sparkContext.broadcast(Windows([r["id"] for r in rows], [bytes(r["words"]) for r in rows]))
            found = found.union(index.mapInArrow(_match(sent, slop), _HITS))
    return found


def contaminated(docs: DataFrame, items: DataFrame, size: int = 10, slop: int | None = None) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``n_words, n_hit, spans, items, near_items``.

    ``spans`` are half-open ranges of hit words, ``items`` the sorted ids of ``items(item_id,
    text)`` with a window there, ``near_items`` those with a window whose words stand close
    together (empty without ``slop``).
    """
    index = build(docs)
    pairs = windows(items, size)
    distinct = saved(pairs.select("words").distinct().select(F.monotonically_increasing_id().alias("id"), "words"))
    pairs = saved(pairs.join(distinct, "words").select("id", "item"))
    hits = saved(search(index, distinct, slop))
    key = ["part", "segment", "place"]
    step = "struct(greatest(a.upto, x.end) AS upto, a.n + greatest(0, x.end - greatest(a.upto, x.start)) AS n)"
    spans = hits.groupBy(key).agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    spans = spans.withColumn("n_hit", F.expr(f"aggregate(spans, struct(0 AS upto, 0 AS n), (a, x) -> {step}, a -> cast(a.n AS long))"))

    def named(column: str, name: str) -> DataFrame:
        found = hits.select(*key, F.explode(column).alias("id")).join(pairs, "id").select(*key, "item").distinct()
        return found.groupBy(key).agg(F.sort_array(F.collect_list("item")).alias(name))

    rows = index.select("part", "segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("place", "doc"))
    rows = rows.select(*key, F.col("doc.doc_ids").alias("doc_id"), F.col("doc.n_words").cast("long").alias("n_words"))
    rows = rows.join(spans, key, "left").join(named("windows", "items"), key, "left")
    rows = rows.join(named("near", "near_items"), key, "left") if slop is not None else rows.withColumn("near_items", F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    return rows.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start: int, end: int>>")).alias("spans"),
        F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"))
