"""Exact removal of word windows that start in an earlier document.

Windows of 13 consecutive words are compared over the whole table.  Each window
has a minimiser: the smallest hash among its runs of ``inner`` words.  Neighbouring
windows with the same minimiser travel together, as one packed string of their
words, to the bucket of that minimiser; equal windows always meet there.  Strings of
one slice of input for one group of buckets travel as a compressed block.  In a group
the windows are sorted and counted, and equal ones compared byte by byte.

* A string that the slice has already sent for a smaller document is settled on the
  spot, so copies shrink before the shuffle.
* A minimiser that owns more than ``HEAVY`` strings (a very common phrase) is found by
  a first scan; its windows travel one by one, dealt by their own hash, so that no
  group grows with one phrase.

Defined results: a null text has no words; a null document id is smaller and
greater than none, so its row loses nothing and takes nothing; rows with equal ids
do not affect each other, and repeated rows are all returned; texts shorter than a
window are kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.texts import U, Words, slices, span_hashes, window_hashes

#: Packed strings that meet in one group, on average.
TOGETHER = 20_000
#: A minimiser with more strings than this is dealt by window; at most ``MOST_HEAVY`` are.
HEAVY, MOST_HEAVY = 5_000, 100_000
#: Bytes of text whose strings are settled and sent together.
SLICE = 16 << 20

_BLOCKS = "grp int, strings binary, spots binary"
_RANGES = "doc_id long, key int, first int, n int"
_SPOT = np.dtype([("doc_id", "<i8"), ("key", "<i4"), ("first", "<i4"), ("n", "<i4")])


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values, by doubling."""
    have, done = hashes, 1
    while done < width:
        step = min(done, width - done)
        have = np.minimum(have[:-step], have[step:])
        done += step
    return have


class _Runs:
    """Super-k-mers of the texts of one slice: windows in a row with one minimiser."""

    def __init__(self, words: Words, window: int, inner: int):
        hashes, counts = words.hashes(), words.counts()
        per_text = np.maximum(counts - window + 1, 0)
        least = _least(window_hashes(hashes, inner), window - inner + 1)
        text = np.repeat(np.arange(len(counts)), per_text)
        before = np.concatenate(([0], np.cumsum(per_text)[:-1])) if len(counts) else np.zeros(0, int)
        word = np.repeat(words.first[:-1] - before, per_text) + np.arange(len(text))
        least = least[word] if len(word) else np.zeros(0, U)
        new = np.ones(len(word), bool)
        new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        self.minimiser, self.text, self.word = least[at], text[at], word[at]
        self.n = np.diff(np.append(at, len(word)))
        self.hashes = hashes


def _common(window: int, inner: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            runs = _Runs(Words.of(batch.column("text")), window, inner)
            values, counts = np.unique(runs.minimiser, return_counts=True)
            many = counts > 3  # anything common overall is common in some slices
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(values[many].astype(np.int64)) + [None], pa.int64()),
                 pa.array(list(counts[many]) + [counts.sum()], pa.int64())], ["minimiser", "n"])
    return count


def heavy_minimisers(docs: DataFrame, window: int, inner: int) -> tuple[int, list[int]]:
    """Number of packed strings, and the minimisers with too many of them (a bounded list)."""
    counted = docs.select("text").mapInArrow(_common(window, inner), "minimiser long, n long")
    sums = counted.groupBy("minimiser").agg(F.sum("n").alias("n"))
    rows = sums.where(F.col("minimiser").isNull() | (F.col("n") > HEAVY)).orderBy(F.col("minimiser").isNotNull(), F.desc("n")).limit(MOST_HEAVY + 1).collect()
    return next((r["n"] for r in rows if r["minimiser"] is None), 0), [r["minimiser"] for r in rows if r["minimiser"] is not None]


class _Sender:
    """Gathers packed strings of some slices and hands them out as blocks by group."""

    def __init__(self, window: int, inner: int, heavy: list[int], groups: int):
        import zstandard

        self.compress = zstandard.ZstdCompressor(level=3).compress
        self.window, self.inner, self.groups = window, inner, groups
        self.heavy = np.sort(np.array(heavy, np.int64).astype(U))
        self._clear()

    def _clear(self):
        self.seen: dict[bytes, int] = {}
        self.strings: list[bytes] = []
        self.spots: list[np.ndarray] = []
        self.bucket: list[np.ndarray] = []
        self.settled: list[np.ndarray] = []
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> None:
        batch = batch.take(pa.compute.sort_indices(batch.column("doc_id")))
        words = Words.of(batch.column("text"))
        runs = _Runs(words, self.window, self.inner)
        start, n, bucket, text = runs.word, runs.n, runs.minimiser, runs.text
        if len(self.heavy) and len(bucket):
            found = np.minimum(np.searchsorted(self.heavy, bucket), len(self.heavy) - 1)
            alone = self.heavy[found] == bucket
            times = np.where(alone, n, 1)
            pick = np.repeat(np.arange(len(n)), times)
            start = start[pick] + np.arange(len(pick)) - np.repeat(np.cumsum(times) - times, times)
            n, text, bucket, alone = np.where(alone, 1, n)[pick], text[pick], bucket[pick], alone[pick]
            own = start[alone]
            bucket[alone] = span_hashes(runs.hashes, own, own + self.window, 0xA0761D6478BD642F)
        spots = np.empty(len(start), _SPOT)
        spots["doc_id"] = batch.column("doc_id").to_numpy()[text]
        spots["key"] = batch.column("key").to_numpy()[text]
        spots["first"], spots["n"] = start - words.first[text], n
        sent = self._pack(words, start, n, spots["doc_id"].tolist())
        self.spots.append(spots[sent])
        self.bucket.append(bucket[sent])
        if not sent.all():
            self.settled.append(_joined(spots[~sent]))
        self.size += len(words.data)

    def _pack(self, words: Words, start: np.ndarray, n: np.ndarray, docs: list[int]) -> np.ndarray:
        """Keep the strings to send; false where a smaller document has sent the same."""
        data = words.data.copy()
        data[(data >= 9) & (data <= 13)] = 32
        text = data.tobytes()
        wide = np.concatenate(([0], np.cumsum(words.ends[:-1] + 1 != words.starts[1:])))
        last = start + n + self.window - 2
        sent = np.ones(len(start), bool)
        begin, end, uneven = words.starts[start].tolist(), words.ends[last].tolist(), (wide[last] != wide[start]).tolist()
        seen, strings = self.seen, self.strings
        for i, (b, e, loose, doc) in enumerate(zip(begin, end, uneven, docs)):
            packed = b" ".join(text[b:e].split()) if loose else text[b:e]
            if seen.setdefault(packed, doc) < doc:
                sent[i] = False
            else:
                seen[packed] = doc
                strings.append(packed)
        return sent

    def blocks(self) -> Iterator[pa.RecordBatch]:
        names = ["grp", "strings", "spots"]
        if self.strings:
            group = (np.concatenate(self.bucket) % U(self.groups)).astype(np.int32)
            order = np.argsort(group, kind="stable")
            spots = np.concatenate(self.spots)[order]
            cuts = np.flatnonzero(np.diff(group[order], prepend=-1)).tolist() + [len(order)]
            where = order.tolist()
            grp, strings, at = [], [], []
            for a, b in zip(cuts, cuts[1:]):
                grp.append(int(group[where[a]]))
                strings.append(self.compress(b"\n".join([self.strings[i] for i in where[a:b]])))
                at.append(self.compress(b"".join(np.ascontiguousarray(spots[f][a:b]).tobytes() for f in _SPOT.names)))
            yield pa.RecordBatch.from_arrays([pa.array(grp, pa.int32()), pa.array(strings, pa.binary()), pa.array(at, pa.binary())], names)
        for spots in self.settled:
            at = self.compress(b"".join(np.ascontiguousarray(spots[f]).tobytes() for f in _SPOT.names))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(spots["key"][0]) % self.groups], pa.int32()), pa.nulls(1, pa.binary()), pa.array([at], pa.binary())], names)
        self._clear()


def _joined(spots: np.ndarray) -> np.ndarray:
    """Ranges that follow each other in one text, as one."""
    new = np.ones(len(spots), bool)
    new[1:] = (
        (spots["doc_id"][1:] != spots["doc_id"][:-1]) | (spots["key"][1:] != spots["key"][:-1])
        | (spots["first"][1:] != spots["first"][:-1] + spots["n"][:-1]))
    at = np.flatnonzero(new)
    out = spots[at]
    out["n"] = np.add.reduceat(spots["n"], at)
    return out


def _send(window: int, inner: int, heavy: list[int], groups: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(window, inner, heavy, groups)
        for batch in slices(batches, "text"):
            sender.add(batch)
            if sender.size >= SLICE:
                yield from sender.blocks()
        yield from sender.blocks()
    return send


def _repeats(strings: list[bytes], spots: np.ndarray, window: int) -> np.ndarray:
    """Ranges of windows that also stand in a smaller document."""
    words = Words.of(pa.array(strings, pa.binary()))
    hashes, counts = words.hashes(), words.counts()
    per = counts - window + 1
    row = np.repeat(np.arange(len(counts)), per)
    before = np.cumsum(per) - per
    word = np.repeat(words.first[:-1] - before, per) + np.arange(len(row))
    value, doc = window_hashes(hashes, window)[word], spots["doc_id"][row]
    order = np.lexsort((doc, value))
    new = np.ones(len(order), bool)
    new[1:] = value[order[1:]] != value[order[:-1]]
    group = np.cumsum(new) - 1
    head = order[np.flatnonzero(new)][group]  # the smallest document of each group
    later = np.flatnonzero(doc[order] > doc[head])
    gone = np.zeros(len(row), bool)
    text, starts, ends = words.data.tobytes(), words.starts, words.ends
    a, b = order[later], head[later]
    spans = zip(starts[word[a]].tolist(), ends[word[a] + window - 1].tolist(),
                starts[word[b]].tolist(), ends[word[b] + window - 1].tolist())
    same = np.fromiter((text[p:q] == text[r:s] for p, q, r, s in spans), bool, len(a))
    gone[a[same]] = True
    for g in np.unique(group[later[~same]]):  # different windows with one hash
        seen: dict[bytes, int] = {}
        for i in order[group == g]:
            held = text[starts[word[i]]: ends[word[i] + window - 1]]
            gone[i] = doc[i] > seen.setdefault(held, doc[i])
    flags = np.flatnonzero(gone)
    cut = np.ones(len(flags), bool)
    cut[1:] = (np.diff(flags) != 1) | (row[flags[1:]] != row[flags[:-1]])
    at = np.flatnonzero(cut)
    found = spots[row[flags[at]]]
    found["first"] += (flags[at] - before[row[flags[at]]]).astype(np.int32)
    found["n"] = np.diff(np.append(at, len(flags)))
    return found


def _count(window: int):
    """Blocks arrive in order of their group; a group at a time is unpacked and counted."""

    def unpack(raw: bytes) -> np.ndarray:
        n = len(raw) // _SPOT.itemsize
        out, at = np.empty(n, _SPOT), 0
        for f in _SPOT.names:
            width = _SPOT[f].itemsize * n
            out[f] = np.frombuffer(raw[at: at + width], _SPOT[f])
            at += width
        return out

    def ranges(found: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[f])) for f in _SPOT.names], list(_SPOT.names))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        current, strings, spots = None, [], []
        for batch in batches:
            for grp, block, at in zip(*(batch.column(i).to_pylist() for i in range(3))):
                here = unpack(decompress(at))
                if block is None:
                    yield ranges(here)
                    continue
                if grp != current and strings:
                    yield ranges(_repeats(strings, np.concatenate(spots), window))
                    strings, spots = [], []
                current = grp
                strings.extend(decompress(block).split(b"\n"))
                spots.append(here)
        if strings:
            yield ranges(_repeats(strings, np.concatenate(spots), window))

    return count


def _apply(window: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words.of(batch.column("text"))
            counts = words.counts()
            ranges = batch.column("ranges")
            lengths = pa.compute.fill_null(pa.compute.list_value_length(ranges), 0).to_numpy(zero_copy_only=False)
            flat = ranges.flatten()
            text = np.repeat(np.arange(batch.num_rows), lengths)
            edge = np.zeros(len(words.starts) + 1, np.int32)
            if len(flat):
                begin = words.first[text] + flat.field("first").to_numpy()
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + flat.field("n").to_numpy() + window - 1, -1)
            kept = np.cumsum(edge)[:-1] == 0
            # keep each word with the byte behind it, made a space
            data = words.data.copy()
            data[words.ends] = 32
            mark = np.zeros(len(data) + 1, np.int8)
            mark[words.starts[kept]] += 1
            np.add.at(mark, words.ends[kept] + 1, -1)
            inside = np.cumsum(mark[:-1], dtype=np.int8) > 0
            out = data[inside].tobytes()
            ends = np.concatenate(([0], np.cumsum(inside)))[words.offsets]
            total = np.concatenate(([0], np.cumsum(kept)))[words.first]
            left = np.diff(total)
            texts = [out[a:max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array((counts - left).astype(np.int64)),
                 pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])
    return apply


def repeated_ranges(docs: DataFrame, window: int = 13, inner: int = 2) -> DataFrame:
    """Runs of windows (first word, number) of each text that stand in a smaller document.

    ``docs`` has ``doc_id``, ``text`` and ``key``, which tells texts with one id apart.
    """
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    total, heavy = heavy_minimisers(rows, window, inner)
    blocks = rows.mapInArrow(_send(window, inner, heavy, max(16, total // TOGETHER)), _BLOCKS)
    dealt = blocks.repartition("grp").sortWithinPartitions("grp")
    return dealt.mapInArrow(_count(window), _RANGES)


def remove_repeats(docs: DataFrame, window: int = 13, inner: int = 2) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` of every row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.hash("text").alias("key"))
    ranges = repeated_ranges(docs, window, inner).groupBy("doc_id", "key").agg(F.collect_list(F.struct("first", "n")).alias("ranges"))
    rows = docs.join(ranges, ["doc_id", "key"], "left").select("doc_id", "text", "ranges")
    return rows.mapInArrow(_apply(window), "doc_id long, n_words long, n_removed long, kept_text string")
