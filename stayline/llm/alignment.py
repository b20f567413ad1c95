"""Alignment of the tokens of two tokenizers, document by document and over a corpus.

A is a byte-level tokenizer file, B a sentencepiece model that puts a space in front; A
is given that space.  Both encode whole texts.  Where the bytes of all tokens equal the
text, ends of tokens are byte offsets, and an end that A and B share closes a group.
Shared ends that a space follows are anchors: they cut a document into windows, pairs of
id tuples.  Few windows are distinct, so a slice of documents is a list of window numbers,
and each distinct window is aligned once: its groups, and its links, the pairs of an A
and a B token with bytes in common.

In how many documents an id pair is linked is counted over all documents: slices add up
their documents per pair, groups of slices give one row per pair, and rows of a pair meet
once.  The counts come back to the groups of slices as sorted rows, ahead of the slices,
where links are summed per distinct window and then per document; so links of documents
are never rows.  The highest count of an A id is one number per entry of A's vocabulary, the
only table that is broadcast.

Defined results: a null or empty text, or one whose tokens of A or B do not spell it, has no
tokens: zeros and empty groups; strings of special tokens are plain text; repeated rows
are documents of their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.pieces import PieceEncoder
from stayline.llm.texts import mixed, slices, span_hashes
from stayline.sources.shared import saved

#: Bytes of text in a slice and in a group of slices with one table of pairs.
SLICE = 2 << 20
GROUP = 32 << 20
#: Pieces of text that a worker keeps.
HELD_PIECES = 300_000

_BASE_A, _BASE_B = 0xA24BAED4963EE407, 0x9FB21C651E98DF25
_FACTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = PieceEncoder(path_a, True, HELD_PIECES)
        self.a.tokenizer.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=True)
        names = [""] * (max(vocabulary.values()) + 1)
        for name, i in vocabulary.items():
            names[i] = name
        plain = [bytes(map(letters.__getitem__, n)) if letters.keys() >= set(n) else n.encode() for n in names]
        self.bytes_a = pa.array(plain, pa.large_binary())
        self.opens_a = np.array([t[:1] == b" " for t in plain])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        plain = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes_b = pa.array(plain, pa.large_binary())
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.strings = pa.array([f"{i}{sign}" for i in range(most) for sign in ",|;"], pa.large_string())

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray], list[bool]]:
        """Ids of A and B, and whether both spell the text."""
        ids_a = [np.frombuffer(i, "<u4") for i in self.a.encode([" " + (t or "") for t in texts])]
        ids_b = [np.array(i, "<u4") for i in self.b.encode([t or "" for t in texts], num_threads=1)]
        joined = [spelt(self.bytes_a, ids_a), spelt(self.bytes_b, ids_b)]
        wanted = [(" " + t).encode() if t else None for t in texts]
        return ids_a, ids_b, [w is not None and x == w and y == w for w, x, y in zip(wanted, *joined)]


def spelt(table: pa.Array, ids: list[np.ndarray]) -> list[memoryview]:
    """The joined bytes of each text's tokens."""
    flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
    taken = table.take(pa.array(flat))
    _, where, content = taken.buffers()
    ends = np.frombuffer(where, np.int64)[taken.offset: taken.offset + len(flat) + 1]
    content = memoryview(content).cast("B") if content else memoryview(b"")
    at = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int64)
    cuts = ends[at].tolist()
    return [content[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def worker_pair(path_a: str, path_b: str) -> Pair:
    """The tokenizers of this worker process; their tables outlive a task."""
    return Pair(path_a, path_b)


def _inner(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of spans, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _classes(ids: list[np.ndarray], starts: list[np.ndarray], sizes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Representatives of the distinct windows, and the class of each window."""
    hashes = [span_hashes(i, s, s + n, base) for i, s, n, base in zip(ids, starts, sizes, (_BASE_A, _BASE_B))]
    _, first, known = np.unique(mixed(hashes[0]) + hashes[1], return_index=True, return_inverse=True)
    same = first[known]
    for i, s, n in zip(ids, starts, sizes):  # equal hashes, equal ids
        if not (np.array_equal(n, n[same]) and np.array_equal(i[_inner(s, n)], i[_inner(s[same], n)])):
            break
    else:
        return first, known
    table: dict[tuple, int] = {}
    known = np.array([
        table.setdefault(tuple(i[s[w]: s[w] + n[w]].tobytes() for i, s, n in zip(ids, starts, sizes)), len(table))
        for w in range(len(known))], np.int64)
    return np.unique(known, return_index=True)[1], known


class Aligned:
    """The windows of a slice: ids and byte ends of all tokens of the texts that both spell."""

    def __init__(self, pair: Pair, ids_a: list[np.ndarray], ids_b: list[np.ndarray]):
        self.counts = np.array([[len(a), len(b)] for a, b in zip(ids_a, ids_b)], np.int64).reshape(-1, 2)
        none = np.zeros(0, "<u4")
        self.ids = [np.concatenate([none, *ids]) for ids in (ids_a, ids_b)]
        tables = (pair.bytes_a, pair.bytes_b)
        ends = [np.cumsum(np.diff(np.frombuffer(t.buffers()[1], np.int64)[: len(t) + 1])[i]) for t, i in zip(tables, self.ids)]
        first_a = np.concatenate(([0], np.cumsum(self.counts[:, 0])))
        texts = np.concatenate(([0], ends[0]))[first_a]  # where texts begin, in bytes
        at = np.searchsorted(ends[1], ends[0])
        shared = ends[1][at] == ends[0] if len(at) else np.zeros(0, bool)
        # a shared end is an anchor if the next token of A, which starts there as B's does, begins with a space
        opens = pair.opens_a[self.ids[0]]
        anchor = shared & np.append(opens[1:], True) if len(shared) else shared
        last = np.flatnonzero(anchor)
        lasts = [last + 1, at[last] + 1]
        self.starts = [np.concatenate(([0], n))[:-1] for n in lasts]
        self.sizes = [n - s for n, s in zip(lasts, self.starts)]
        window_ends = ends[0][last]
        self.first = np.searchsorted(window_ends, texts[1:], "right")  # windows up to each text
        self.per_text = np.diff(np.concatenate(([0], self.first)))
        self.groups = np.diff(np.concatenate(([0], np.cumsum(shared)))[first_a]) if len(shared) else np.zeros(len(self.counts), np.int64)
        self.representatives, self.classes = _classes(self.ids, self.starts, self.sizes) if len(last) else (last, last)
        self._align(ends)

    def _align(self, ends: list[np.ndarray]) -> None:
        """Links and group ends of the distinct windows, all at once."""
        chosen = self.representatives
        own, stops = [], []
        for k in (0, 1):
            inner = _inner(self.starts[k][chosen], self.sizes[k][chosen])
            lengths = np.diff(np.concatenate(([0], ends[k])))[inner]
            own.append(self.ids[k][inner].astype(np.int64))
            stops.append(np.cumsum(lengths))
        self.own = own
        every = _distinct(np.concatenate(stops))  # between two neighbouring ends lie bytes of one A and one B token
        a, b = (np.searchsorted(s, every) for s in stops)
        after = np.cumsum(self.sizes[0][chosen])
        window = np.searchsorted(after, a, "right")
        self.links = np.bincount(window, minlength=len(chosen)).astype(np.int64)
        self.codes = (own[0][a] << 32) | own[1][b]
        self.closes = np.isin(stops[0], stops[1], assume_unique=True)  # by A token of the distinct windows
        self.closes_b = np.isin(stops[1], stops[0], assume_unique=True)

    def spelled(self, strings: pa.Array) -> list[str]:
        """Groups of each text, ids of A and B, put together from those of its windows.

        The ids of a window, in the order they are written, and the sign behind each (a comma,
        a bar or a semicolon) are found once per distinct window.
        """
        chosen = self.representatives
        group = [np.concatenate(([0], np.cumsum(c)))[:-1] for c in (self.closes, self.closes_b)]
        n = len(self.own[0]) + len(self.own[1])
        # an id of A stands behind all of B in earlier groups, one of B behind all of A up to its group
        places = [np.arange(len(self.own[0])) + np.searchsorted(group[1], group[0], "left"),
                  np.arange(len(self.own[1])) + np.searchsorted(group[0], group[1], "right")]
        written = np.empty(n, np.int64)
        for k, closes in enumerate((self.closes, self.closes_b)):
            written[places[k]] = 3 * self.own[k] + np.where(closes, 1 + k, 0)
        size = self.sizes[0][chosen] + self.sizes[1][chosen]
        inner = _inner((np.cumsum(size) - size)[self.classes], size[self.classes])
        taken = strings.take(pa.array(written[inner]))
        _, where, content = taken.buffers()
        ends = np.frombuffer(where, np.int64)[taken.offset: taken.offset + len(inner) + 1]
        stops = ends[np.concatenate(([0], np.cumsum(size[self.classes])))[self.first]].tolist()
        content = content.to_pybytes() if content else b""
        out, low = [], 0
        for high in stops:
            out.append(content[low: max(high - 1, low)].decode())
            low = high
        return out

    def documents_of(self, codes: np.ndarray, link: np.ndarray) -> np.ndarray:
        """In how many texts of the slice each distinct pair is linked."""
        text = np.repeat(np.arange(len(self.per_text)), self.per_text)
        n = max(len(self.representatives), 1)
        held = _distinct(text * n + self.classes)
        text, kind = held // n, held % n
        first = np.cumsum(self.links) - self.links
        pairs = link[_inner(first[kind], self.links[kind])]
        found = _distinct(np.repeat(text, self.links[kind]) * len(codes) + pairs) if len(codes) else pairs
        return np.bincount(found % max(len(codes), 1), minlength=len(codes))


_SLICES = (
    "part int, chunk int, slice int, doc_ids array<long>, facts array<array<long>>, groups array<string>, n_windows binary, "
    "windows binary, n_links binary, links binary, pairs binary, codes array<long>, counts array<long>")


def _added(codes: np.ndarray, counts: np.ndarray, more: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    every, where = np.unique(np.concatenate((codes, more)), return_inverse=True)
    return every, np.bincount(where, np.concatenate((counts, n)), len(every)).astype(np.int64)


def _align(path_a: str, path_b: str, with_groups: bool, slice_bytes: int, group_bytes: int):
    names = [f.split()[0] for f in _SLICES.split(", ")]
    longs = pa.list_(pa.int64())
    types = [pa.int32(), pa.int32(), pa.int32(), longs, pa.list_(longs), pa.list_(pa.string()), *[pa.binary()] * 5, longs, longs]

    def row(*values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, part = worker_pair(path_a, path_b), TaskContext.get().partitionId()
        none = np.zeros(0, np.int64)
        chunk, size, codes, counts = 0, 0, none, none
        for k, batch in enumerate(slices(batches, "text", slice_bytes)):
            texts = batch.column("text").to_pylist()
            ids_a, ids_b, good = pair.encode(texts)
            nothing = np.zeros(0, "<u4")
            held = Aligned(pair, *([i if g else nothing for i, g in zip(ids, good)] for ids in (ids_a, ids_b)))
            groups = held.spelled(pair.strings)
            if not with_groups:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else g for g in groups]
            pairs, link = np.unique(held.codes, return_inverse=True)
            codes, counts = _added(codes, counts, pairs, held.documents_of(pairs, link))
            sums = np.concatenate(([0], np.cumsum(held.links[held.classes])))
            n_links = sums[held.first] - sums[held.first - held.per_text]
            facts = [held.counts[:, 0].tolist(), held.counts[:, 1].tolist(), held.groups.tolist(), n_links.tolist()]
            packed = [x.astype("<u4").tobytes() for x in (held.per_text, held.classes, held.links, link)] + [pairs.astype("<i8").tobytes()]
            yield row(part, chunk, k, batch.column("doc_id").to_pylist(), facts, groups, *packed, None, None)
            size += sum(map(len, filter(None, texts)))
            if size >= group_bytes:
                yield row(part, chunk, -1, *[None] * 8, codes.tolist(), counts.tolist())
                chunk, size, codes, counts = chunk + 1, 0, none, none
        if len(codes):
            yield row(part, chunk, -1, *[None] * 8, codes.tolist(), counts.tolist())
    return run


def _slices(docs: DataFrame, path_a: str, path_b: str, with_groups: bool, slice_bytes: int, group_bytes: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return saved(rows.mapInArrow(_align(path_a, path_b, with_groups, slice_bytes, group_bytes), _SLICES), large_rows=True)


def _counted(parts: DataFrame) -> DataFrame:
    """``part, chunk, code, n``: the pairs of each group of slices with their documents in the corpus."""
    rows = parts.where("slice < 0").select("part", "chunk", F.explode(F.arrays_zip("codes", "counts")).alias("pair"))
    rows = rows.select("part", "chunk", F.col("pair.codes").alias("code"), F.col("pair.counts").alias("n"))
    return rows.withColumn("n", F.sum("n").over(Window.partitionBy("code")))  # a row per group of slices


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``a, b, n_docs``: in how many documents two ids are linked."""
    rows = _slices(docs, path_a, path_b, False, SLICE, GROUP).where("slice < 0").select(F.explode(F.arrays_zip("codes", "counts")).alias("pair"))
    rows = rows.groupBy(F.col("pair.codes").alias("code")).agg(F.sum("pair.counts").alias("n_docs"))
    return rows.select(F.shiftright("code", 32).alias("a"), F.expr("code & 4294967295").alias("b"), "n_docs")


_OUT = "doc_id long, " + "".join(f"{f} long, " for f in _FACTS) + "n_best long, count_sum long, groups string"


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and slices of groups of slices, counts first, to one row per document."""
    names, long = [f.split()[0] for f in _OUT.split(", ")], pa.int64()
    key, parts, table = None, [], None
    for batch in batches:
        heads = list(zip(batch.column("part").to_pylist(), batch.column("chunk").to_pylist(), batch.column("slice").to_pylist()))
        at = 0
        while at < len(heads):
            if heads[at][:2] != key:
                key, parts, table = heads[at][:2], [], None
            if heads[at][2] < 0:
                end = at + 1
                while end < len(heads) and heads[end] == heads[at]:
                    end += 1
                parts.append([batch.column(c).slice(at, end - at).to_numpy(zero_copy_only=False) for c in ("code", "n", "best")])
                at = end
                continue
            if table is None:
                table = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3
            s = batch.slice(at, 1).to_pylist()[0]
            n_windows, windows, n_links, links = (np.frombuffer(s[c], "<u4").astype(np.int64) for c in ("n_windows", "windows", "n_links", "links"))
            place = np.searchsorted(table[0], np.frombuffer(s["pairs"], "<i8"))
            sums = []
            for values in (table[2].astype(np.int64), table[1].astype(np.int64)):  # by pair, then window, then document
                by_link = np.concatenate(([0], np.cumsum(values[place][links])))
                ends = np.cumsum(n_links)
                by_window = np.concatenate(([0], np.cumsum((by_link[ends] - by_link[ends - n_links])[windows])))
                ends = np.cumsum(n_windows)
                sums.append(by_window[ends] - by_window[ends - n_windows])
            columns = [pa.array(s["doc_ids"], long), *(pa.array(f, long) for f in s["facts"]), *(pa.array(x, long) for x in sums),
                       pa.array(s["groups"], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)
            at += 1


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False,
          slice_bytes: int = SLICE, group_bytes: int = GROUP) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    ``n_links`` are overlapping token pairs, ``count_sum`` the sum of the documents their id
    pairs are linked in, ``n_best`` those whose pair has the most documents of its A id.
    ``groups`` is ``a1,a2|b1;a3|b2`` with ``with_groups``, else its SHA-256.
    """
    parts = _slices(docs, path_a, path_b, with_groups, slice_bytes, group_bytes)
    counted = _counted(parts)
    highest = counted.groupBy(F.shiftright("code", 32).alias("a")).agg(F.max("n").alias("most"))  # at most A's vocabulary
    counted = counted.withColumn("a", F.shiftright("code", 32)).join(F.broadcast(highest), "a")
    counted = counted.select("part", "chunk", F.lit(-1).alias("slice"), "code", "n", (F.col("n") == F.col("most")).alias("best"))
    content = ["doc_ids", "facts", "groups", "n_windows", "windows", "n_links", "links", "pairs"]
    rows = parts.where("slice >= 0").select("part", "chunk", "slice", *content)
    both = counted.unionByName(rows, allowMissingColumns=True).repartition("part", "chunk")
    both = both.sortWithinPartitions("part", "chunk", "slice", "code")
    return both.mapInArrow(_sums, _OUT)
