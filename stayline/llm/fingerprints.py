"""Threshold-scaled sketches of documents.

A sketch keeps every distinct five-word shingle whose hash lies below a fixed fraction
of the hash range.  Because the threshold does not depend on the text, the sketch of a
part is a part of the sketch: sketches can be merged (union), and the share of one
sketch found in another estimates containment however unequal the texts are.  A text of
at most ``SMALL`` shingles keeps all of them, with threshold 1; two sketches are
compared at the lower of their thresholds.

A fingerprint is text: the threshold's denominator, a colon, and the kept hashes
(their top 32 bits scaled to the threshold, 8 hex digits each) in ascending order.

Each document is also compared with the next one in ascending id.  Texts move once, to
ranges of ids; the first document of a range is sent to the range before it as well.

Defined results: a null or blank text has an empty sketch, like itself (1) and unlike
any other (0); a text under five words has one shingle; equal ids are ordered by text;
null ids come first; the only document of a table is its own next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.texts import U, Words, shingles, slices

SHINGLE, DENOMINATOR, SMALL = 5, 4, 128
#: Documents per range of ids, on average; the number of ranges is bounded, their size is not.
RANGE, MOST_RANGES = 250, 10_000
#: Stands for a null id, which comes first.
LEAST = -(1 << 63)

_PRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, contained_in_edited double, contained_in_next double"
)


def sketches(texts: list[str | None], size: int = SHINGLE, denominator: int = DENOMINATOR) -> list[tuple[int, np.ndarray]]:
    """Denominator of the threshold and ascending 32-bit hashes of each text."""
    hashes, text = shingles(Words.of(pa.array(texts, pa.large_string())), size)
    hashes = hashes >> U(32)
    # distinct shingles by text
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    counts = np.bincount(text, minlength=len(texts))
    small = counts <= SMALL
    keep = small[text] | (hashes < U((1 << 32) // denominator))
    hashes, text = hashes[keep], text[keep]
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    return [(1 if s else denominator, hashes[a:b]) for s, a, b in zip(small.tolist(), cuts, cuts[1:])]


def to_text(sketch: tuple[int, np.ndarray]) -> str:
    return f"{sketch[0]}:" + sketch[1].astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> tuple[int, np.ndarray]:
    denominator, _, hashes = fingerprint.partition(":")
    return int(denominator), np.frombuffer(bytes.fromhex(hashes), ">u4").astype(U)


def _lowered(sketch: tuple[int, np.ndarray], denominator: int) -> np.ndarray:
    if sketch[0] == denominator:
        return sketch[1]
    return sketch[1][: np.searchsorted(sketch[1], U((1 << 32) // denominator))]


def merge(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
    """Sketch of two texts taken together."""
    denominator = max(a[0], b[0])
    return denominator, np.union1d(_lowered(a, denominator), _lowered(b, denominator))


def compare(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> tuple[float, float]:
    """Estimates of the Jaccard similarity and of the share of ``a`` contained in ``b``."""
    if a[0] == b[0] and np.array_equal(a[1], b[1]):
        return 1.0, 1.0
    denominator = max(a[0], b[0])
    x, y = _lowered(a, denominator), _lowered(b, denominator)
    both = len(np.intersect1d(x, y, assume_unique=True))
    union = len(x) + len(y) - both
    return (both / union if union else 0.0), (both / len(x) if len(x) else 0.0)


def _places(bounds: list[int]):
    edges = np.array(bounds, np.int64)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.searchsorted(edges, batch.column("doc_id").to_numpy(), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column("doc_id")], ["place", "doc_id"])
    return places


def _deal(bounds: list[int], sent: dict[int, list[int]]):
    """Each row to its range, and the first id of a range also to the range before."""
    edges, firsts = np.array(bounds, np.int64), np.array(list(sent), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.column("doc_id"), batch.column("text")
            known = pa.compute.fill_null(ids, LEAST).to_numpy()
            place = np.searchsorted(edges, known, "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), ids, text, pa.array(np.zeros(len(ids), bool))], _DEALT)
            for i in np.flatnonzero(np.isin(known, firsts)):
                before = sent[int(known[i])]
                again = pa.array([i] * len(before), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(before, pa.int32()), ids.take(again), text.take(again), pa.array([True] * len(before))], _DEALT)
    return deal


_DEALT = ["place", "doc_id", "text", "ahead"]


def _print(size: int, denominator: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last document, whose next one is still to come
        for batch in slices(batches, "text", 2 << 20):
            place, ids = batch.column("place").to_pylist(), batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ahead = batch.column("ahead").to_pylist()
            rows = list(zip(place, ids, texts, ahead, sketches(texts, size, denominator)))
            rows = ([held] if held else []) + rows
            held = rows[-1]
            # rows whose next document is the row behind them; of several sent ahead the first counts
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[3]]
            if not pairs:
                continue
            edited = []
            for (_, _, text, _, _), (_, _, behind, _, _) in pairs:
                half = len(text) // 2
                edited.append(text[: len(text) - half] + behind[:half])
            out = []
            for (a, b), text, sketch in zip(pairs, edited, sketches(edited, size, denominator)):
                near, held_in = compare(a[4], sketch)
                near_next, held_next = compare(a[4], b[4])
                out.append((a[1], len(a[2]), hashlib.sha256(text.encode()).hexdigest(), to_text(a[4]), to_text(sketch),
                            near, near_next, held_in, held_next))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], _NAMES)
    return prints


_NAMES = [c.split()[0] for c in _PRINTS.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.float64()] * 4


def compare_with_next(docs: DataFrame, size: int = SHINGLE, denominator: int = DENOMINATOR) -> DataFrame:
    """Fingerprints of ``docs(doc_id, text)`` and of edited texts, and how alike they are.

    The edited text has the last half of the characters replaced by as many from the
    start of the next document.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    ids = docs.select(F.coalesce("doc_id", F.lit(LEAST)).alias("doc_id"))
    n = min(MOST_RANGES, max(1, ids.count() // RANGE))
    shares = [k / n for k in range(1, n)]
    bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 100_000)).first()[0] or [])) if shares else []
    found = ids.mapInArrow(_places(bounds), "place int, doc_id long").groupBy("place").agg(F.min("doc_id").alias("first")).collect()
    ranges = sorted((r["place"], r["first"]) for r in found)  # one row per range
    sent: dict[int, list[int]] = {}
    for (here, _), (_, first) in zip(ranges, ranges[1:] + ranges[:1]):
        sent.setdefault(first, []).append(here)
    dealt = docs.mapInArrow(_deal(bounds, sent), "place int, doc_id long, text string, ahead boolean")
    dealt = dealt.repartition("place").sortWithinPartitions("place", "ahead", "doc_id", "text")
    return dealt.mapInArrow(_print(size, denominator), _PRINTS)
