"""Words, shingles and hashes of whole Arrow text columns, as numpy arrays.

A word is a run of characters other than space and U+0009 to U+000D.  Hashes are
rolling sums over powers of an odd base modulo 2**64, so the hash of any span is
a difference of two running sums; they are finished with a bit mixer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BYTE, _WORD = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, U)
            steps[0] = 1
            tables.append(np.cumprod(steps))
        have = (tables[0], tables[1])
        if size <= 1 << 24:
            _powers[base] = have
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finish that spreads all bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of each span of values, independent of where it stands."""
    up, down = _power_table(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, U)
    np.cumsum((values.astype(U) + U(1)) * up[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))


def with_space(column: pa.Array) -> pa.Array:
    """Texts (null: empty) with one space after each, as binary."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    return pc.binary_join_element_wise(column, pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))


@dataclass
class Words:
    """Byte spans of all words of a column; ``first[d]`` is the first word of text d."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, letters: bool = False) -> Words:
        """``letters``: runs of ASCII letters, digits and any non-ASCII bytes, in ASCII lower case."""
        spaced = with_space(column)
        _, where, content = spaced.buffers()
        offsets = np.frombuffer(where, np.int64)[spaced.offset: spaced.offset + len(spaced) + 1]
        data = np.frombuffer(content, np.uint8)[offsets[0]: offsets[-1]] if content else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        if letters:
            data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
            blank = ~((data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)))
        else:
            blank = (data == 32) | ((data >= 9) & (data <= 13))
        # every text ends with a space, so words never touch across texts
        edges = np.flatnonzero(np.diff(np.concatenate(([True], blank))) != 0)
        starts, ends = edges[0::2], edges[1::2]
        return cls(data, offsets, starts, ends, np.searchsorted(starts, offsets))

    def hashes(self, most: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first ``most`` bytes."""
        ends = self.ends if most is None else np.minimum(self.ends, self.starts + most)
        return span_hashes(self.data, self.starts, ends, _BYTE)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, ignoring where texts end."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    at = np.arange(n)
    return span_hashes(words, at, at + size, _WORD)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each text and the text of each.

    A text of fewer words, but at least one, has one shingle of all its words.
    """
    hashes, counts = words.hashes(), words.counts()
    runs = window_hashes(hashes, size)
    text = np.repeat(np.arange(len(counts)), np.maximum(counts - size + 1, 0))
    inside = np.repeat(words.first[:-1] - np.concatenate(([0], np.cumsum(np.maximum(counts - size + 1, 0))[:-1])),
                       np.maximum(counts - size + 1, 0)) + np.arange(len(text))
    short = np.flatnonzero((counts > 0) & (counts < size))
    few = span_hashes(hashes, words.first[short], words.first[short + 1], _WORD)
    found = np.concatenate((runs[inside], few))
    text = np.concatenate((text, short))
    order = np.argsort(text, kind="stable") if len(short) else slice(None)
    return found[order], text[order]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column, or a field of a struct column as ``column.field``."""
    top, _, field = name.partition(".")
    column = batch.column(top)
    return pc.struct_field(column, field) if field else column


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a column holds about ``most`` bytes, or one row.

    At the end of a task free memory goes back to the system: workers live on, and
    what one stage has freed must not count against the next one.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(column_of(batch, column)), 0).to_numpy(zero_copy_only=False)
        total, begin = np.cumsum(sizes, dtype=np.int64), 0
        while begin < batch.num_rows:
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
    give_back()


def give_back() -> None:
    """Return the freed memory of this worker to the system, where that is possible."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)
