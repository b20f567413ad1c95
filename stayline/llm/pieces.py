"""Ids of whole texts by a tokenizer file, with each distinct piece of text encoded once.

A text is cut at single spaces.  The cuts are exact for the two kinds of tokenizer
used here, so ids of a text are the ids of its pieces in a row:

* ``spaced`` (byte-level with its own split pattern): a space starts the next piece.
  A piece whose space is preceded and followed by white space could belong to a
  longer run; a text with such a piece is encoded as a whole.
* otherwise white space separates words and is dropped.

The pieces of a batch are numbered by Arrow, so that only its distinct ones become Python
strings; ids of whole texts are gathered by number.  Pieces are kept in two generations of
bounded size, so frequent ones stay when the table is full.  Of missing ones, letters and the
signs behind them are apart for the splitter too: words of letters go straight to the
tokenizer's model.
"""

from __future__ import annotations

import os
from array import array
from codecs import charmap_decode
from functools import lru_cache
from string import ascii_letters, punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stayline.llm.texts import give_back

#: Distinct pieces per generation; beyond it the younger one becomes the old one.
HELD = 300_000
#: Bytes of text to encode at a time: more have fewer distinct pieces in proportion.
SLICE = 8 << 20
#: Signs behind a word; an apostrophe may begin a piece of its own.
SIGNS = punctuation.replace("'", "")


class PieceEncoder:
    """Little-endian unsigned 32-bit ids of texts."""

    def __init__(self, path: str, spaced: bool, held: int = HELD):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.space = " " if spaced else ""
        self.spaced, self.held = spaced, held
        self.after: dict[str, bytes] = {}  # pieces behind a space
        self.bare: dict[str, bytes] = {}  # pieces at the start of a text or line
        self.older: dict[int, dict[str, bytes]] = {0: {}, 1: {}}  # behind a space or not: the generation before
        self.model = self.tokenizer.model
        #: letters whose form is known, and how the model shows a byte of them
        self.plain = set(ascii_letters)
        shown_as = [chr(b) if b < 0x80 else "\ufffe" for b in range(0x100)]  # U+FFFE: not known, an error
        for char in filter(str.isalpha, map(chr, range(0x80, 0x250))):
            low = char if spaced else char.lower()
            if low.isalpha() and max(low) < "\u0250":  # lower case may be beyond them
                self.plain.add(char)
                shown = self.tokenizer.pre_tokenizer.pre_tokenize_str(low)[0][0].removeprefix("Ġ")
                for byte, sign in zip(low.encode(), shown):
                    shown_as[byte] = sign
        self.shown_as = "".join(shown_as)
        self.lead = "Ġ" if spaced else ""

    def forget(self) -> None:
        """Free the tables: workers live on, and what a stage has learned must not count against the next one."""
        self.after, self.bare, self.older = {}, {}, {0: {}, 1: {}}
        give_back()

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _words(self, words: list[str], space: str) -> list[bytes]:
        """Ids of words of plain letters."""
        text, lead, tokenize = " ".join(words), self.lead if space else "", self.model.tokenize
        shown = charmap_decode((text if self.spaced else text.lower()).encode(), "strict", self.shown_as)[0].split()
        return [array("I", [t.id for t in tokenize(lead + w)]).tobytes() for w in shown]

    def _fill(self, table: dict[str, bytes], wanted: list[str], space: str) -> None:
        """Encode what is missing; a word and the signs behind it are put together."""
        words, rest, ended, stems, plain = [], [], [], [], self.plain.issuperset
        for piece in wanted:
            word = piece if piece.isalpha() else piece.rstrip(SIGNS)
            if not word or not plain(word):
                rest.append(piece)
            elif word is piece:
                words.append(piece)
            else:
                ended.append(piece)
                stems.append(word)
        words = list(dict.fromkeys(words) | dict.fromkeys(w for w in stems if w not in table))
        table.update(zip(words, self._words(words, space)))
        table.update(zip(rest, self._encoded([space + piece for piece in rest])))
        tails = [piece[len(word):] for piece, word in zip(ended, stems)]
        new = list(set(tails) - self.bare.keys())
        self.bare.update(zip(new, self._encoded(new)))
        bare = self.bare
        table.update((piece, table[word] + bare[tail]) for piece, word, tail in zip(ended, stems, tails))

    def _learn(self, missing: list[str], table: dict[str, bytes], space: str) -> None:
        """Add pieces to a table; the end of a line and the start of the next are put together."""
        older = self.older[int(table is self.after)]
        if older:
            table.update((p, older[p]) for p in missing if p in older)
            missing = [p for p in missing if p not in older]
        lines = {}
        for piece in missing if self.spaced else ():
            if "\n" not in piece:
                continue
            left, _, right = piece.partition("\n")
            if left and right and not any(map(str.isspace, left + right)):
                lines[piece] = (left, right)
        if lines:
            starts = {"\n"} | {right for _, right in lines.values()}
            self._fill(self.bare, list(starts - self.bare.keys()), "")
            ends = {left for left, _ in lines.values()}.difference(table, missing)
            missing = [p for p in missing if p not in lines] + list(ends)
        self._fill(table, missing, space)
        for piece, (left, right) in lines.items():
            table[piece] = table[left] + self.bare["\n"] + self.bare[right]

    def _known(self, pieces: list[str], table: dict[str, bytes], space: str) -> list[bytes]:
        """Ids of each distinct piece."""
        found = list(map(table.get, pieces))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if missing:
            self._learn([pieces[k] for k in missing], table, space)
            for k in missing:
                found[k] = table[pieces[k]]
        return found

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text; a null text has none."""
        if len(self.after) + len(self.bare) > self.held:
            self.older = {0: self.bare, 1: self.after}
            self.after, self.bare = {}, {}
        column = pc.fill_null((texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string()), "")
        if not len(column):
            return []
        cut = pc.split_pattern(column if self.spaced else pc.replace_substring(column, "\n", " "), " ")
        first = cut.offsets.to_numpy().astype(np.int64)
        numbers = cut.flatten().dictionary_encode()
        pieces, at, whole = numbers.dictionary.to_numpy(zero_copy_only=False).tolist(), numbers.indices.to_numpy().astype(np.int64), []
        if self.spaced:
            # heads get numbers of their own, behind those of all pieces
            heads, inverse = np.unique(at[first[:-1]], return_inverse=True)
            ids = self._known([pieces[k] for k in heads.tolist()], self.bare, "")
            at[first[:-1]] = len(pieces) + inverse
            used = np.zeros(len(pieces) + len(heads), bool)
            used[at] = True
            odd = [k for k, p in enumerate(pieces) if (not p or p[0].isspace()) and used[k]]
            if odd:
                whole = np.unique(np.searchsorted(first, np.flatnonzero(np.isin(at, odd)), "right") - 1).tolist()
                used[odd] = False
            after = np.flatnonzero(used[: len(pieces)]).tolist()
            entries = [b""] * len(pieces) + ids
            for k, found in zip(after, self._known([pieces[k] for k in after], self.after, self.space)):
                entries[k] = found
        else:
            entries = self._known(pieces, self.after, self.space)
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        counts = sizes[at]
        ends = np.concatenate(([0], np.cumsum(counts)))
        places = np.repeat((np.cumsum(sizes) - sizes)[at] - ends[:-1], counts)
        places += np.arange(len(places))
        raw, edges = np.frombuffer(b"".join(entries), "<u4")[places].tobytes(), (4 * ends[first]).tolist()
        out = [raw[a:b] for a, b in zip(edges, edges[1:])]
        for k, ids in zip(whole, self._encoded([column[k].as_py() for k in whole])):
            out[k] = ids
        return out


@lru_cache(maxsize=1)
def worker_encoder(path: str, spaced: bool) -> PieceEncoder:
    """The encoder of this worker process; a task should :meth:`~PieceEncoder.forget` its tables."""
    return PieceEncoder(path, spaced)
