"""Byte-pair encoding and decoding by a depth-first walk over a trie of words.

Texts are normalised and split as the tokenizer file says, the distinct words of a
slice form a trie, held as their sorted list, and the trie is walked depth first.  The state of a
node is the last token of the encoding of its prefix: it is the one token that ends
there and forms a valid pair with the last token of the prefix before it, where a pair
is valid if encoding the two tokens' text gives these two tokens.  So the encoding of
a shared prefix is computed once, and a word is read backwards through the states.
Decoding joins the tokens' strings as the file's (absent) decoder does.

Encodings of earlier slices are kept in two generations of bounded size, so frequent pieces
of text stay when a table is full.

Defined results: a null or empty text has no ids and decodes to an empty text; special
tokens written out in a text are found before anything else, as the library does;
repeated rows and null ids are returned; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.texts import slices

#: Distinct pieces of text whose encodings a worker keeps, per generation.
HELD = 300_000
#: Distinct steps of the walk, and pairs of tokens, that are kept.
STEPS = 1_000_000


class TrieEncoder:
    """Encodes words of a BPE file with word ends (``end_of_word_suffix``)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.strings = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings.update({i: t for t, i in self.special.items()})
        self.rank: dict[tuple[str, str], int] = {}
        for k, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.rank.setdefault((left, right), k)
        #: tokens by their symbols: a last symbol that ends a word is a symbol of its own
        self.tokens: dict[str, int] = {}
        starts: set[str] = set()
        for token, i in self.vocab.items():
            ended = self.suffix and token.endswith(self.suffix)
            symbols = token[: -len(self.suffix)] + "\0" if ended else token
            self.tokens[symbols] = i
            starts.update(symbols[:k] for k in range(1, len(symbols) + 1))
        self.starts = starts
        #: steps of the walk by what may still grow into a token, and by token whether
        #: it may follow another one; both are kept until they are ``STEPS``
        self.states: dict[str, dict] = {}
        self.valid: dict[int, dict[int, bool]] = {}
        self.made = 0

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain byte-pair merging, lowest rank first, from the left."""
        symbols, rank = list(symbols), self.rank.get
        while len(symbols) > 1:
            ranks = [rank(pair, 1 << 60) for pair in zip(symbols, symbols[1:])]
            least = min(ranks)
            if least == 1 << 60:
                break
            at = ranks.index(least)
            symbols[at: at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def symbols(self, text: str) -> list[str]:
        """Characters of a word or part; the one before a word end (NUL) carries the suffix."""
        if text.endswith("\0"):
            return [*text[:-2], text[-2] + self.suffix]
        return list(text)

    def _is_valid(self, left: str, token: int) -> bool:
        """Whether a token may follow one (not at a word end): both stay as they are together."""
        right = self.strings[token]
        ended = self.suffix and right.endswith(self.suffix)
        text = left + (right[: -len(self.suffix)] + "\0" if ended else right)
        return self.merged(self.symbols(text)) == [left, right]

    def _state(self, held: str) -> dict:
        """The steps from what may still grow into a token; its text lies under the empty key."""
        state = self.states.get(held)
        if state is None:
            state = self.states[held] = {"": held}
        return state

    def _step(self, state: dict, edge: str) -> tuple[dict, list[tuple[int, int, dict]]]:
        """What may grow after the next symbol, and the tokens that end there, longest first.

        A token comes with the number of its symbols and what is known of tokens before it.
        """
        self.made += 1
        text = state[""] + edge
        ended = text.endswith("\0")
        found = []
        for at in range(len(text) - ended):
            part = text[at:]
            token = self.tokens.get(part)
            # a token counts if its own text encodes to it
            if token is not None and self.merged(self.symbols(part)) == [self.strings[token]]:
                found.append((len(part) - ended, token, self.valid.setdefault(token, {})))
        grows = next((text[at:] for at in range(len(text)) if text[at:] in self.starts), "")
        step = state[edge] = (self._state(grows), found)
        return step

    def encode_words(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct words, each given as its byte-level characters.

        The trie of the words is walked as their sorted list: a word goes on from the node
        it shares with the one before.
        """
        out: dict[str, tuple[int, ...]] = {}
        if self.made > STEPS:
            self.states, self.valid, self.made = {}, {}, 0
        strings = self.strings
        # by depth: the last token of the prefix, how many symbols it takes, what may grow
        last, width, states = [-1], [0], [self._state("")]
        before_word = ""
        for word in sorted(words):
            end = len(word) - 1
            depth, most = 0, min(len(before_word) - 1, end)
            while depth < most and before_word[depth] == word[depth]:
                depth += 1
            del last[depth + 1:], width[depth + 1:], states[depth + 1:]
            before_word = word
            state = states[depth]
            while True:
                # the last character carries the word end: an edge of its own, to a leaf
                edge = word[depth] if depth < end else word[depth] + "\0"
                step = state.get(edge)
                if step is None:
                    step = self._step(state, edge)
                depth += 1
                chosen = size = -1
                for size, token, known in step[1]:
                    before = last[depth - size]
                    if before < 0:
                        ok = size == depth
                    else:
                        ok = known.get(before)
                        if ok is None:
                            ok = known[before] = self._is_valid(strings[before], token)
                            self.made += 1
                    if ok:
                        chosen = token
                        break
                if depth > end:
                    break
                state = step[0]
                last.append(chosen)
                width.append(size)
                states.append(state)
            ids, at = [chosen], depth - size
            while at:
                ids.append(last[at])
                at -= width[at]
            ids.reverse()
            out[word] = tuple(ids)
        return out


_CONTROLS = re.compile("[\x1c-\x1f]")
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")


class TextEncoder:
    """Ids and decoded texts of whole texts."""

    def __init__(self, path: str, held: int = HELD):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)  # for its normaliser and splitter only
        self.normalise = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.trie = TrieEncoder(path)
        self.special = re.compile("(" + "|".join(map(re.escape, self.trie.special)) + ")") if self.trie.special else None
        self.held = held
        self.decimal = {i: str(i) for i in self.trie.strings}
        #: how the splitter shows the bytes of Latin letters
        self.byte_chars: dict[int, str] = {}
        for char in filter(str.isalpha, map(chr, range(0x250))):
            self.byte_chars.update(zip(char.encode(), self.split(char)[0][0]))
        # by piece of text: ids and tokens, each joined by spaces
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, str] = {}
        self.older: tuple[dict[str, str], dict[str, str]] = ({}, {})

    def _parts(self, piece: str) -> list[str | int]:
        """Byte-level words of a piece without white space inside; special tokens as ids."""
        if piece.isascii():
            if piece.isalpha():
                return [piece.lower()]
            if piece[-1] in ".," and piece[:-1].isalpha():
                return [piece[:-1].lower(), piece[-1]]
        elif piece[-1] in ".," and piece[:-1].isalpha():
            return [*self._parts(piece[:-1]), piece[-1]]
        elif piece.isalpha():
            # Latin letters in composed form change by lower case only
            normal = piece.lower() if max(piece) < "\u0250" and is_normalized("NFC", piece) else self.normalise(piece)
            if normal.isalpha() and max(normal) < "\u0250":
                return ["".join([self.byte_chars[b] for b in normal.encode()])]
        out: list[str | int] = []
        for k, part in enumerate(self.special.split(piece) if self.special else [piece]):
            if k % 2:
                out.append(self.trie.special[part])
            elif part:
                out.extend(w for w, _ in self.split(self.normalise(part)))
        return out

    def _learn(self, missing: set[str]) -> None:
        ids, decoded = self.ids, self.decoded
        old_ids, old_decoded = self.older
        known = missing & old_ids.keys()
        ids.update((p, old_ids[p]) for p in known)
        decoded.update((p, old_decoded[p]) for p in known)
        parts = {p: self._parts(p) for p in missing - known}
        decimal, strings = self.decimal, self.trie.strings
        words: dict[str, tuple[str, str]] = {}
        for word, found in self.trie.encode_words({w for ws in parts.values() for w in ws if isinstance(w, str)}).items():
            if len(found) == 1:
                words[word] = (decimal[found[0]], strings[found[0]])
            else:
                words[word] = (" ".join([decimal[i] for i in found]), " ".join([strings[i] for i in found]))
        for piece, ws in parts.items():
            if len(ws) == 1 and isinstance(ws[0], str):
                ids[piece], decoded[piece] = words[ws[0]]
            else:
                shown = [(decimal[w], strings[w]) if isinstance(w, int) else words[w] for w in ws]
                ids[piece], decoded[piece] = " ".join([i for i, _ in shown]), " ".join([d for _, d in shown])

    def encode(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Number of ids, ids and decoded text, each joined by one space, of every text."""
        if len(self.ids) > self.held:
            self.older = (self.ids, self.decoded)
            self.ids, self.decoded = {}, {}
        # white space as the normaliser knows it; four controls are more than that to Python
        cut = [(t or "").split() if not _CONTROLS.search(t or "") else [p for p in _SPACE.split(t) if p] for t in texts]
        wanted: set[str] = set()
        for c in cut:
            wanted.update(c)
        self._learn(wanted.difference(self.ids))
        out = []
        for c in cut:
            ids = " ".join(map(self.ids.__getitem__, c))
            out.append((ids.count(" ") + 1 if ids else 0, ids, " ".join(map(self.decoded.__getitem__, c))))
        return out


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> TextEncoder:
    """The encoder of this worker process; its table outlives a task."""
    return TextEncoder(path)


def _run(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in slices(batches, "text"):
            n, ids, texts = zip(*encoder.encode(batch.column("text").to_pylist()))
            if digests:
                ids, texts = pa.array(map(sha, ids), pa.string()), map(sha, texts)
            else:
                ids = pa.array([list(map(int, i.split())) for i in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), ids, pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every row of ``docs(doc_id, text)``.

    With ``digests`` the last two are SHA-256 of the decimal ids and of the decoded text.
    """
    kind = "string" if digests else "array<int>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _run(path, digests), f"doc_id long, n_tokens long, ids {kind}, decoded string")
