"""Ids by pieces, packing and token files against the library and brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from odd import ODD_TEXTS, odd_rows
from tokenizers import Tokenizer

from stayline.llm import packing, token_files
from stayline.llm.pieces import PieceEncoder, worker_encoder
from stayline.llm.queries import QUERIES

FILES = {"byte_bpe_50k.json": True, "word_bpe_49k.json": False}


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def raw(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("name", FILES)
def test_pieces_equal_whole_texts(name, docs):
    plain, encoder = library(name), PieceEncoder(public_tokenizers.path(name), FILES[name], held=300)
    rng = random.Random(5)
    signs = ["a", "b.", " ", "  ", "\n", "\t", ",", "é", " ", "don't", "<|endoftext|>", "12", "Word", "ß", "́"]
    texts = ODD_TEXTS + [r.text for r in docs.limit(80).collect()]
    texts += ["".join(rng.choices(signs, k=rng.randint(1, 25))) for _ in range(3000)]
    for at in range(0, len(texts), 40):
        part = texts[at: at + 40]
        for text, ids in zip(part, encoder.encode(part)):
            assert ids == raw(plain.encode(text or "", add_special_tokens=False).ids), repr(text)


@pytest.mark.parametrize("name", FILES)
def test_words_with_signs_go_to_the_model(name, monkeypatch):
    plain, encoder = library(name), PieceEncoder(public_tokenizers.path(name), FILES[name])
    rng, seen = random.Random(9), []
    encoded = encoder._encoded
    monkeypatch.setattr(encoder, "_encoded", lambda texts: seen.extend(texts) or encoded(texts))
    words = ["".join(rng.choices("abcÀÉñßøTHE", k=rng.randint(1, 12))) for _ in range(400)]
    texts = [" ".join(w + "".join(rng.choices(".,!#%&*|<>$\"", k=rng.randint(0, 3))) for w in rng.choices(words, k=60)) for _ in range(50)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids == raw(plain.encode(text, add_special_tokens=False).ids), text
    # the library sees runs of signs alone
    assert seen and not any(c.isalpha() for text in seen for c in text)
    # letters whose lower case is elsewhere, an apostrophe, signs in between, special tokens
    odd = ["İstanbul, ȺȾa. ŉ!", "it's, we'll. don''t' a'.", "a.b, c<|endoftext|> <|endoftext|>. x|>", "a\n.b,\n ,c.\nd", "ªº. ʰa, ɏɐ", "", None]
    for text, ids in zip(odd, encoder.encode(odd)):
        assert ids == raw(plain.encode(text or "", add_special_tokens=False).ids), repr(text)


def test_tables_end_with_their_task():
    path = public_tokenizers.path("byte_bpe_50k.json")
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words, some lines\nof a text", None]})
    rows = [r for b in packing._cut(path, True, 0, 2048, False)(iter([batch])) for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == [1, 2]
    encoder = worker_encoder(path, True)
    assert not encoder.after and not encoder.bare and not any(encoder.older.values())
    assert encoder.encode(["some words"]) == [raw(library("byte_bpe_50k.json").encode("some words").ids)]


def check_packing(rows, texts, end_id=0, capacity=2048):
    plain = library("byte_bpe_50k.json")
    want = Counter()
    for doc, text in texts:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [end_id]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(doc, k, a, b - a, zlib.crc32(raw(ids[a:b])))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins), -(-sum(r.length for r in rows) // capacity)


def test_packing_query(spark, sf_dir, docs):
    rows = QUERIES["op5_packing"](spark, sf_dir).collect()
    made, least = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert made <= least + 1


def test_packing_odd_rows_and_ids(spark, odd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack(odd, path, capacity=64, with_ids=True)
    check_packing(packed.collect(), odd_rows(), capacity=64)
    for s in packing.sequences(packed).collect():
        assert len(s.ids) == 4 * sum(p.length for p in s.pieces) <= 256
    assert packing.pack(odd.limit(0), path).count() == 0


def test_best_fit_equals_one_by_one():
    rng = random.Random(1)
    for _ in range(40):
        cap = rng.choice([10, 37, 100])
        lengths = sorted((rng.randint(1, cap) for _ in range(rng.randint(0, 200))), reverse=True)
        rooms = []
        for n in lengths:  # plain best fit of single items
            fits = [i for i, r in enumerate(rooms) if r >= n]
            if fits:
                rooms[min(fits, key=lambda i: rooms[i])] -= n
            else:
                rooms.append(cap - n)
        slots = packing.best_fit(dict(Counter(lengths)), cap)
        assert len({s[4] + k // s[3] for s in slots for k in range(s[2])}) == len(rooms)


@pytest.mark.parametrize("bits", [False, True])
def test_files_round_trip(spark, odd, tmp_path, bits):
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = str(tmp_path / "out")
    token_files.write(odd, folder, path, block=64, chunk_ids=200, bits=bits)
    rows = sorted(token_files.read(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    plain = library("word_bpe_49k.json")
    want = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at = 0
    assert len(rows) == len(want)
    for r, (doc, text) in zip(rows, want):
        ids = raw(plain.encode(text or "", add_special_tokens=False).ids + [2])
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids), r.ids_crc32) == (doc, at, len(ids) // 4, ids, zlib.crc32(ids))
        at += r.n_tokens
    some = token_files.read(spark, folder, between=(4, 6)).collect()
    assert sorted(r.doc_id for r in some) == [4, 5, 6]
    empty = str(tmp_path / "none")
    token_files.write(odd.limit(0), empty, path, bits=bits)
    assert token_files.read(spark, empty).count() == 0


def test_files_query(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in QUERIES["op8_token_planes"](spark, sf_dir).collect()}
    plain, at = library("word_bpe_49k.json"), 0
    for d in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = plain.encode(d.text or "", add_special_tokens=False).ids + [2]
        r = rows[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(raw(ids)))
        at += len(ids)
