"""The trie encoder against the library."""

import hashlib
import random
from collections import Counter

import public_tokenizers
from odd import ODD_TEXTS, odd_rows
from tokenizers import Tokenizer

from stayline.llm import bpe
from stayline.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_texts_equal_library(docs):
    plain, encoder = Tokenizer.from_file(PATH), bpe.TextEncoder(PATH, held=500)
    rng = random.Random(3)
    letters = "etaoinshrdlucmfwypvbgkqjxz"
    signs = [*letters, "the", "ing", " ", " ", "\n", "É", "ß", "́", "'s", "12", "…", "<|endoftext|>", "İ", "Σ", "\x1d"]
    texts = ODD_TEXTS + [r.text for r in docs.limit(60).collect()]
    texts += ["".join(rng.choices(signs, k=rng.randint(1, 30))) for _ in range(4000)]
    for at in range(0, len(texts), 100):
        part = texts[at: at + 100]
        for text, (n, ids, decoded) in zip(part, encoder.encode(part)):
            want = plain.encode(text or "", add_special_tokens=False).ids
            assert ids == " ".join(map(str, want)), repr(text)
            assert n == len(want) and decoded == plain.decode(want, skip_special_tokens=False)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_and_odd_rows(spark, sf_dir, docs, odd):
    plain = Tokenizer.from_file(PATH)
    for rows, texts in ((QUERIES["op9_bpe"](spark, sf_dir).collect(), [(r.doc_id, r.text) for r in docs.collect()]),
                        (bpe.encode_decode(odd, PATH, True).collect(), odd_rows())):
        want = Counter()
        for doc, text in texts:
            ids = plain.encode(text or "", add_special_tokens=False).ids
            want[(doc, len(ids), digest(" ".join(map(str, ids))), digest(plain.decode(ids, skip_special_tokens=False)))] += 1
        assert Counter(map(tuple, rows)) == want
    one = bpe.encode_decode(odd.where("doc_id = 7"), PATH).first()
    assert one.ids == plain.encode(" lead", add_special_tokens=False).ids and one.decoded == plain.decode(one.ids)
    assert bpe.encode_decode(odd.limit(0), PATH).count() == 0
