"""Aligned tokens against the libraries and a plain walk over byte offsets."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from odd import odd_rows
from tokenizers import Tokenizer

from stayline.llm import alignment as c
from stayline.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    names = {i: n for n, i in a.get_vocab().items()}
    letters = c.byte_letters()
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def tokens(text):
        if not text:
            return [], []
        ids = a.encode(" " + text, add_special_tokens=False).ids
        left = [(i, bytes(letters[x] for x in names[i])) for i in ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        same = all(b"".join(t for _, t in side) == whole for side in (left, right))
        return (left, right) if same else ([], [])

    return tokens


def ends(side):
    out, at = [], 0
    for i, t in side:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def brute(docs, tokens):
    held, counts = [], Counter()
    for doc, text in docs:
        left, right = map(ends, tokens(text))
        links, j = [], 0
        for i, a0, a1 in left:
            while right[j][2] <= a0:
                j += 1
            k = j
            while k < len(right) and right[k][1] < a1:
                links.append((i, right[k][0]))
                k += 1
        counts.update(set(links))
        shared = sorted({e for *_, e in left} & {e for *_, e in right})
        sides = []
        for side in (left, right):
            groups = defaultdict(list)
            for i, _, end in side:
                groups[int(np.searchsorted(shared, end))].append(str(i))
            sides.append([",".join(groups[k]) for k in range(len(shared))])
        held.append((doc, len(left), len(right), len(shared), links, ";".join(f"{x}|{y}" for x, y in zip(*sides))))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return Counter(
        (doc, n_a, n_b, n_groups, len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), groups)
        for doc, n_a, n_b, n_groups, links, groups in held), counts


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def rows_of(frame):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in frame.collect())


def test_odd_and_made_texts(spark, libraries):
    rng = random.Random(6)
    signs = [*"aeinorst", "the", "ing", " ", " ", "  ", "\n", "É", "ß", "é", "日本", "😀", "'s", "12", "…", "<|endoftext|>", "<s>", "▁", "<0x41>", "\t", "\x00", "ﬁ"]
    docs = odd_rows() + [(100 + k, "".join(rng.choices(signs, k=rng.randint(1, 40)))) for k in range(250)]
    frame = spark.createDataFrame([(*d, 1, "x", 3) for d in docs], "doc_id long, text string, slice int, groups string, part int")
    want, counts = brute(docs, libraries)
    assert sum(1 for d in want if d[1]) > 150 and any(not d[1] and d[0] is not None and d[0] >= 100 for d in want)
    for slice_bytes, group_bytes in ((1 << 20, 1 << 24), (300, 900)):
        found = rows_of(c.align(frame.repartition(3), A, B, True, slice_bytes, group_bytes))
        assert found == want
    pairs = {(r.a, r.b): r.n_docs for r in c.pair_counts(frame, A, B).collect()}
    assert pairs == dict(counts)
    assert c.align(frame.limit(0), A, B).count() == 0


def test_classes_by_ids(monkeypatch):
    """Windows with equal hashes but different ids stay apart."""
    ids = [np.array([5, 6, 5, 6, 7, 5], "<u4"), np.array([1, 1, 2, 1], "<u4")]
    starts, sizes = [np.array([0, 2, 4, 5]), np.array([0, 1, 2, 3])], [np.array([2, 2, 1, 1]), np.array([1, 1, 1, 1])]
    want = [0, 0, 1, 2]
    for hashes in (c.span_hashes, lambda i, s, e, base: np.ones(len(s), np.uint64)):
        monkeypatch.setattr(c, "span_hashes", hashes)
        chosen, known = c._classes(ids, starts, sizes)
        names = {k: i for i, k in enumerate(dict.fromkeys(known.tolist()))}
        assert [names[k] for k in known.tolist()] == want and len(chosen) == 3
        assert all(known[r] == k for k, r in enumerate(chosen.tolist()))


def test_query(spark, sf_dir, docs, libraries):
    want, _ = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], libraries)
    rows = QUERIES["op11_alignment"](spark, sf_dir).withColumnRenamed("groups_sha256", "groups")
    assert rows_of(rows) == Counter({(*k[:-1], digest(k[-1])): n for k, n in want.items()})
