"""Base spans against the given patterns, learned contexts on made texts, redaction."""

import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
from odd import ODD_TEXTS, odd_rows

from stayline.llm import pii
from stayline.llm.queries import QUERIES

GIVEN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    out = []
    for kind, pattern in enumerate(GIVEN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = [True, all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else None,
                    14 <= len(digits) <= 19 and pii.luhn(digits), 10 <= len(digits) <= 15][kind]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_given_patterns(docs):
    rng = random.Random(6)
    signs = ["a", "b.c", "@", "@x.yz", ".", "-", "+1", "+", " ", "(", ")", "12", "255", "300", "0", "4579480381617288", "1.2.3.4", "é", "\n", "%", "00"]
    texts = ODD_TEXTS + [r.text for r in docs.collect()] + ["".join(rng.choices(signs, k=rng.randint(1, 22))) for _ in range(20_000)]
    for text in texts:
        assert pii.base_spans(text or "") == plain(text), repr(text)


def test_long_texts_are_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "+1" + "(" * 300_000, "1." * 150_000, "a@b" * 100_000, "1 " * 150_000, "ab:" * 100_000, "x at " * 60_000):
        spans = pii.base_spans(text)
        pii.loose_spans(text, spans)


def text_of(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_query_and_odd_rows(spark, sf_dir, docs, odd):
    for rows, texts in ((QUERIES["op10_pii"](spark, sf_dir).collect(), [(r.doc_id, r.text) for r in docs.collect()]),):
        by = {r.doc_id: r for r in rows}
        assert len(rows) == len(texts)
        for doc, text in texts:
            want, r = plain(text), by[doc]
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want) for i in range(4)]
            assert r.base_sha256 == hashlib.sha256(text_of(want).encode()).hexdigest()
            assert set(filter(None, text_of(want).split(","))) <= set(r.spans.split(","))
    found = pii.find(odd).collect()
    assert Counter(r.doc_id for r in found) == Counter(d for d, _ in odd_rows())
    out = pii.redact(odd)
    assert Counter((r.row.doc_id, r.text) for r in out.collect()) == Counter(odd_rows())
    assert out.select("row.*").columns == odd.columns
    assert pii.find(odd.limit(0)).count() == 0 and pii.redact(odd.limit(0)).count() == 0


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(2)
    rows = [(i, f"lorem {i} write to: user{i}@mail{i % 5}.example.com soon") for i in range(30)]
    rows += [(100 + i, f"ipsum my phone: +1 (555) 555-{1000 + i} thanks") for i in range(30)]
    hidden = {200: "write to: bob (at) host (dot) org soon", 201: "my phone: 555-867-5309 thanks", 202: "reach me write to: eve at corp dot net now"}
    fine = {300: "we look at the 2020-2021 season, dot by dot", 301: "score 555-867-5309 unrelated numbers", 302: "version 12-34-5678 of it"}
    rows += list(hidden.items()) + list(fine.items())
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, base string, spans int")
    found = {r.doc_id: r for r in pii.find(frame).collect()}
    for doc, text in rows:
        assert [tuple(s) for s in found[doc].base] == plain(text)
        assert bool(found[doc].added) == (doc in hidden), (doc, found[doc])
    assert found[201].added[0].kind == 3 and hidden[201][found[201].added[0].start: found[201].added[0].end] == "555-867-5309"
    red = {r.row.doc_id: r.text for r in pii.redact(frame).collect()}
    assert red[200] == "write to: [EMAIL] soon" and red[300] == fine[300] and red[100] == "ipsum my phone: [PHONE] thanks"


def test_contexts_of_found_values_find_more(spark):
    rows = [(i, f"lorem {i} write to: user{i}@mail{i % 5}.example.com soon") for i in range(30)]
    # ten unseen values stand in a context of seeds and in one that has no seed at all
    rows += [(100 + i, f"lorem write to: pal{i} (at) host{i} (dot) org soon") for i in range(10)]
    rows += [(200 + i, f"ipsum {i} ping me: pal{i} (at) host{i} (dot) org thanks") for i in range(10)]
    rows += [(300, "ipsum ping me: eve (at) corp (dot) net thanks"), (301, "we stayed (at) home thanks")]
    found = {r.doc_id: r.added for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    one = {r.doc_id: r.added for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), rounds=1).collect()}
    assert all(len(found[d]) == 1 for d in [*range(100, 110), *range(200, 210), 300]) and not found[301]
    assert not one[300]
    assert rows[50][1][found[300][0].start: found[300][0].end] == "eve (at) corp (dot) net"


def test_long_values_are_told_apart():
    texts = ["a" * 300 + "1@x.org", "A" * 300 + "1@x.org", "a" * 300 + "2@x.org"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text_key": [1, 2, 3], "text": texts})
    values = [m["value"] for out in pii._mentions(iter([batch])) for row in out.column("mentions").to_pylist() for m in row]
    assert values[0] == values[1] != values[2]
