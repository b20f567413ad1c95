"""Line chunks against plain Python and SQL."""

import hashlib

from compare import differences, duck
from odd import odd_rows

from stayline.llm import line_dedup
from stayline.llm.queries import ORACLE_SQL, QUERIES


def chunks(text, mean=line_dedup.MEAN, window=line_dedup.WINDOW, base=line_dedup.BASE):
    lines = text.split("\n")
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, held = [], []
    for i, line in enumerate(lines):
        held.append(line)
        if sum(hashes[i - k] * base ** k for k in range(window) if i >= k) % mean == 0:
            out.append(held)
            held = []
    return out + [held] if held else out


def brute(rows):
    first, out = {}, []
    for doc, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for pos, chunk in enumerate(chunks(text)):
            if len(chunk) > 1 and any(x.strip() for x in chunk):
                first.setdefault(tuple(chunk), (doc, pos))
    for doc, text in rows:
        if text is None:
            out.append((doc, None, 0, 0))
            continue
        parts = chunks(text)
        kept = [c for p, c in enumerate(parts) if doc is None or first.get(tuple(c), (doc, p)) == (doc, p)]
        n, left = sum(map(len, parts)), sum(map(len, kept))
        out.append((doc, "\n".join("\n".join(c) for c in kept), n, n - left))
    return sorted(out, key=str)


def test_query_against_sql(spark, sf_dir):
    assert differences(QUERIES["op6_line_dedup"](spark, sf_dir), duck(sf_dir), ORACLE_SQL["op6_line_dedup"]) == []


def test_odd_rows_and_shifted_passages(spark):
    passage = "\n".join(f"line {i} of a passage" for i in range(12))
    rows = odd_rows() + [(100 + i, "\n".join(["own %d %d" % (i, k) for k in range(i)] + [passage, f"end {i}"])) for i in range(6)]
    rows += [(200, "x\nb\nx"), (201, "x\nb\nx"), (202, "b\nb\nb\n"), (203, "\n" * 30), (204, "\n" * 30), (205, "a\r\nb c\nb" * 9), (206, "a\r\nb c\nb" * 9)]
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, chunks string, row int")
    out = line_dedup.remove_repeated_chunks(frame)
    got = sorted((tuple(r) for r in out.select("row.doc_id", "text", "n_lines", "n_removed").collect()), key=str)
    assert got == brute(rows)
    assert out.select("row.*").columns == frame.columns
    assert line_dedup.remove_repeated_chunks(frame.limit(0)).count() == 0


def test_other_text_of_the_same_id_keeps_its_chunks(spark):
    passage = "\n".join(f"line {i} of a passage" for i in range(40))
    clean = "\n".join(f"clean line {i}" for i in range(40))
    rows = [(1, passage), (5, passage), (5, clean), (5, clean), (5, "own\n" + passage), (6, clean)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.remove_repeated_chunks(frame).select("row.doc_id", "text", "n_lines", "n_removed")
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute(rows)
    assert got.count((5, clean, 40, 0)) == 2


def test_boundaries_resist_shifts():
    found = total = 0
    for k in range(60):
        passage = [f"line {i} of passage {k}" for i in range(12)]
        sets = []
        for shift in range(4):
            text = "\n".join([f"own {shift} {i}" for i in range(shift)] + passage + ["end"])
            sets.append({tuple(c) for c in chunks(text) if len(c) > 1})
        found += sum(map(len, set.intersection(*sets)))
        total += len(passage)
    assert found > 0.4 * total  # lines in chunks that every shift shares


def test_native(spark, docs):
    plan = line_dedup.remove_repeated_chunks(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
