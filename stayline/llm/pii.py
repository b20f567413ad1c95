"""Personal data by fixed patterns and by contexts learned from what these find.

Base spans are the leftmost non-overlapping matches of four patterns with checks.  They
seed a bipartite graph of lexical patterns (the words around a span) and instances (the
value of a span).  Loosely shaped strings that are no base spans (``name (at) host``,
numbers without a plus, card numbers that fail their check digit, IPv6) hang in the same
graph, unscored.  Spark scores it round by round: a pattern is as sure of a kind as the
share of its instances known to be of that kind, given enough of them; an unknown
instance is as sure as its patterns together, and counts for further patterns in the
next round.  Unknown spans in a sure pattern are added.

Positions are code points, ends exclusive.  Defined results: a null or empty text has no
spans; repeated rows are returned each, with equal spans; null ids are kept; extra
columns are ignored by :func:`find` and kept by :func:`redact`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.texts import column_of, slices
from stayline.sources.shared import saved

KINDS = ("email", "ip", "card", "phone")
#: Rounds of scoring, known instances that a pattern needs, and how sure it must be to add spans.
ROUNDS, SUPPORT, SURE = 3, 5, 0.7

# Possessive forms of the given patterns: same matches, linear time.  The part before an
# at sign is found backwards; a digit run that fails as a whole fails from any later digit.
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Loose shapes of the kinds
_LOOSE_EMAIL = re.compile(
    r"(?<![\w.%+-])[\w.%+-]{1,64}(?: ?[(\[]at[)\]] ?[\w-]{1,64}(?: ?(?:\.|[(\[]dot[)\]]) ?[\w-]{1,64}){0,4}"
    r"| at [\w-]{1,64}(?: dot [\w-]{1,64}){1,4}|@[\w-]{1,64})")
_LOOSE_IP = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![\w:])")
_LOOSE_PHONE = re.compile(r"(?<![\w.+-])\(?[0-9]{2,4}\)?(?:[ ./-][0-9]{2,4}){1,4}(?![\w-]|\.[0-9])")
_AROUND = 80  # characters in which the words around a span are sought


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the checked matches, by start and kind."""
    found = []
    if "@" in text:
        free = 0
        for m in _HOST.finditer(text):
            start = m.start()
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                found.append((start, 0, m.end()))
                free = m.end()
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _digits(m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def loose_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Loosely shaped strings that touch no base span nor each other; the leftmost wins."""
    found = []
    if "@" in text or " at " in text or "(at)" in text or "[at]" in text:
        found += [(m.start(), 0, m.end()) for m in _LOOSE_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        if ":" in text:
            found += [(m.start(), 1, m.end()) for m in _LOOSE_IP.finditer(text)]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(_digits(m.group())) <= 19:
                found.append((m.start(), 2, m.end()))
        for m in _LOOSE_PHONE.finditer(text):
            if 7 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    if not found:
        return []
    out, free = [], 0
    edges = iter(sorted(taken))
    base = next(edges, None)
    for start, kind, end in sorted(found):
        while base and base[2] <= start:
            base = next(edges, None)
        if start >= free and not (base and base[0] < end):
            out.append((start, kind, end))
            free = end
    return out


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span: two words before it, one on either side, a label before it."""
    plain = lambda w: _DIGIT.sub("0", w.lower())
    line = text.rfind("\n", max(0, start - _AROUND), start) + 1
    before = text[max(line, start - _AROUND): start].split()
    stop = text.find("\n", end, end + _AROUND)
    after = text[end: stop if stop >= 0 else end + _AROUND].split()
    left, right = ["^", "^", *map(plain, before)][-2:], plain(after[0]) if after else "$"
    out = [f"2 {left[0]} {left[1]}", f"1 {left[1]} _ {right}"]
    if left[1][-1] in ":=#":
        out.append(f"0 {left[1]}")
    return out


_MENTION = "struct<kind:int,start:int,end:int,seed:boolean,value:binary,patterns:array<string>>"
_ARROW = pa.list_(pa.struct([
    ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()), ("value", pa.binary()), ("patterns", pa.list_(pa.string()))]))


def _identity(value: str) -> bytes:
    """Hash of a whole value, without regard to case."""
    return hashlib.blake2b(value.lower().encode(), digest_size=16).digest()


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            here = [(s, k, e, True) for s, k, e in base] + [(s, k, e, False) for s, k, e in loose_spans(text, base)]
            rows.append([
                {"kind": k, "start": s, "end": e, "seed": seed, "value": _identity(text[s:e]), "patterns": patterns(text, s, e)}
                for s, k, e, seed in sorted(here)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(rows, _ARROW)], ["doc_id", "text_key", "mentions"])


def _sure_patterns(mentions: DataFrame, rounds: int, support: int) -> DataFrame:
    """``pattern, kind, sure`` of patterns that know enough instances of a kind."""
    rows = mentions.select(F.explode("mentions").alias("m")).select("m.kind", "m.seed", "m.value", F.explode("m.patterns").alias("pattern"))
    edges = rows.groupBy("pattern", "kind", "value").agg(F.max("seed").alias("seed"))
    # a pattern needs this many values of a kind, known or yet to be found, and something unknown, to add anything in any round
    useful = edges.groupBy("pattern", "kind").agg(F.count("*").alias("values"), F.sum((~F.col("seed")).cast("int")).alias("unknown"))
    useful = useful.groupBy("pattern").agg(F.max("values").alias("values"), F.sum("unknown").alias("unknown")).where((F.col("values") >= support) & (F.col("unknown") > 0))
    edges = saved(edges.join(useful.select("pattern"), "pattern"))
    scores = edges.where("NOT seed").select("kind", "value", F.lit(0.0).alias("score")).distinct()
    for _ in range(rounds):
        known = edges.join(scores, ["kind", "value"], "left").withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0))))
        kinds = known.groupBy("pattern", "kind").agg(F.sum("score").alias("sum"), F.count(F.when(F.col("score") >= 0.5, 1)).alias("have"), F.count("*").alias("n"))
        all_ = kinds.groupBy("pattern").agg(F.sum("n").alias("all"))
        sure = saved(kinds.join(all_, "pattern").where(F.col("have") >= support).select(
            "pattern", "kind", (F.col("sum") / (F.col("all") + 1)).alias("sure")))
        scores = saved(edges.where("NOT seed").join(sure, ["pattern", "kind"]).groupBy("kind", "value").agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("sure"))))).alias("score")))
    return sure


def find(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, least: float = SURE) -> DataFrame:
    """``doc_id, text_key, base, added`` of every row of ``docs(doc_id, text)``.

    ``base`` and ``added`` are arrays of ``(start, kind, end)``, ``kind`` counting in ``KINDS``.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    rows = saved(rows.mapInArrow(_mentions, f"doc_id long, text_key long, mentions array<{_MENTION}>"))
    sure = _sure_patterns(rows, rounds, support).where(F.col("sure") >= least).select("pattern", "kind")
    loose = rows.select("doc_id", "text_key", F.explode(F.expr("filter(mentions, m -> NOT m.seed)")).alias("m"))
    loose = loose.select("doc_id", "text_key", "m.*").withColumn("pattern", F.explode("patterns"))
    added = loose.join(sure, ["pattern", "kind"]).groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(F.struct("start", "kind", "end"))).alias("added"))
    base = rows.select("doc_id", "text_key", F.expr("transform(filter(mentions, m -> m.seed), m -> struct(m.start, m.kind, m.end))").alias("base"))
    same = (base["doc_id"].eqNullSafe(added["doc_id"])) & (base["text_key"] == added["text_key"])
    none = F.expr("cast(array() AS array<struct<start:int,kind:int,end:int>>)")
    return base.join(added, same, "left").select(base["doc_id"], base["text_key"], "base", F.coalesce("added", none).alias("added"))


def listed(spans: str):
    """``kind:start:end`` of an array of spans, in order, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform(sort_array({spans}), s -> concat_ws(':', array({names})[s.kind], s.start, s.end)), ',')")


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "row.text"):
        out = []
        for text, spans in zip(column_of(batch, "row.text").to_pylist(), batch.column("spans").to_pylist()):
            if text is None or not spans:
                out.append(text)
                continue
            parts, at, shown = [], 0, -1
            for s in spans:
                if s["start"] >= at or shown < 0:
                    parts += [text[at: s["start"]], f"[{KINDS[s['kind']].upper()}]"]
                    shown = s["kind"]
                at = max(at, s["end"])  # overlapping spans become one mark
            out.append("".join(parts) + text[at:])
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "text"])


def redact(docs: DataFrame, **how) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct) and ``text`` with spans replaced by their kind."""
    spans = find(docs, **how).select("doc_id", "text_key", F.sort_array(F.concat("base", "added")).alias("spans")).where(F.size("spans") > 0)
    # repeated rows have equal spans
    spans = spans.groupBy("doc_id", "text_key").agg(F.first("spans").alias("spans"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
    same = rows["id"].eqNullSafe(spans["doc_id"]) & (rows["key"] == spans["text_key"])
    joined = rows.join(spans, same, "left").select("row", "spans")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_redacted, f"row {kind}, text string")
