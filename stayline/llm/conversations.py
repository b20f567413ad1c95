"""Repair of conversations by generalised LR parsing with weighted edits.

A conversation in order is ``(s? (u a)+)?``, as initials of its roles::

    C -> s P | P | (nothing)        P -> P u a | u a

Each row may be kept, given the role user or assistant, or deleted, and empty rows may
be inserted.  The parser keeps a graph-structured stack: stacks share their tails, and
stacks with equal tops are merged into the one of the least (cost, audit), the audit
being the initials of its edits.  Merging is exact, since stacks of one top accept the same
rest, and no audit is the beginning of another one of equal cost: of audits that differ by an
insert alone, one costs more.

The parse is split, so a conversation may hold any share of all rows.  Rows are ranged by
conversation and order; a task parses its range in segments, from every possible top
where rows may come before, and gives the cheapest edits from each top to each other one.
Segments of a conversation are then composed, a few thousand rows at a time.  Equal rows
of one turn count as one row with a number.  Only the repaired text itself, and its digest,
are put together row by row, streamed in order without holding a conversation.

Order: turn (nulls first), then role, then SHA-256 of the text.  Defined results: a null
conversation id is a conversation; a null role or text is one space; no rows give no
conversation, and empty tables empty results; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.texts import slices

#: Rows of a segment; its audits are held once per pair of tops.
SEGMENT = 4096
#: Costs of edits; an undeleted truncated row costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Tables of the grammar: states after a shift, rules completed there (left side is
#: always P) by their length, and states after P.
SHIFT = {(0, "s"): 1, (0, "u"): 3, (1, "u"): 3, (2, "u"): 6, (4, "u"): 6, (3, "a"): 5, (6, "a"): 7}
REDUCE = {5: 2, 7: 3}
GOTO = {0: 2, 1: 4}
ACCEPT = (0, 2, 4)
#: A stack of each top that can stand between two rows: ``(state, stack below)``.
_EMPTY = (0, None)
STACKS = {0: _EMPTY, 1: (1, _EMPTY), 2: (2, _EMPTY), 3: (3, _EMPTY), 4: (4, (1, _EMPTY)), 6: (6, (2, _EMPTY))}

_WHITE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}


def shifted(stack, symbol: str):
    """The stack after a symbol and all reductions, or None."""
    state = SHIFT.get((stack[0], symbol))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in REDUCE:
        for _ in range(REDUCE[stack[0]]):
            stack = stack[1]
        stack = (GOTO[stack[0]], stack)
    return stack


#: A front holds, by top: cost, rank of the audit among all tops, letters since the last
#: row, linked letters before, stack.
def start(top: int) -> dict:
    return {top: (0, 0, "", None, STACKS[top])}


def with_inserts(front: dict) -> dict:
    """The front after any cheapest number of inserts."""
    front, todo = dict(front), list(front.values())
    while todo:
        cost, rank, letters, before, stack = todo.pop()
        for symbol in "ua":
            new = shifted(stack, symbol)
            if new is not None:
                found = (cost + INSERT, rank, letters + "I", before, new)
                have = front.get(new[0])
                if have is None or found[:3] < have[:3]:
                    front[new[0]] = found
                    todo.append(found)
    return front


def after_row(front: dict, edits: list[tuple[str, str | None, int]]) -> dict:
    """The front after one row with its ``(letter, role initial, cost)`` edits."""
    new: dict = {}
    # an insert before a row that must go can as well stand behind it, and sorts first there
    for cost, rank, letters, before, stack in (front if len(edits) == 1 else with_inserts(front)).values():
        for letter, symbol, price in edits:
            after = stack if symbol is None else shifted(stack, symbol)
            if after is not None:
                found = (cost + price, rank, letters + letter, before, after)
                have = new.get(after[0])
                if have is None or found[:3] < have[:3]:
                    new[after[0]] = found
    order = {key: k for k, key in enumerate(sorted({f[1:3] for f in new.values()}))}
    return {top: (f[0], order[f[1:3]], "", (f[3], f[2]), f[4]) for top, f in new.items()}


def edits_of(initial: str, faulty: bool, truncated: bool) -> list[tuple[str, str | None, int]]:
    if faulty:
        return [("D", None, DELETE)]
    more = TRUNCATED if truncated else 0
    return [("D", None, DELETE), ("K", initial, more), *(("R", r, REROLE + more) for r in "ua" if r != initial)]


def spelled(linked) -> str:
    """Linked letters as text."""
    parts = []
    while linked is not None:
        linked, letters = linked
        parts.append(letters)
    return "".join(reversed(parts))


class _Segment:
    """Counts and fronts of neighbouring rows of one conversation."""

    def __init__(self, conv, seq: int, open_: bool, last=None):
        self.conv, self.seq, self.n = conv, seq, 0
        self.fronts = {top: start(top) for top in (STACKS if open_ else (0,))}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn, role: str, blank: bool, cut: bool, seen: bool, n: int) -> None:
        initial = role[:1]
        truncated = cut and not blank and not seen
        self.blank += n * blank
        self.duplicate += 0 if blank else n - 1 + seen
        self.truncated += truncated
        if self.first is None:
            self.first = initial
        elif self.last + initial not in _LEGAL:
            self.illegal += 1
        self.illegal += n - 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        edits = edits_of(initial, blank or seen, truncated)
        for top, front in self.fronts.items():
            front = after_row(front, edits)
            if n > 1:  # the rest of equal rows must go
                front = {t: (f[0] + DELETE * (n - 1), f[1], "", (f[3], "D" * (n - 1)), f[4]) for t, f in front.items()}
            self.fronts[top] = front
        self.n += 1

    def row(self, part: int) -> list:
        ways = [
            {"entry": entry, "leave": top, "cost": f[0], "audit": spelled(f[3])}
            for entry, front in self.fronts.items() for top, f in front.items()]
        return [self.conv, part, self.seq, self.blank, self.duplicate, self.truncated, self.illegal,
                self.turns, self.low, self.high, self.first, self.last, ways]


_WAYS = pa.list_(pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SEGMENTS = (
    "conv_id long, part int, seq int, blank long, duplicate long, truncated long, illegal long, turns long, low long, "
    "high long, first string, last string, ways array<struct<entry: int, leave: int, cost: long, audit: string>>")
_FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _batch(rows: list[list], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _parse(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments of a range of sorted rows."""
        part, segment = TaskContext.get().partitionId(), None
        long, text = pa.int64(), pa.string()
        types = [long, pa.int32(), pa.int32(), long, long, long, long, long, long, long, text, text, _WAYS]
        names = [f.split()[0] for f in _SEGMENTS[: _SEGMENTS.index(" array")].split(", ")]
        for batch in batches:
            done = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "blank", "cut", "seen", "n")]
            for conv, turn, role, blank, cut, seen, n in zip(*columns):
                if segment is None:  # rows of this conversation may stand in the range before
                    segment = _Segment(conv, 0, True)
                elif segment.conv != conv:
                    done.append(segment.row(part))
                    segment = _Segment(conv, 0, False)
                elif segment.n >= size:
                    done.append(segment.row(part))
                    segment = _Segment(conv, segment.seq + 1, True)
                segment.add(turn, role, blank, cut, seen, n)
            yield _batch(done, types, names)
        if segment is not None:
            yield _batch([segment.row(part)], types, names)
    return run


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts and cheapest audit of conversations from their segments in order."""
    names, types = ["conv_id", *_FACTS, "audit"], [pa.int64()] * (1 + len(_FACTS)) + [pa.string()]
    held, front = None, {}

    def finished() -> list:
        ends = [f for top, f in with_inserts(front).items() if top in ACCEPT]
        cost, _, letters, before, _ = min(ends, key=lambda f: f[:3])
        gaps = held["high"] - held["low"] + 1 - held["turns"] if held["turns"] else 0
        return [held["conv_id"], gaps, *(held[k] for k in _FACTS[1:5]), cost, spelled(before) + letters]

    for batch in batches:
        done = []
        for s in batch.to_pylist():
            if held is None or held["conv_id"] != s["conv_id"]:
                if held is not None:
                    done.append(finished())
                held, front = s, start(0)
            else:
                held["illegal"] += held["last"] + s["first"] not in _LEGAL
                held["turns"] -= s["low"] is not None and s["low"] == held["high"]
                held["low"] = s["low"] if held["low"] is None else held["low"]
                held["high"] = held["high"] if s["high"] is None else s["high"]
                held["last"] = s["last"]
                for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
                    held[k] += s[k]
            new: dict = {}
            for w in s["ways"]:
                have = front.get(w["entry"])
                if have is not None:
                    found = (have[0] + w["cost"], have[1], w["audit"], have[3], STACKS[w["leave"]])
                    best = new.get(w["leave"])
                    if best is None or found[:3] < best[:3]:
                        new[w["leave"]] = found
            order = {key: k for k, key in enumerate(sorted({f[1:3] for f in new.values()}))}
            front = {top: (f[0], order[f[1:3]], "", (f[3], f[2]), f[4]) for top, f in new.items()}
        yield _batch(done, types, names)
    if held is not None:
        yield _batch([finished()], types, names)


def plain(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with one space for a null role or text."""
    return rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """:func:`plain` rows, some of them dropped, emptied, cut, repeated or with a wrong role."""
    place = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = plain(rows).withColumn("kind", F.crc32(F.concat(place[0], F.lit(":"), place[1])) % 20).where("kind != 0")
    kind = F.col("kind")
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))).drop("col")


def _key() -> F.Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key")


def parsed(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """``conv_id``, the faults and the cheapest ``cost, audit`` of every conversation of :func:`plain` rows."""
    end = F.rtrim(F.col("text"), F.lit(_WHITE))
    narrow = rows.select(
        "conv_id", "turn", "role", _key(), (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    narrow = narrow.groupBy("conv_id", "turn", "role", "key", "blank", "cut").agg(F.count("*").alias("n"))
    # rows of one text in several turns: the first one is no duplicate
    first = narrow.groupBy("conv_id", "role", "key").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("places"))
    first = first.where("places > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), "first")
    narrow = narrow.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k")), "left")
    seen = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    narrow = narrow.select("conv_id", "turn", "role", "key", "blank", "cut", seen.alias("seen"), "n")
    order = ["conv_id", "turn", "role", "key"]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order).drop("key")
    segments = ranged.mapInArrow(_parse(size), _SEGMENTS)
    segments = segments.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return segments.mapInArrow(_compose, "conv_id long, " + "".join(f"{f} long, " for f in _FACTS) + "audit string")


class _Replay:
    """Applies an audit to the rows of a conversation, one by one."""

    def __init__(self, audit: str):
        self.audit, self.at, self.asked = audit, 0, "s"

    def _asked(self) -> str:
        return "assistant" if self.asked == "u" else "user"

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role = self._asked()
            self.at, self.asked = self.at + 1, role[0]
            yield "I", role, ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Rows inserted before, and the row unless it goes."""
        yield from self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            role = self._asked() if letter == "R" else role
            self.asked = role[0]
            yield letter, role, text


def _apply(digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        long, text = pa.int64(), pa.string()
        if digests:
            names, types = ["conv_id", *_FACTS, "audit", "repaired_sha256"], [long] * 7 + [text] * 2
        else:
            names, types = ["conv_id", "position", "action", "role", "text"], [long, long, text, text, text]
        replay, head, sha, made = None, None, None, 0
        out: list = []

        def take(rows) -> None:
            nonlocal made
            for letter, role, words in rows:
                if digests:
                    sha.update((("\n" if made else "") + role + ":" + words).encode())
                else:
                    out.append([head["conv_id"], made, letter, role, words])
                made += 1

        def close() -> None:
            if replay is not None:
                take(replay.inserts())
                if digests:
                    out.append([head["conv_id"], *(head["facts"][f] for f in _FACTS), head["text"], sha.hexdigest()])

        for batch in slices(batches, "text"):
            for row in batch.select(["conv_id", "tag", "role", "text", "facts"]).to_pylist():
                if row["tag"] == 0:
                    close()
                    replay, head, sha, made = _Replay(row["text"]), row, hashlib.sha256(), 0
                else:
                    take(replay.row(row["role"], row["text"]))
            yield _batch(out, types, names)
            out.clear()
        close()
        yield _batch(out, types, names)
    return run


def _replayed(original: DataFrame, rows: DataFrame, digests: bool, size: int) -> DataFrame:
    ids = original.select(F.col("conv_id").cast("long").alias("id")).distinct()
    found = ids.join(parsed(rows, size), F.col("id").eqNullSafe(F.col("conv_id")), "left")
    facts = F.struct(*(F.coalesce(f, F.lit(0)).cast("long").alias(f) for f in _FACTS))
    heads = found.select(
        F.col("id").alias("conv_id"), F.lit(0).alias("tag"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit(b"").alias("key"), F.coalesce("audit", F.lit("")).alias("text"), facts.alias("facts"))
    texts = rows.select("conv_id", F.lit(1).alias("tag"), "turn", "role", _key(), "text", F.lit(None).cast(heads.schema["facts"].dataType).alias("facts"))
    both = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "tag", "turn", "role", "key")
    if digests:
        schema = "conv_id long, " + "".join(f"{f} long, " for f in _FACTS) + "audit string, repaired_sha256 string"
    else:
        schema = "conv_id long, position long, action string, role string, text string"
    return both.mapInArrow(_apply(digests), schema)


def repaired(conversations: DataFrame, size: int = SEGMENT) -> DataFrame:
    """``conv_id, position, action, role, text``: rows of the repaired conversations.

    ``action`` is K (kept), R (role changed) or I (inserted); ``size`` is the number of rows
    of a segment.
    """
    rows = plain(conversations)
    return _replayed(conversations, rows, False, size)


def audits(conversations: DataFrame, rows: DataFrame | None = None, size: int = SEGMENT) -> DataFrame:
    """One row per conversation: its faults, cost, audit and SHA-256 of the repaired ``role:text`` lines.

    ``rows`` (see :func:`plain`) are repaired in place of the given ones; a conversation
    without any of them has zeros and an empty audit.
    """
    return _replayed(conversations, plain(conversations) if rows is None else rows, True, size)
