"""Best-fit packing planned over a histogram of lengths.

Every text becomes its ids and an end id.  Texts longer than a sequence are cut, the
first piece taking the remainder.  The plan sees only how many pieces there are of
each length (at most ``capacity`` counts): lengths in falling order go to the open
sequences with the least room that still fits, whole groups of equal sequences at a
time.  Pieces then take planned slots by joining on their rank within their length.
Ranks are counted in salted parts of a length, so a length that a third of all pieces
share is spread over many tasks.

Defined results: a null or empty text is one piece with the end id; repeated rows are
packed as often as they occur; a null id is kept; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.pieces import SLICE, worker_encoder
from stayline.llm.texts import slices
from stayline.sources.shared import saved

#: Pieces of one length that are ranked together.
RANKED_TOGETHER = 1_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, spaced: bool, end_id: int, capacity: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, spaced)
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text", SLICE):
            doc, piece, start, length, crc, content = [], [], [], [], [], []
            for i, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                ids += end
                size = len(ids) // 4
                at, n = 0, size % capacity or capacity
                k = 0
                while at < size:
                    part = ids[4 * at: 4 * (at + n)]
                    doc.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        content.append(part)
                    at, n, k = at + n, capacity, k + 1
            arrays = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                      pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(content, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)
        encoder.forget()
    return cut


def pieces(docs: DataFrame, path: str, spaced: bool = True, end_id: int = 0, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of ``docs(doc_id, text)``; ``ids`` as little-endian words."""
    schema = _PIECES + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_cut(path, spaced, end_id, capacity, with_ids), schema)


def best_fit(counts: dict[int, int], capacity: int = 2048) -> list[tuple[int, int, int, int, int, int]]:
    """Slots ``(length, first rank, number, per sequence, first sequence, offset)``.

    Ranks ``first + k`` of a length stand in sequence ``first sequence + k // per`` at
    ``offset + (k % per) * length``.
    """
    open_: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, number of sequences)
    slots, made = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        for room in sorted(r for r in open_ if r >= length):
            groups, open_[room], per = open_[room], [], room // length
            for first, n in groups:
                full = min(n, left // per)
                if full:
                    slots.append((length, rank, full * per, per, first, capacity - room))
                    open_.setdefault(room - per * length, []).append((first, full))
                    left, rank, first, n = left - full * per, rank + full * per, first + full, n - full
                if left and n:
                    slots.append((length, rank, left, left, first, capacity - room))
                    open_.setdefault(room - left * length, []).append((first, 1))
                    left, first, n = 0, first + 1, n - 1
                if n:
                    open_.setdefault(room, []).append((first, n))
            if not left:
                break
        if left:
            per = capacity // length
            full, rest = divmod(left, per)
            if full:
                slots.append((length, rank, full * per, per, made, 0))
                open_.setdefault(capacity - per * length, []).append((made, full))
            if rest:
                slots.append((length, rank + full * per, rest, rest, made + full, 0))
                open_.setdefault(capacity - rest * length, []).append((made + full, 1))
            made += full + bool(rest)
    return slots


def place(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; reads its input twice."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(
        best_fit(counts, capacity), "length long, first long, n long, per long, seq long, at long")
    salts = spark.createDataFrame(
        [(k, -(-n // RANKED_TOGETHER)) for k, n in counts.items()], "length long, salts long")
    salted = pieces.join(F.broadcast(salts), "length")  # one row per length
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("salts"))).drop("salts")
    in_part = Window.partitionBy("length", "salt")
    ranked = salted.withColumn("rank", F.row_number().over(in_part.orderBy("doc_id", "piece")) - 1)
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = ranked.join(sizes, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "salt")
    step = F.lit(10_000).cast("long")
    slots = slots.withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)))
    slots = slots.withColumn("k", F.explode(F.sequence(F.col("low"), F.least(F.col("low") + step, F.col("n")) - 1)))
    slots = slots.select(
        "length", (F.col("first") + F.col("k")).alias("rank"),
        F.expr("seq + k div per").alias("sequence_id"), F.expr("at + k % per * length").alias("offset"))
    return ranked.join(slots, ["length", "rank"]).drop("rank")


def pack(docs: DataFrame, path: str, spaced: bool = True, end_id: int = 0, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)`` with its place; pieces are written once to the shared folder."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return place(saved(pieces(docs, path, spaced, end_id, capacity, with_ids)), capacity).select(names)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, its pieces and its ids in order, from ``pack(..., with_ids=True)``.

    A sequence holds at most ``capacity`` ids, which bounds the lists.
    """
    held = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids"))).alias("held"))
    return held.select(
        "sequence_id", F.expr("transform(held, x -> struct(x.doc_id, x.piece, x.offset, x.length))").alias("pieces"),
        F.expr("aggregate(held, X'', (a, x) -> concat(a, x.ids))").alias("ids"))
