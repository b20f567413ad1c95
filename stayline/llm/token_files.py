"""Token ids as byte or bit planes, compressed plane by plane, with a chunk index.

Documents are put in ascending order of their id (nulls first, then equal ids by text)
and cut into chunks of whole documents.  A chunk holds its document ids and lengths, and
its ids in blocks of fixed size: each block is transposed into planes (the first bytes
of all ids, then the second bytes, or single bits) and every plane is compressed with
zstandard on its own; high planes of a small vocabulary shrink to nothing.

``folder/chunks`` has one row per chunk, ``folder/index`` its place: first and last
document, number of documents and ids, and how many ids come before it.  Both are written
by Spark's committed Parquet writer, without further compression, because workers can
write plain files only to local disks; so any store works and lost executors leave no
half-written chunks.

Defined results: a null or empty text has the end id alone; repeated rows are written as
often as they occur; an empty table gives empty files; a chunk whose ids do not match
their checksum raises ``ValueError``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.llm.pieces import SLICE, worker_encoder
from stayline.llm.texts import slices

BLOCK = 1 << 16
CHUNK = 1 << 18

_CHUNKS = (
    "part int, chunk int, first_doc long, last_doc long, n_docs int, n_ids long, block_ids int, bits boolean, "
    "doc_ids array<long>, lengths array<int>, crc32 long, planes array<array<binary>>"
)


def to_planes(ids: np.ndarray, bits: bool, compress) -> list[bytes]:
    """One block of unsigned 32-bit ids as compressed planes."""
    bytes_ = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        planes = np.packbits(np.unpackbits(bytes_, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        planes = bytes_.T
    return [compress(np.ascontiguousarray(p).tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int, bits: bool, decompress) -> np.ndarray:
    """The ids of one block."""
    raw = [np.frombuffer(decompress(p), np.uint8) for p in planes]
    if bits:
        flat = np.unpackbits(np.stack(raw), axis=1, count=n, bitorder="little").T
        return np.packbits(flat, axis=1, bitorder="little").reshape(-1).view("<u4")
    return np.ascontiguousarray(np.stack(raw).T).reshape(-1).view("<u4")


def _write(path: str, spaced: bool, end_id: int, block: int, chunk_ids: int, bits: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder, compress = worker_encoder(path, spaced), zstandard.ZstdCompressor(level=3).compress
        end = np.array([end_id], "<u4").tobytes()
        part, chunk = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def row() -> pa.RecordBatch:
            raw = b"".join(held)
            ids = np.frombuffer(raw, "<u4")
            planes = [to_planes(ids[i: i + block], bits, compress) for i in range(0, len(ids), block)]
            values = [part, chunk, docs[0], docs[-1], len(docs), len(ids), block, bits, docs, [len(h) // 4 for h in held], zlib.crc32(raw), planes]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _TYPES)], _NAMES)

        for batch in slices(batches, "text", SLICE):
            for i, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                docs.append(i)
                held.append(ids + end)
                size += len(held[-1]) // 4
                if size >= chunk_ids:
                    yield row()
                    docs, held, size, chunk = [], [], 0, chunk + 1
        encoder.forget()
        if docs:
            yield row()
    return write


_NAMES = [c.split()[0] for c in _CHUNKS.split(", ")]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(),
          pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.list_(pa.list_(pa.binary()))]


def write(docs: DataFrame, folder: str, path: str, spaced: bool = False, end_id: int = 2,
          block: int = BLOCK, chunk_ids: int = CHUNK, bits: bool = False) -> None:
    """Encode ``docs(doc_id, text)`` and write chunks and index below ``folder``."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    chunks = rows.mapInArrow(_write(path, spaced, end_id, block, chunk_ids, bits), _CHUNKS)
    chunks.write.option("compression", "uncompressed").parquet(f"{folder}/chunks")
    spark = docs.sparkSession
    heads = spark.read.schema(_CHUNKS).parquet(f"{folder}/chunks").select("part", "chunk", "first_doc", "last_doc", "n_docs", "n_ids")
    # one row per part in the global sum, one part in each other window
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    index = heads.join(parts, "part").withColumn("start", F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    index.drop("base").write.parquet(f"{folder}/index")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every chunk: ``part, chunk, first_doc, last_doc, n_docs, n_ids, start``."""
    return spark.read.schema("part int, chunk int, first_doc long, last_doc long, n_docs int, n_ids long, start long").parquet(f"{folder}/index")


def _read(with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for c in batch.to_pylist():
                left, blocks = c["n_ids"], []
                for planes in c["planes"]:
                    n = min(left, c["block_ids"])
                    blocks.append(from_planes(planes, n, c["bits"], decompress))
                    left -= n
                raw = np.concatenate(blocks).tobytes()
                if zlib.crc32(raw) != c["crc32"]:
                    raise ValueError(f"chunk {c['chunk']} of part {c['part']} is damaged")
                lengths = np.array(c["lengths"], np.int64)
                starts = np.cumsum(lengths) - lengths
                parts = [raw[4 * s: 4 * (s + n)] for s, n in zip(starts.tolist(), lengths.tolist())]
                arrays = [pa.array([c["part"]] * len(parts), pa.int32()), pa.array([c["chunk"]] * len(parts), pa.int32()),
                          pa.array(c["doc_ids"], pa.int64()), pa.array(starts), pa.array(lengths),
                          pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                names = ["part", "chunk", "doc_id", "within", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(parts, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)
    return read


def read(spark: SparkSession, folder: str, between: tuple[int, int] | None = None, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of each document in the files.

    ``between`` reads only chunks whose documents may lie in the closed interval.
    """
    chunks, index = spark.read.schema(_CHUNKS).parquet(f"{folder}/chunks"), read_index(spark, folder)
    if between:
        # nulls come first, so a chunk may begin with one
        chunks = chunks.where((F.col("last_doc") >= between[0]) & (F.coalesce("first_doc", F.lit(between[1])) <= between[1]))
    schema = "part int, chunk int, doc_id long, within long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    docs = chunks.mapInArrow(_read(with_ids), schema).join(index.select("part", "chunk", "start"), ["part", "chunk"])
    docs = docs.withColumn("start", F.col("start") + F.col("within")).drop("part", "chunk", "within")
    return docs.where(F.col("doc_id").between(*between)) if between else docs
