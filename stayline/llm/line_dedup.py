"""Removal of repeated multi-line chunks with content-defined boundaries.

A line ends a chunk where a rolling hash over the hashes of the last ``window`` lines is
divisible by ``mean``, so boundaries follow the content: lines put in before a passage
shift no boundary inside it.  A chunk of several lines, not all blank, that stands in
more than one place is kept in its first place (smallest document id, then position) and
removed elsewhere.  Chunks with one hash are found on narrow rows; their texts are then
compared byte by byte.  Only DataFrame and SQL functions run here.

A chunk is held as its lines, each with ``x`` before it; the line ``b`` parts chunks, so
no content can be taken for a boundary.

Defined results: a null text stays null and has no lines; a row with a null id keeps all
and takes nothing; repeated rows, or rows that share an id, do not remove each other's
chunk in the same position, and what goes from one text of an id stays in its others
unless repeated there; a text whose chunks are all removed is empty; all other
columns are kept whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEAN, WINDOW, BASE = 3, 2, 31


def _let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once for all its uses in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _chunks(text: str, mean: int, window: int, base: int):
    """Expression for the chunks of a text column, null for a null text."""
    rolled = "hashes"
    for back in range(1, window):
        # hashes of the lines ``back`` lines earlier, 0 before the first
        rolled = (
            f"zip_with({rolled}, slice(concat(array_repeat(0L, {back}), hashes), 1, size(hashes)),"
            f" (a, b) -> a + {base ** back} * b)")
    # the end of a text ends its last chunk in any case
    ends = f"transform({rolled}, (r, i) -> i < size(hashes) - 1 AND r % {mean} = 0)"
    marked = f"array_join(zip_with(lines, {ends}, (x, e) -> concat('x', x, if(e, '\nb', ''))), '\n')"
    hashes = "transform(lines, x -> cast(conv(substr(md5(x), 1, 7), 16, 10) AS bigint))"
    whole = _let("lines", f"split({text}, '\n', -1)", _let("hashes", hashes, f"split({marked}, '\nb\n', -1)"))
    return F.expr(f"if({text} IS NULL, NULL, {whole})")


def remove_repeated_chunks(docs: DataFrame, mean: int = MEAN, window: int = WINDOW, base: int = BASE) -> DataFrame:
    """``docs`` with shorter texts and counts of lines.

    Returns ``row`` (the given columns with the new text, as a struct), ``text``, ``n_lines``
    and ``n_removed``.  A text moves once, as its chunks.
    """
    chunks = _chunks("text", mean, window, base).alias("chunks")
    others = F.struct(F.lit(0).alias("_no_column"), *[c for c in docs.columns if c != "text"])
    # rows may share an id, so a place is in a text of an id
    place = [F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("key")]
    rows = docs.select(others.alias("row"), *place, chunks)
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(*place, chunks)
    several = F.expr("filter(transform(chunks, (c, i) -> struct(i AS pos, c AS chunk)), p -> contains(p.chunk, '\\n') AND p.chunk RLIKE '(^|\\n)x[^\\n]*[^\\\\s][^\\n]*')")
    hashed = F.transform(several, lambda p: F.struct(p["pos"].alias("pos"), F.xxhash64(p["chunk"]).alias("hash")))
    # the outer form, for the inner one would evaluate its argument twice
    places = known.select("doc", "key", F.explode_outer(hashed).alias("p")).select("doc", "key", "p.*").where("pos IS NOT NULL")
    again = places.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    found = places.join(again, "hash", "left_semi").groupBy("doc", "key").agg(F.collect_set("pos").alias("at"))
    texts = known.join(found, ["doc", "key"]).select("doc", "key", F.explode(F.expr("transform(at, p -> struct(p AS pos, chunks[p] AS chunk))")).alias("p"))
    texts = texts.select("doc", "key", "p.*")
    firsts = texts.groupBy("chunk").agg(F.min(F.struct("doc", "pos")).alias("first"), F.count("*").alias("n")).where("n > 1")
    removed = texts.join(firsts, "chunk").where("struct(doc, pos) != first").groupBy("doc", "key").agg(F.collect_set("pos").alias("removed"))
    kept = rows.join(removed, ["doc", "key"], "left").select(
        "row", "chunks", F.expr("array_except(sequence(0, size(chunks) - 1), coalesce(removed, cast(array() AS array<int>)))").alias("keep"))
    kept = kept.select("row", F.expr("if(chunks IS NULL, 0, size(split(array_join(chunks, '\\n'), '\\n', -1)))").alias("n_lines"),
                       F.expr("if(chunks IS NULL, NULL, array_join(transform(keep, i -> chunks[i]), '\\n'))").alias("left"))
    new = F.expr("substr(replace(concat('\\n', left), '\\nx', '\\n'), 2)")
    return kept.select(
        F.struct(*[new.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]).alias("row"),
        new.alias("text"), F.col("n_lines").cast("long").alias("n_lines"),
        F.expr("cast(n_lines - if(left IS NULL OR left = '', 0, size(split(left, '\\n', -1))) AS long)").alias("n_removed"))
