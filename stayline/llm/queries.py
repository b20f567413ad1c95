"""One query per operator, over the whole of its table, and SQL where it can be said in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import alignment, bpe, contamination, conversations, embedding_dedup, fingerprints, jaccard_join, line_dedup, packing, pii, substring_dedup, token_files, toxicity
from stayline.sources.shared import new_folder

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in 13-word windows of an earlier document are removed."""
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of at most 2048."""
    return packing.pack(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


@query
def op8_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as byte planes and read back."""
    folder = new_folder(spark)
    token_files.write(documents(spark, sf_dir), folder, tokenizer("word_bpe_49k.json"))
    return token_files.read(spark, folder)


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    rows = bpe.encode_decode(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), digests=True)
    return rows.withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"})


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited text, and their likeness."""
    return fingerprints.compare_with_next(documents(spark, sf_dir))


@query
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at a cosine of 0.93 and their components over all vectors of a label."""
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL["op4_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
c AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(c.b, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(c.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.a = e.vec_id
"""


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of all documents without repeated multi-line chunks."""
    return line_dedup.remove_repeated_chunks(documents(spark, sf_dir)).select("row.doc_id", "text", "n_lines", "n_removed")


#: Needs ``documents`` rows as table ``d(doc_id, text)``.
LINE_DEDUP_SQL = f"""
l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM d WHERE text IS NOT NULL
), h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM l),
b AS (
  SELECT *, (h + {line_dedup.BASE} * lag(h, 1, 0) OVER (PARTITION BY doc_id ORDER BY i)) % {line_dedup.MEAN} = 0 AS last FROM h
), c AS (
  SELECT doc_id, i, line, coalesce(sum(CAST(last AS INTEGER)) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM b
), k AS (
  SELECT doc_id, pos, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n,
    bool_or(regexp_matches(line, '[^\\s]')) AS words FROM c GROUP BY doc_id, pos
), r AS (
  SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, pos) > 1 AND n > 1 AND words AS gone FROM k
), deduped AS (
  SELECT doc_id, coalesce(string_agg(chunk, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
    CAST(sum(n) AS BIGINT) AS n_lines, CAST(coalesce(sum(n) FILTER (gone), 0) AS BIGINT) AS n_removed
  FROM r GROUP BY doc_id
  UNION ALL SELECT doc_id, text, 0, 0 FROM d WHERE text IS NULL
)"""
ORACLE_SQL["op6_line_dedup"] = f"""
WITH d AS (SELECT doc_id, text FROM documents), {LINE_DEDUP_SQL}
SELECT doc_id, text, n_lines, n_removed FROM deduped
"""


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes, links and groups of all documents at a Jaccard similarity of 0.8."""
    return jaccard_join.near_duplicates(documents(spark, sf_dir)).drop("text_key")


#: Needs ``documents`` rows as table ``d(doc_id, text)``; ids are unique.
JACCARD_SQL = """
w AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i, len(ws) AS n
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d WHERE text IS NOT NULL)
), s AS (
  SELECT DISTINCT doc_id, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS shingle, i, n FROM w
), sh AS (SELECT DISTINCT doc_id, shingle FROM s WHERE i = 1 OR i <= n - 4),
sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(md5(CAST(shingle AS VARCHAR)), '' ORDER BY md5(CAST(shingle AS VARCHAR)))) AS key FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sh a JOIN sh b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT pairs.a, pairs.b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE CAST(pairs.n AS DOUBLE) / (x.n + y.n - pairs.n) >= 0.8
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), cls AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY key) AS class_id FROM sizes),
nl AS (SELECT a, count(*) AS n FROM links GROUP BY a), comp AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
"""
ORACLE_SQL["op7_jaccard_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, text FROM documents), {JACCARD_SQL}
SELECT d.doc_id, coalesce(cls.class_id, d.doc_id) AS class_id, coalesce(nl.n, 0) AS n_links,
  least(d.doc_id, coalesce(comp.b, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(comp.b, d.doc_id)) AS kept
FROM d LEFT JOIN cls ON cls.doc_id = d.doc_id LEFT JOIN nl ON nl.a = d.doc_id LEFT JOIN comp ON comp.a = d.doc_id
"""


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a classifier that learned from rows not held out."""
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of all documents and those added by learned contexts."""
    found = pii.find(documents(spark, sf_dir))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) AS long)").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    spans = found.withColumn("every", F.concat("base", "added"))
    return spans.select("doc_id", *counts, F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("every").alias("spans"))


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, in all documents."""
    rows = alignment.align(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
    return rows.withColumnRenamed("groups", "groups_sha256")


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired texts of all conversations after damage."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.audits(rows, conversations.damaged(rows))


def _edit(way: str, cost: str, letter: str) -> str:
    """SQL of a way (nine digits of cost, then letters) with one more edit."""
    return f"lpad(CAST(CAST(left({way}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({way}, 10) || {letter}"


#: The cheapest ways to stand before any row, behind s, behind u and behind a, by rows.
_STEP = f"""CASE x[1]
  WHEN '2' THEN [w[1], w[2], least(w[3], {", ".join(_edit(f"w[{k}]", "5", "'I'") for k in (1, 2, 4))}), w[4]]
  WHEN '3' THEN [w[1], w[2], w[3], least(w[4], {_edit("w[3]", "5", "'I'")})]
  ELSE [{_edit("w[1]", "2", "'D'")},
    least({_edit("w[2]", "2", "'D'")}, {_edit("w[1]", "CAST(x[6] AS BIGINT)", "'K'")}),
    least({_edit("w[3]", "2", "'D'")}, {", ".join(_edit(f"w[{k}]", "CAST(x[2] AS BIGINT)", "x[3]") for k in (1, 2, 4))}),
    least({_edit("w[4]", "2", "'D'")}, {_edit("w[3]", "CAST(x[4] AS BIGINT)", "x[5]")})] END"""

ORACLE_SQL["op12_conversation_repair"] = f"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([CAST(i AS BIGINT)] || [0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
), g AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place
  FROM conversations
), k AS (
  SELECT g.*, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(place, ''), lambda x: CAST(unicode(x) AS BIGINT)),
    lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS BIGINT) + 1])), 4294967295) % 20 AS kind
  FROM g, crc
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM k WHERE kind <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM d
), s AS (
  SELECT *, left(role, 1) AS r, regexp_extract(text, '([^\\\\x20\\\\x09-\\\\x0D])[\\\\x20\\\\x09-\\\\x0D]*$', 1) AS last,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o
), f AS (
  SELECT *, CASE WHEN last = '' THEN 1 WHEN again THEN 2 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM s
), c AS (
  SELECT conv_id,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal,
    [['000000000', '300000000', '300000000', '300000000']] || flatten(list([['2'], ['3'], e] ORDER BY i)) || [['2'], ['3']] AS steps
  FROM (SELECT *, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS p FROM f) f,
    LATERAL (SELECT CASE WHEN fault IN (1, 2) THEN ['r', '100000000', 'D', '100000000', 'D', '100000000'] ELSE [
      'r', CAST(p + CAST(r <> 'u' AS INTEGER) AS VARCHAR), CASE WHEN r = 'u' THEN 'K' ELSE 'R' END,
      CAST(p + CAST(r <> 'a' AS INTEGER) AS VARCHAR), CASE WHEN r = 'a' THEN 'K' ELSE 'R' END,
      CAST(CASE WHEN r = 's' THEN p ELSE 100000000 END AS VARCHAR)] END AS e)
  GROUP BY conv_id
), a AS (
  SELECT * EXCLUDE (steps, w), CAST(left(w, 9) AS BIGINT) AS cost, substr(w, 10) AS audit
  FROM (SELECT *, list_reduce(steps, lambda w, x: {_STEP}) AS ws FROM c), LATERAL (SELECT least(ws[1], ws[4]) AS w)
), t AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS j
  FROM a WHERE audit <> ''
), n AS (
  SELECT *, sum(CAST(letter <> 'I' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY j) AS i,
    sum(CAST(letter <> 'D' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY j) AS made FROM t
), m AS (
  SELECT n.*, f.r, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text, f.role,
    max(CAST(letter = 'K' AND f.r = 's' AS INTEGER)) OVER (PARTITION BY n.conv_id) AS led
  FROM n LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM n.conv_id AND f.i = n.i WHERE letter <> 'D'
), p AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (made - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || text, chr(10) ORDER BY j)) AS digest FROM m GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents in 10-word windows of benchmark items, and items nearly there."""
    found = contamination.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), slop=2)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"))


#: Lengths of windows are those of items with fewer than 10 words, and 10; a near window
#: has its words, as often as it has them, within 12 consecutive words.
ORACLE_SQL["op13_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents
), q AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE text IS NOT NULL
), w AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, ws[i:i + 9] AS words
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM q WHERE len(ws) > 0)
), lengths AS (SELECT DISTINCT n FROM w), p AS (
  SELECT r, i, n, ws[i:i + n - 1] AS words
  FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d), lengths WHERE i + n - 1 <= len(ws)
), h AS (SELECT DISTINCT r, i, n, item FROM p JOIN w USING (n, words)
), hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM h) GROUP BY r
), it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r
), total AS (SELECT word, count(*) AS n FROM (SELECT unnest(ws) AS word FROM d) GROUP BY word
), kind AS (SELECT DISTINCT list_sort(words) AS words, n + 2 AS span FROM w
), rare AS (
  SELECT k.words, span, arg_min(word, (coalesce(t.n, 0), word)) AS word
  FROM (SELECT words, span, unnest(words) AS word FROM kind) k LEFT JOIN total t USING (word) GROUP BY k.words, span
), place AS (SELECT r, ws, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM d
), near AS (
  SELECT DISTINCT r, words FROM (SELECT r, ws, words, span, unnest(range(greatest(j - span + 1, 1), j + 1)) AS s FROM place JOIN rare USING (word))
  WHERE list_bool_and(list_transform(words, lambda x: len(list_filter(ws[s:s + span - 1], lambda y: y = x)) >= len(list_filter(words, lambda y: y = x))))
), ne AS (SELECT r, count(DISTINCT item) AS n_near FROM near JOIN (SELECT item, list_sort(words) AS words FROM w) USING (words) GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near_items
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r) LEFT JOIN ne USING (r)
"""
