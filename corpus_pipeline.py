"""Documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import jaccard_join, line_dedup, packing, pii, toxicity
from stayline.llm.queries import tokenizer
from stayline.sources.shared import saved


def _with_text(changed: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns of ``row`` with its new text and length."""
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return changed.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean(docs, toxicity.fit(docs, labels))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks go from all places but the first."""
    return _with_text(line_dedup.remove_repeated_chunks(docs), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the name of their kind."""
    return _with_text(pii.redact(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: A trained classifier, a forest of signatures and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written once to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
