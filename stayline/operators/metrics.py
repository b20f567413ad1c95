"""Ranking and threshold metrics of binary scores, for any number of rows.

Scores are first grouped, so equal scores are one row; a curve is a running
total over the groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayline import config as c
from stayline.operators.running import BUCKETS, running_totals
from stayline.sources.shared import saved

def score_groups(scored: DataFrame, by=(), score: str = "score", label: str = "label") -> DataFrame:
    """Positives and negatives per distinct score."""
    return scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum(F.lit(1) - F.col(label).cast("long")).alias("neg"),
    )


def ranking_curve(groups: DataFrame, by=(), buckets: int = BUCKETS) -> DataFrame:
    """Groups with ``pos_ge`` and ``neg_ge``: counts at this score or above."""
    steps = [i / buckets for i in range(1, buckets)]
    # At most `buckets` numbers come to the driver.
    borders = groups.approxQuantile("score", steps, 1 / (2 * buckets)) if steps else []
    return running_totals(
        groups, "score", sorted(set(borders)), {"pos_ge": "pos", "neg_ge": "neg"}, by,
        descending=True,
    )


def ranking_metrics(scored: DataFrame, by=(), score: str = "score",
                    label: str = "label") -> DataFrame:
    """ROC AUC (ties count half) and step-wise average precision."""
    curve = ranking_curve(saved(score_groups(scored, by, score, label)), by)
    sums = curve.groupBy(*by).agg(
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
        # Twice the number of ordered pairs, as an exact integer.
        F.sum(F.expr("cast(neg AS decimal(18, 0)) * cast(2 * pos_ge - pos AS decimal(19, 0))"))
        .alias("pairs"),
        F.sum(F.expr("CASE WHEN pos > 0 THEN pos * (pos_ge / (pos_ge + neg_ge)) ELSE 0D END"))
        .alias("precisions"),
    )
    return sums.select(
        *by,
        F.expr("CASE WHEN p > 0 AND n > 0 THEN"
               " round(cast(pairs AS double) / 2 / p / n, 4) END").alias("auc_roc"),
        F.expr("CASE WHEN p > 0 THEN round(precisions / p, 4) ELSE 0D END").alias("auc_pr"),
    )


def confusion_metrics(scored: DataFrame, by=(), threshold: float = 0.5, score: str = "score",
                      label: str = "label") -> DataFrame:
    """Precision, recall and F1 at a threshold, 0 when undefined."""
    hit, true = f"{score} >= {threshold}", f"{label} = 1"
    counts = scored.groupBy(*by).agg(
        F.expr(f"count_if({hit} AND {true})").alias("tp"),
        F.expr(f"count_if({hit})").alias("hits"),
        F.expr(f"count_if({true})").alias("p"),
    )

    def ratio(a: str, b: str):
        return F.expr(f"CASE WHEN {b} > 0 THEN round({a} / {b}, 4) ELSE 0D END")

    return counts.select(
        *by,
        ratio("tp", "hits").alias("precision"),
        ratio("tp", "p").alias("recall"),
        ratio("2 * tp", "(hits + p)").alias("f1"),
    )


def model_metrics(scored: DataFrame, **columns) -> DataFrame:
    """All metrics per ``model``."""
    threshold = confusion_metrics(scored, ("model",), **columns)
    return ranking_metrics(scored, ("model",), **columns).join(threshold, "model")


def model_selection(metrics: DataFrame, metric: str = c.SELECTION_METRIC,
                    order=c.MODEL_NAMES) -> DataFrame:
    """Models from best to worst; the first of equals in ``order`` wins."""
    place = F.array_position(F.lit(list(order)), F.col("model"))
    best = Window.partitionBy(F.lit(1)).orderBy(F.desc(metric), place)
    rank = F.row_number().over(best)
    return metrics.withColumn("rank", rank).withColumn(
        "is_best", (F.col("rank") == 1).cast("int")
    )


def segment_analysis(scored: DataFrame, score: str = "score", label: str = "label",
                     bins=None, include_lowest: bool = False) -> DataFrame:
    """Rows, actual and predicted rate per bin of a few features.

    Bins are open below and closed above.  ``include_lowest`` closes the first
    bin of each feature below as well.
    """
    bins = bins or c.SEGMENT_BINS
    pairs = ", ".join(f"'{x}', cast({x} AS double)" for x in bins)
    long = scored.select(
        F.col(label).alias("actual"), F.col(score).alias("pred"),
        F.expr(f"stack({len(bins)}, {pairs}) AS (feature, value)"),
    )
    segment = F.lit(None).cast("string")
    for feature, parts in bins.items():
        for i, (low, high, name) in enumerate(parts):
            above = F.col("value") > low
            if include_lowest and i == 0:
                above = F.col("value") >= low
            segment = F.when(
                (F.col("feature") == feature) & above & (F.col("value") <= high), name
            ).otherwise(segment)
    return (
        long.withColumn("segment", segment)
        .where("segment IS NOT NULL")
        .groupBy("feature", "segment")
        .agg(F.count(F.lit(1)).alias("n"),
             F.round(F.avg("actual"), 3).alias("actual"),
             F.round(F.avg("pred"), 3).alias("pred"))
    )
