"""From probabilities to risk segments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline import config as c
from stayline.operators import models
from stayline.operators.encoding import apply_ordinal
from stayline.operators.rollup import USER


@dataclass(frozen=True)
class Trained:
    """A model with the dictionary and the inputs it was trained on."""

    model: GBTClassificationModel
    dictionary: DataFrame
    inputs: list[str]


def choose_model(metrics: DataFrame | None, available) -> str:
    """The model marked best in the latest run, else the first available one."""
    available = [m for m in c.MODEL_NAMES if m in available]
    if not available:
        raise RuntimeError("no trained model")
    if metrics is None:
        return available[0]
    best = (
        metrics.where("is_best = 1").orderBy(F.desc("run_id")).select("model").limit(1).collect()
    )
    if best and best[0].model in available:
        return best[0].model
    return available[0]


def risk_segment(probability: str) -> Column:
    """very_high, high, medium or low."""
    segment = F.lit(c.LOWEST_SEGMENT)
    for limit, name in reversed(c.SEGMENT_LIMITS):
        segment = F.when(F.col(probability) >= limit, name).otherwise(segment)
    return segment


def score(snapshot: DataFrame, trained: dict, primary: str) -> DataFrame:
    """Probabilities of every trained model, -1 for the others, and the segment.

    ``trained`` has a model, its dictionary and its inputs by name.  Models that
    share a dictionary share the encoding.
    """
    columns, kept = [], list(snapshot.columns)
    # a day lies in a file or two, and every row costs ten lookups of codes and some hundred trees
    snapshot = snapshot.repartition(USER)
    encodings: list[tuple[DataFrame, list[str]]] = []
    for name in c.MODEL_NAMES:
        output = f"uninstall_prob_{name}"
        columns.append(output)
        if name not in trained:
            snapshot = snapshot.withColumn(output, F.lit(-1.0))
            kept.append(output)
            continue
        for dictionary, names in encodings:
            if dictionary is trained[name].dictionary:
                names.append(name)
                break
        else:
            encodings.append((trained[name].dictionary, [name]))
    for dictionary, names in encodings:
        # Codes replace the categories for these models only.
        originals = [F.col(x).alias(f"_own_{x}") for x in c.CATEGORICAL_FEATURES]
        encoded = apply_ordinal(snapshot.select("*", *originals), dictionary)
        sizes = models.dictionary_sizes(dictionary)
        for name in names:
            output = f"uninstall_prob_{name}"
            encoded = models.probability(
                trained[name].model, encoded, trained[name].inputs, sizes,
                models.MODELS[name].nominal, output,
            )
            kept.append(output)
        snapshot = encoded.select(*[
            F.col(f"_own_{x}").alias(x) if x in c.CATEGORICAL_FEATURES else F.col(x) for x in kept
        ])
    return (
        snapshot.select(
            F.col("snapshot_date").alias("prediction_date"), USER, *columns,
            F.col(f"uninstall_prob_{primary}").alias("uninstall_prob"),
        )
        .withColumn("risk_segment", risk_segment("uninstall_prob"))
    )


def segment_distribution(predictions: DataFrame, probability: str = "uninstall_prob") -> DataFrame:
    """Users per segment and the share of all users at 0.5 or above."""
    segments = predictions.groupBy("risk_segment").agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(F.col(probability) >= 0.5).alias("at_risk"),
    )
    # At most one row per segment; grouping sets add the line of all users.
    return (
        segments.rollup("risk_segment")
        .agg(F.sum("users").alias("users"), F.sum("at_risk").alias("at_risk"))
        .select(
            F.coalesce("risk_segment", F.lit("all")).alias("risk_segment"), "users",
            F.round(F.col("at_risk") / F.col("users"), 6).alias("share_at_risk"),
        )
    )


def mean_probability(predictions: DataFrame) -> DataFrame:
    """Mean probability per model."""
    names = [f"uninstall_prob_{m}" for m in c.MODEL_NAMES] + ["uninstall_prob"]
    return predictions.agg(*[F.avg(n).alias(f"mean_{n}") for n in names])
