"""The three boosted-tree models, their probabilities and the importance of their inputs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline import config as c
from stayline.operators import boosting
from stayline.operators.encoding import category_statistics, ordered_statistics, with_statistics
from stayline.operators.rollup import USER
from stayline.sources.shared import saved


@dataclass(frozen=True)
class ModelSpec:
    """Parameters of one model; ``nominal`` reads categories as target statistics."""

    params: dict = field(default_factory=dict)
    nominal: bool = False


# Learning rate, rounds, depth, leaves, sampling, penalties, leaf sizes,
# metrics and patience.
MODELS = {
    "gbt_a": ModelSpec({
        "growth": "leaf", "stepSize": 0.05, "maxIter": 1000, "maxLeaves": 127, "maxDepth": 1 << 30,
        "minInstancesPerNode": 200, "columnRate": 0.8, "subsamplingRate": 0.8, "resampleEvery": 5,
        "l1": 0.1, "l2": 0.1, "metrics": ("auc_roc", "auc_pr"), "patience": 50, "seed": c.SEED,
    }),
    "gbt_b": ModelSpec({
        "growth": "depth", "stepSize": 0.05, "maxIter": 1000, "maxDepth": 6, "minHessian": 50.0,
        "columnRate": 0.8, "subsamplingRate": 0.8, "l1": 0.1, "l2": 0.1,
        "metrics": ("auc_roc",), "patience": 50, "seed": c.SEED,
    }),
    "gbt_c": ModelSpec({
        "growth": "symmetric", "stepSize": 0.05, "maxIter": 500, "maxDepth": 7, "l2": 3.0,
        "metrics": ("auc_roc",), "patience": 50, "seed": c.SEED,
    }, nominal=True),
}


@dataclass
class Model:
    """Trees, and the statistics ``feature, code, value`` their categories are read as."""

    trees: boosting.Trees
    statistics: DataFrame | None = None


def dictionary_sizes(dictionary: DataFrame) -> dict[str, int]:
    """Number of codes per category: one row per categorical feature."""
    return {r.feature: r.n for r in
            dictionary.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}


def row_key() -> Column:
    """A number that names a store row."""
    return F.xxhash64(USER, "snapshot_date", "milestone_day")


def train(spec: ModelSpec, train_rows: DataFrame, valid_rows: DataFrame, features,
          sizes: dict[str, int], **overrides) -> Model:
    """Fit one model on encoded rows, up to its best round on the validation rows.

    With a nominal model a train row reads its categories from the rows before it in a
    random order, all other rows from all train rows.
    """
    params = boosting.Params(**{**spec.params, **overrides})
    statistics = None
    if spec.nominal:
        names = [x for x in features if x in sizes]
        statistics = saved(category_statistics(train_rows, names))
        valid_rows = with_statistics(valid_rows, statistics, names)
        train_rows = saved(ordered_statistics(train_rows, names, params.seed))  # boosting reads them four times
    return Model(boosting.fit(train_rows, valid_rows, features, c.LABEL, row_key(), params), statistics)


def model_inputs(model: Model, encoded: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Encoded rows as the trees read them."""
    if model.statistics is None:
        return encoded
    return with_statistics(encoded, model.statistics, [x for x in model.trees.inputs if x in sizes])


def probability(model: Model, encoded: DataFrame, features,
                sizes: dict[str, int], nominal: bool, output: str) -> DataFrame:
    """Probability of removal, added as a column."""
    own = {x: F.col(x).alias(f"_in_{x}") for x in sizes if x in encoded.columns} if nominal else {}
    rows = model_inputs(model, encoded.select("*", *own.values()), sizes if nominal else {})
    scored = boosting.with_margin(model.trees, rows, "_margin")
    return scored.select(
        *(F.col(f"_in_{x}").alias(x) if x in own else F.col(x) for x in encoded.columns),
        (1 / (1 + F.exp(-F.col("_margin")))).alias(output),
    )


def save_model(model: Model, path: str) -> None:
    """Statistics and trees; ``metadata`` is written last."""
    spark = SparkSession.getActiveSession()
    if model.statistics is not None:
        model.statistics.write.mode("overwrite").parquet(f"{path}/statistics")
    model.trees.save(spark, path)


def load_model(path: str, nominal: bool = False) -> Model:
    spark = SparkSession.getActiveSession()
    statistics = spark.read.parquet(f"{path}/statistics") if nominal else None
    return Model(boosting.Trees.load(spark, path), statistics)


def rounds(spark: SparkSession, models: dict[str, Model]) -> DataFrame:
    """``model, rounds_run, best_round, auc_roc, auc_pr, loss``: what the validation rows said."""
    rows = []
    for name, model in models.items():
        best = next((h for h in model.trees.history if h["round"] == model.trees.best_round), {})
        rows.append((name, len(model.trees.history), model.trees.best_round, *(best.get(k) for k in ("auc_roc", "auc_pr", "loss"))))
    return spark.createDataFrame(
        rows, "model string, rounds_run int, best_round int, auc_roc double, auc_pr double, loss double")


# --- importance ------------------------------------------------------------


def importance_sample(encoded: DataFrame, rows: int, seed: int = c.SEED) -> DataFrame:
    """A fixed pseudo-random sample of at most ``rows`` rows."""
    return encoded.orderBy(_random_order(seed), *c.STORE_KEY).limit(rows)


def _random_order(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), USER, "snapshot_date", "milestone_day")


def feature_importance(model: Model, encoded: DataFrame, features,
                       sizes: dict[str, int], nominal: bool = False,
                       rows: int | None = None) -> DataFrame:
    """Mean absolute contribution of every input to the margin.

    All rows count; with ``rows`` a sample of that size.
    """
    if rows is not None:
        encoded = importance_sample(encoded, rows)
    return boosting.mean_contributions(model.trees, model_inputs(model, encoded, sizes if nominal else {}))


def impurity_importance(spark: SparkSession, model: Model, features) -> DataFrame:
    """The trees' own importance: total gain per feature, normalised."""
    gains = model.trees.gains()
    return spark.createDataFrame([(x, gains[x]) for x in features], "feature string, importance double")


def top(importance: DataFrame, n: int = 20) -> DataFrame:
    """The most important features."""
    return importance.orderBy(F.desc("importance"), "feature").limit(n)
