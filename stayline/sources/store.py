"""Tables on disk: slices of the feature store, baselines, predictions, metrics.

All tables are plain parquet, partitioned so that one slice is one partition.
Replacing a slice is a dynamic partition overwrite: the new files are staged
and swapped in at commit, so a lost executor or a repeated run leaves the same
rows.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline import config as c
from stayline.operators.rollup import DAY, USER, DayTables, Rollup, day_tables
from stayline.sources.events import between_days
from stayline.sources.shared import file_names, remove

SLICE = ("milestone_day", "snapshot_date")


# --- schemas ---------------------------------------------------------------

# Features that are not counts
_TEXT = {*c.CATEGORICAL_FEATURES, "platform"}
_REAL = ("_ratio_7d", "_trend_7d", "_uninstall_rate", "_revenue_7d", "_per_day_7d",
         "_per_session_7d")
_FLAGS = ("is_", "seen_", "visited_", "has_", "used_")
_SMALL = {"payer_flag", "funnel_depth"}


def _feature_type(name: str) -> T.DataType:
    if name in _TEXT:
        return T.StringType()
    if name.endswith(_REAL):
        return T.DoubleType()
    if (name.startswith(_FLAGS) or name.endswith(("_flag", "_since_install"))
            or name in _SMALL):
        return T.IntegerType()
    return T.LongType()


def store_schema(features) -> T.StructType:
    """The feature store: key, features, label, version."""
    return T.StructType(
        [
            T.StructField("snapshot_date", T.DateType()),
            T.StructField(USER, T.StringType()),
            T.StructField("install_date", T.DateType()),
            T.StructField("milestone_day", T.IntegerType()),
            *[T.StructField(n, _feature_type(n)) for n in features],
            T.StructField(c.LABEL, T.IntegerType()),
            T.StructField("created_at", T.TimestampType()),
        ]
    )


# The small tables
RISK_SCHEMA = """dimension string, value string, uninstall_rate double,
    sample_size long, updated_at timestamp"""
PREDICTION_SCHEMA = f"""prediction_date date, {USER} string,
    {", ".join(f"uninstall_prob_{m} double" for m in c.MODEL_NAMES)},
    uninstall_prob double, risk_segment string, created_at timestamp"""

METRICS_SCHEMA = """run_id string, model string, auc_roc double, auc_pr double,
    precision double, recall double, f1 double, rank int, is_best int,
    params string, train_rows long, valid_rows long, n_inputs int, train_seconds double"""
PRODUCTION_SCHEMA = "model string, run_id string, updated_at timestamp"


def create_table(spark: SparkSession, path: str, schema, partitions=()) -> None:
    """Create an empty table; an existing one is left alone."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").partitionBy(*partitions).parquet(path)


# --- slices ----------------------------------------------------------------


def write_slices(frame: DataFrame, path: str, partitions=SLICE, sort_by: str = USER,
                 replacing=()) -> None:
    """Replace the partitions that occur in ``frame`` and those named in ``replacing``.

    A named partition (its values, in order) that got no rows is removed: its
    files are still the old ones after the write.
    ``rebalance`` splits a large slice over several files and keeps small ones
    in one; rows are sorted so that files carry useful key ranges.
    """
    spark = frame.sparkSession
    folders = ["/".join([path, *[f"{p}={v}" for p, v in zip(partitions, x)]]) for x in replacing]
    before = [file_names(spark, folder) for folder in folders]
    (
        frame.hint("rebalance", *partitions)
        .sortWithinPartitions(*partitions, sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    for folder, names in zip(folders, before):
        if names and file_names(spark, folder) == names:
            remove(spark, folder)


def write_features(features: DataFrame, path: str, replacing=()) -> None:
    """Insert or replace feature slices, stamped with their build time."""
    write_slices(
        features.withColumn("created_at", F.current_timestamp()), path, replacing=replacing
    )


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table with its declared schema.

    No file is opened for it, an empty table can be read, and columns added
    after a slice was written are null there.
    """
    return spark.read.schema(schema).parquet(path)


def read_store(spark: SparkSession, path: str, features) -> DataFrame:
    """The feature store; features a slice was written without get their default."""
    schema = store_schema(features)
    store = read_table(spark, path, schema)
    return store.na.fill(
        {x.name: default_value(x.name) for x in schema if x.name in set(features)}
    )


def default_value(feature: str):
    """What a feature is without any event."""
    if isinstance(_feature_type(feature), T.StringType):
        return ""
    if feature.startswith("hours_since_last"):
        return c.NEVER_HOURS
    if feature.endswith("_uninstall_rate"):
        return c.UNKNOWN_RATE
    return 1.0 if feature.endswith("_trend_7d") else 0


def latest_version(frame: DataFrame, keys, version) -> DataFrame:
    """Keep the newest row per key.

    One narrow aggregate finds the keys with several rows, their newest version and how
    many rows have it.  These keys are few in a store whose slices are replaced, so the
    join back does not shuffle the rows.  Equal newest versions are settled by the row's
    values, a maximum over structs; without any, that branch reads nothing.
    """
    versions = [version] if isinstance(version, str) else list(version)
    payload = [x for x in frame.columns if x not in (*keys, *versions)]
    counts = frame.groupBy(*keys, *versions).agg(F.count(F.lit(1)).alias("_n"))
    newest = counts.groupBy(*keys).agg(F.max(F.struct(*versions, "_n")).alias("_top"), F.sum("_n").alias("_all"))
    newest = newest.where("_all > 1").select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_top")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    top = reduce(and_, [F.col(v).eqNullSafe(F.col(f"_top.{v}")) for v in versions])
    alone = frame.join(newest, same, "left").where(F.col("_top").isNull() | (top & (F.col("_top._n") == 1)))
    tied = frame.join(newest.where("_top._n > 1"), same & top, "left_semi")
    settled = tied.groupBy(*keys, *versions).agg(F.max(F.struct(*payload)).alias("row")) if payload else tied.distinct()
    settled = settled.select(*keys, *versions, "row.*") if payload else settled
    return alone.select(*frame.columns).unionByName(settled.select(*frame.columns))


def slice_rows(store: DataFrame, by=SLICE) -> DataFrame:
    """Row count per existing slice."""
    return store.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def slice_exists(store: DataFrame, **slice_values) -> bool:
    """Whether a slice has any row; reads only its partition."""
    for name, value in slice_values.items():
        store = store.where(F.col(name) == F.lit(str(value)).cast(store.schema[name].dataType))
    return not store.limit(1).isEmpty()


def build_report(store: DataFrame, by=SLICE) -> DataFrame:
    """Rows and label rate per slice."""
    return store.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg(c.LABEL), 6).alias("label_rate"),
    )


# --- what slices were built from -------------------------------------------


def day_checksums(events: DataFrame | DayTables) -> DataFrame:
    """``event_date, checksum``: a number per day that does not depend on the order of its rows.

    The sum of 64-bit hashes of whole rows, and their number; of day tables, of both.
    """
    frames = [events] if isinstance(events, DataFrame) else [events.measures, events.values]
    sums = []
    for k, frame in enumerate(frames):
        # a null leaves a hash as it is, so its place is hashed too
        row = F.xxhash64(F.lit(k), *frame.columns, *(F.col(x).isNull() for x in frame.columns))
        sums.append(frame.groupBy(DAY).agg(F.sum(row.cast("decimal(38, 0)")).alias("total"), F.count(F.lit(1)).alias("n")))
    both = reduce(DataFrame.unionByName, sums).groupBy(DAY).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return both.select(DAY, F.concat_ws(":", F.col("total").cast("string"), F.col("n").cast("string")).alias("checksum"))


def slice_days(spark: SparkSession, slices) -> DataFrame:
    """``milestone_day, snapshot_date, event_date``: every day that a build of the slices reads."""
    rows = []
    for milestone, day in slices:
        low = day - timedelta(days=c.FEATURE_WINDOW + milestone)
        high = day + timedelta(days=c.LABEL_HORIZON - 1)
        rows += [(milestone, day, low + timedelta(days=k)) for k in range((high - low).days + 1)]
    return spark.createDataFrame(rows, f"milestone_day int, snapshot_date date, {DAY} date")


def slice_inputs(events: DataFrame | DayTables, spark: SparkSession, slices) -> DataFrame:
    """The days of slices with their checksums; a day without events has an empty one."""
    days = [day for _, day in slices]
    first = min(day - timedelta(days=c.FEATURE_WINDOW + m) for m, day in slices)
    last = max(days) + timedelta(days=c.LABEL_HORIZON - 1)
    scanned = events.between(first, last) if isinstance(events, DayTables) else between_days(events, first, last)
    # one row per day
    return slice_days(spark, slices).join(F.broadcast(day_checksums(scanned)), DAY, "left").withColumn(
        "checksum", F.coalesce("checksum", F.lit("")))


INPUTS_SCHEMA = f"{DAY} date, checksum string, milestone_day int, snapshot_date date"


def write_inputs(inputs: DataFrame, path: str) -> None:
    write_slices(inputs, path, SLICE, DAY)


def changed_slices(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Slices of ``current`` with a day that is no longer what it was, or was never recorded."""
    key = [*SLICE, DAY]
    old = recorded.select(*key, F.col("checksum").alias("old"))
    return current.join(old, key, "left").where(~F.col("checksum").eqNullSafe(F.col("old"))).select(*SLICE).distinct()


# --- small tables ----------------------------------------------------------


def write_risk_baseline(baseline: DataFrame, path: str) -> None:
    """Replace the rates of the dimensions that occur."""
    write_slices(baseline, path, ("dimension",), "value")


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Insert or replace the predictions of a day."""
    write_slices(
        predictions.withColumn("created_at", F.current_timestamp()), path, ("prediction_date",)
    )


def write_production(spark: SparkSession, runs: dict[str, str], path: str) -> None:
    """Point models at the runs that trained them."""
    rows = spark.createDataFrame(list(runs.items()), "model string, run_id string")
    write_slices(rows.withColumn("updated_at", F.current_timestamp()), path, ("model",), "run_id")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Replace the metrics of a training run."""
    write_slices(metrics, path, ("run_id",), "model")


def write_importance(importance: DataFrame, path: str) -> None:
    """Importance table, one row per feature, as CSV."""
    importance.coalesce(1).sortWithinPartitions(F.desc("importance"), "feature").write.mode(
        "overwrite"
    ).csv(path, header=True)


# --- day tables ------------------------------------------------------------


def write_day_tables(events: DataFrame, spec: Rollup, path: str, days=()) -> None:
    """Add or replace the reduced days that occur in ``events``, and those in ``days``.

    A daily run reads one day of events; feature builds read these tables and
    never the events again.  A day of ``days`` without events is removed.
    """
    tables, replacing = day_tables(events, spec), [(day,) for day in days]
    write_slices(tables.measures, f"{path}/measures", (DAY,), replacing=replacing)
    write_slices(tables.values, f"{path}/values", (DAY,), replacing=replacing)


def read_day_tables(spark: SparkSession, spec: Rollup, path: str) -> DayTables:
    return DayTables(
        spark.read.parquet(f"{path}/measures"), spark.read.parquet(f"{path}/values"), spec
    )
