"""Target encoding by uninstall rate, and ordinal codes for categories."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayline import config as c
from stayline.operators.lookup import BROADCAST_BYTES, is_small, lookup
from stayline.operators.rollup import USER
from stayline.operators.running import BUCKETS, running_totals
from stayline.sources.events import as_date
from stayline.sources.shared import saved
from stayline.sources.store import latest_version


def _unpivot(frame: DataFrame, columns, keep=()) -> DataFrame:
    """Columns as rows ``(name, value)``."""
    pairs = ", ".join(f"'{x}', {x}" for x in columns)
    return frame.select(*keep, F.expr(f"stack({len(columns)}, {pairs}) AS (name, value)"))


def of_kind(store: DataFrame, kind: str) -> DataFrame:
    """``milestone``, ``calendar`` or ``all`` rows of a store."""
    if kind not in ("milestone", "calendar", "all"):
        raise ValueError(f"unknown kind {kind!r}")
    return store if kind == "all" else store.where(f"milestone_day {'>' if kind == 'milestone' else '='} 0")


# --- target encoding -------------------------------------------------------


def risk_baseline(store: DataFrame, cutoff, min_n: int = c.MIN_RISK_SAMPLE,
                  dimensions=c.RISK_DIMENSIONS, label_closed: bool = False,
                  kind: str = "all") -> DataFrame:
    """Uninstall rate and sample size per value, all dimensions in one aggregate.

    Only snapshots before the cutoff count; with ``label_closed`` only those
    whose label window had ended by then.  ``kind`` is ``milestone``,
    ``calendar`` or ``all``.
    """
    last = F.date_sub(as_date(cutoff), c.LABEL_HORIZON) if label_closed else None
    history = of_kind(store, kind).where(F.col("snapshot_date") < as_date(cutoff))
    if last is not None:
        history = history.where(F.col("snapshot_date") <= last)
    return (
        _unpivot(history, dimensions, (c.LABEL,))
        .where("value <> ''")
        .groupBy(F.col("name").alias("dimension"), "value")
        .agg(F.round(F.avg(c.LABEL), 4).alias("uninstall_rate"),
             F.count(c.LABEL).alias("sample_size"))
        .where(F.col("sample_size") >= min_n)
    )


def merge_baseline(old: DataFrame, new: DataFrame) -> DataFrame:
    """Newest rate per value; a value absent from ``new`` keeps its old rate."""
    return latest_version(old.unionByName(new), ("dimension", "value"), "updated_at")


def apply_risk(store: DataFrame, baseline: DataFrame, dimensions=c.RISK_DIMENSIONS) -> DataFrame:
    """Rate columns from the saved baseline, -1 for values without a rate.

    A dimension without any rate keeps the column it has.
    """
    known = {
        r.dimension
        for r in baseline.where(F.col("dimension").isin(*dimensions))
        .select("dimension").distinct().collect()
    }
    small = is_small(baseline)
    columns = {x: F.col(x) for x in store.columns}
    for dim in dimensions:
        if dim not in known:
            continue
        rates = baseline.where(F.col("dimension") == dim).select(
            F.col("value").alias("key"), F.col("uninstall_rate").alias("value")
        )
        store = lookup(store, dim, rates, f"_rate_{dim}", small=small, spread_by=USER)
        target = f"{dim}_uninstall_rate"
        columns[target] = F.coalesce(f"_rate_{dim}", F.lit(c.UNKNOWN_RATE)).alias(target)
    return store.select(*columns.values())


def update_from(store: DataFrame, baseline: DataFrame, first_date,
                dimensions=c.RISK_DIMENSIONS) -> DataFrame:
    """New rates for snapshots from ``first_date`` on, the old ones before."""
    rated = apply_risk(
        store.select("*", *[F.col(f"{d}_uninstall_rate").alias(f"_old_{d}") for d in dimensions]),
        baseline, dimensions,
    )
    recent = F.col("snapshot_date") >= as_date(first_date)
    return rated.select(*[
        F.when(recent, F.col(x)).otherwise(F.col(f"_old_{x.removesuffix('_uninstall_rate')}"))
        .alias(x) if x in {f"{d}_uninstall_rate" for d in dimensions} else F.col(x)
        for x in store.columns
    ])


def rate_versions(store: DataFrame, min_n: int = c.MIN_RISK_SAMPLE, dimensions=c.RISK_DIMENSIONS,
                  kind: str = "milestone") -> DataFrame:
    """``dimension, value, valid_from, uninstall_rate, sample_size``: rates as they became known.

    Labels of a snapshot are known when their window has closed; from that day on they are
    in the rate, a running total over the snapshots of the value.  Totals are taken over
    days, so a value of most rows is a few rows here.  Below ``min_n`` rows there is no rate.
    """
    days = (
        _unpivot(of_kind(store, kind), dimensions, ("snapshot_date", c.LABEL))
        .where(f"value <> '' AND {c.LABEL} IS NOT NULL")
        .groupBy(F.col("name").alias("dimension"), "value", "snapshot_date")
        .agg(F.sum(F.col(c.LABEL).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("dimension", "value").orderBy("snapshot_date")  # one row per day
    total = days.withColumn("sample_size", F.sum("n").over(upto)).withColumn("pos", F.sum("pos").over(upto))
    return total.where(F.col("sample_size") >= min_n).select(
        "dimension", "value", F.date_add("snapshot_date", c.LABEL_HORIZON).alias("valid_from"),
        F.round(F.col("pos") / F.col("sample_size"), 4).alias("uninstall_rate"), "sample_size")


def apply_known_risk(store: DataFrame, versions: DataFrame, dimensions=c.RISK_DIMENSIONS) -> DataFrame:
    """Rate columns as they were known on each row's snapshot day, -1 where there was none.

    An as-of join: the days on which values occur are few beside the rows, so each of
    them takes the newest version up to it in one window over days and versions, and rows
    look their value and day up.
    """
    asked = _unpivot(store, dimensions, ("snapshot_date",)).where("value <> ''").select(
        F.col("name").alias("dimension"), "value", F.col("snapshot_date").alias("day"),
        F.lit(1).alias("ask"), F.lit(None).cast("double").alias("rate")).distinct()
    given = versions.where(F.col("dimension").isin(*dimensions)).select(
        "dimension", "value", F.col("valid_from").alias("day"), F.lit(0).alias("ask"), F.col("uninstall_rate").alias("rate"))
    # versions of a day come before the rows of that day
    upto = Window.partitionBy("dimension", "value").orderBy("day", "ask").rowsBetween(Window.unboundedPreceding, 0)
    known = asked.unionByName(given).withColumn("rate", F.last("rate", ignorenulls=True).over(upto))
    known = saved(known.where("ask = 1 AND rate IS NOT NULL").select("dimension", "value", "day", "rate"))
    small = is_small(known)
    columns = {x: F.col(x) for x in store.columns}
    for dim in dimensions:
        table = known.where(F.col("dimension") == dim).select(
            F.concat_ws("\0", F.col("day").cast("string"), "value").alias("key"), F.col("rate").alias("value"))
        store = lookup(store, f"concat_ws('\0', cast(snapshot_date AS string), {dim})", table, f"_rate_{dim}", small=small, spread_by=USER)
        target = f"{dim}_uninstall_rate"
        columns[target] = F.coalesce(f"_rate_{dim}", F.lit(c.UNKNOWN_RATE)).alias(target)
    return store.select(*columns.values())


# --- ordinal codes ---------------------------------------------------------


def fit_ordinal(train: DataFrame, columns=c.CATEGORICAL_FEATURES) -> DataFrame:
    """Dictionary ``(feature, value, code)``: rank among the sorted train values.

    Values are made distinct first; a code is the rank within the feature.
    """
    values = saved(
        _unpivot(train, columns)
        .select(F.col("name").alias("feature"),
                F.coalesce("value", F.lit(c.MISSING_CATEGORY)).alias("value"))
        .distinct()
        .withColumn("key", F.concat_ws("\0", "feature", "value"))
        .withColumn("one", F.lit(1))
    )
    return _ranks(values)


def extend_ordinal(dictionary: DataFrame, rows: DataFrame, version: int, columns=c.CATEGORICAL_FEATURES) -> DataFrame:
    """``feature, value, code, version``: the dictionary with the new values of some rows.

    Codes are never changed: new values go behind those a feature has, in their order, so a
    model reads any later dictionary as it reads its own.  A dictionary without versions
    is the version 0.
    """
    old = dictionary if "version" in dictionary.columns else dictionary.withColumn("version", F.lit(0))
    own = ("feature", "value", "code", "version")
    unseen = _unpivot(rows, columns).select(
        F.col("name").alias("feature"), F.coalesce("value", F.lit(c.MISSING_CATEGORY)).alias("value")).distinct()
    unseen = saved(unseen.join(old, ["feature", "value"], "left_anti").withColumn("one", F.lit(1)).withColumn(
        "key", F.concat_ws("\0", "feature", "value")))
    ranked = _ranks(unseen)
    sizes = old.groupBy("feature").agg((F.max("code") + 1).alias("_next"))  # one row per feature
    ranked = ranked.join(F.broadcast(sizes), "feature", "left").select(
        "feature", "value", (F.col("code") + F.coalesce("_next", F.lit(0))).cast("int").alias("code"), F.lit(version).alias("version"))
    return old.select(*own).unionByName(ranked)


def dictionary_at(dictionary: DataFrame, version: int) -> DataFrame:
    """The dictionary as it was: what a model of that version was trained with."""
    return dictionary.where(F.col("version") <= version).select("feature", "value", "code")


def _ranks(values: DataFrame) -> DataFrame:
    """``feature, value, code``: rank of distinct ``(feature, value, key, one)`` within the feature.

    All features are ranked together, as one order over the key.
    """
    # A pseudo-random sample of bounded size.
    sample = values.orderBy(F.xxhash64("key"), "key").select("key").limit(BUCKETS - 1)
    borders = sorted(r.key for r in sample.collect())
    ranked = running_totals(values, "key", borders, {"rank": "one"})
    sizes = {r.feature: r.n for r in
             values.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    # One literal per feature: the number of values of the features before it.
    code, before = F.lit(None).cast("bigint"), 0
    for feature in sorted(sizes):
        code = F.when(F.col("feature") == feature, F.col("rank") - 1 - before).otherwise(code)
        before += sizes[feature]
    return ranked.select("feature", "value", code.cast("int").alias("code"))


def apply_ordinal(frame: DataFrame, dictionary: DataFrame,
                  columns=c.CATEGORICAL_FEATURES) -> DataFrame:
    """Replace each category by its code, -1 for values the dictionary lacks.

    The dictionary is a saved table; it is read once per column.  Whether its
    values are broadcast is decided per column, by their bytes.
    """
    bytes_ = {r.feature: r.bytes for r in dictionary.groupBy("feature").agg(
        F.sum(F.octet_length("value") + 16).alias("bytes")).collect()}
    outputs = {x: F.col(x) for x in frame.columns}
    for column in columns:
        codes = dictionary.where(F.col("feature") == column).select(
            F.col("value").alias("key"), F.col("code").alias("value")
        )
        frame = lookup(frame, f"coalesce({column}, '{c.MISSING_CATEGORY}')", codes,
                       f"_code_{column}", small=bytes_.get(column, 0) <= BROADCAST_BYTES, spread_by=USER)
        outputs[column] = F.coalesce(f"_code_{column}", F.lit(-1)).alias(column)
    return frame.select(*outputs.values())


# --- target statistics of categories ---------------------------------------

# What a category without rows is worth, and how many rows that counts as.
PRIOR, PRIOR_ROWS = 0.5, 1.0
# Parts of the random order that are summed on their own: 16 to this power.
ORDER_DIGITS = 3


def random_order(seed: int) -> Column:
    """A place in a random order, by the key of a store row."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(x).cast("string") for x in c.STORE_KEY)))


def _statistic(positive, rows) -> Column:
    return (positive + F.lit(PRIOR * PRIOR_ROWS)) / (rows + F.lit(PRIOR_ROWS))


def category_statistics(encoded: DataFrame, columns) -> DataFrame:
    """``feature, code, value``: smoothed label rate of every code."""
    found = _unpivot(encoded, columns, (c.LABEL,)).groupBy("name", "value").agg(
        F.sum(c.LABEL).cast("double").alias("pos"), F.count(F.lit(1)).cast("double").alias("n"))
    return found.select(F.col("name").alias("feature"), F.col("value").alias("code"), _statistic(F.col("pos"), F.col("n")).alias("value"))


def with_statistics(encoded: DataFrame, statistics: DataFrame, columns) -> DataFrame:
    """Codes replaced by their statistics, the prior for codes without one."""
    small = is_small(statistics)
    outputs = {x: F.col(x) for x in encoded.columns}
    for column in columns:
        table = statistics.where(F.col("feature") == column).select(F.col("code").alias("key"), "value")
        encoded = lookup(encoded, column, table, f"_statistic_{column}", small=small, spread_by=USER)
        outputs[column] = F.coalesce(f"_statistic_{column}", F.lit(PRIOR)).alias(column)
    return encoded.select(*outputs.values())


def ordered_statistics(encoded: DataFrame, columns, seed: int = c.SEED) -> DataFrame:
    """Codes replaced by the smoothed label rate of the rows before in a random order.

    A row's own label, and those behind it, stay out of its values.  The order is cut into
    4096 even parts: sums run inside a part of a category, and over the parts of a
    category, so that a category of most rows is spread over them.
    """
    order = random_order(seed)
    long = _unpivot(encoded.withColumn("_order", order), columns, (*c.STORE_KEY, "_order", c.LABEL))
    long = long.withColumn("_part", F.substring("_order", 1, ORDER_DIGITS))
    label = F.col(c.LABEL).cast("double")
    parts = long.groupBy("name", "value", "_part").agg(F.sum(label).alias("pos"), F.count(F.lit(1)).cast("double").alias("n"))
    earlier = Window.partitionBy("name", "value").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "name", F.col("value").alias("_value"), "_part",
        *(F.coalesce(F.sum(x).over(earlier), F.lit(0.0)).alias(f"_{x}") for x in ("pos", "n")))
    inside = Window.partitionBy("name", "value", "_part").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    long = long.select(
        *c.STORE_KEY, "name", "value", "_part",
        F.coalesce(F.sum(label).over(inside), F.lit(0.0)).alias("pos"), F.coalesce(F.sum(F.lit(1.0)).over(inside), F.lit(0.0)).alias("n"))
    same = (long["name"] == parts["name"]) & (long["_part"] == parts["_part"]) & long["value"].eqNullSafe(parts["_value"])
    # merged, not broadcast: files of codes are small, but the rows in them, and the parts, would be held by the driver
    found = long.join(parts.hint("merge"), same).select(
        *c.STORE_KEY, long["name"], _statistic(F.col("pos") + F.col("_pos"), F.col("n") + F.col("_n")).alias("statistic"))
    wide = found.groupBy(*c.STORE_KEY).agg(*(F.max(F.when(F.col("name") == x, F.col("statistic"))).alias(f"_statistic_{x}") for x in columns))
    joined = encoded.join(wide.hint("merge"), list(c.STORE_KEY))
    return joined.select(*(F.col(f"_statistic_{x}").alias(x) if x in columns else F.col(x) for x in encoded.columns))


def assemble(encoded: DataFrame, inputs, output: str = "features") -> DataFrame:
    """One vector per row from model inputs."""
    return VectorAssembler(
        inputCols=list(inputs), outputCol=output, handleInvalid="keep"
    ).transform(encoded)
