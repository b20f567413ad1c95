"""Diagnostics over the event table and the feature store.

Distinct users are counted by first reducing events to one row per user (and
day, week or install date): partial sums travel instead of events, and no
``Expand`` is planned.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayline import config as c
from stayline.operators.anchors import _day, calendar_scan
from stayline.operators.rollup import DAY, USER
from stayline.sources.events import as_date, between_days

# Upper ends of the age buckets, in days
AGE_BUCKETS = (
    (0, "D0"), (3, "D1-D3"), (7, "D4-D7"), (14, "D8-D14"), (30, "D15-D30"), (60, "D31-D60"),
)
OLDEST_BUCKET = "D61+"
OLD_USER_BUCKETS = ((90, "D0-D89"), (180, "D90-D179"), (365, "D180-D364"))
OLDEST_USER_BUCKET = "D365+"


def _removal() -> Column:
    return F.col("event_name") == c.REMOVE_EVENT


def _ratio(part: Column, whole: Column, scale: float, digits: int) -> Column:
    return F.when(whole > 0, F.round(part * scale / whole, digits))


def _age_bucket(age: str = "days_since_install") -> Column:
    bucket = F.lit(OLDEST_BUCKET)
    for upper, name in reversed(AGE_BUCKETS):
        bucket = F.when(F.col(age) <= upper, name).otherwise(bucket)
    return bucket


def event_name_search(events: DataFrame, words=("remove", "uninstall", "delete")) -> DataFrame:
    """Event names containing one of the words, most frequent first."""
    name = F.lower("event_name")
    found = F.lit(False)
    for word in words:
        found = found | name.contains(word)
    return (
        events.where(found).groupBy("event_name")
        .agg(F.count(F.lit(1)).alias("n_events"))
        .orderBy(F.desc("n_events"), "event_name")
    )


def removal_totals(events: DataFrame) -> DataFrame:
    """Removal events and the users behind them."""
    per_user = events.where(_removal()).groupBy(USER).agg(F.count(F.lit(1)).alias("n"))
    return per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"),
        F.count(F.lit(1)).alias("unique_users"),
    )


def rate_by_age_bucket(store: DataFrame, before) -> DataFrame:
    """Uninstall rate by age, youngest first."""
    return (
        store.where(F.col("snapshot_date") < as_date(before))
        .groupBy(_age_bucket().alias("age_bucket"))
        .agg(F.count(F.lit(1)).alias("users"),
             F.sum(F.col(c.LABEL).cast("long")).alias("uninstalled"),
             F.round(F.avg(c.LABEL) * 100, 2).alias("rate_pct"),
             F.min("days_since_install").alias("min_age"))
        .orderBy("min_age")
    )


def removal_offset_histogram(events: DataFrame, snapshot) -> DataFrame:
    """Removals by distance from the snapshot, marked by the label window."""
    s = _day(snapshot)
    offset = F.datediff(DAY, as_date(s))
    return (
        between_days(events, s - timedelta(days=c.FEATURE_WINDOW),
                     s + timedelta(days=2 * c.LABEL_HORIZON - 1))
        .where(_removal())
        .groupBy(offset.alias("days_from_snapshot"))
        .agg(F.count(F.lit(1)).alias("n_events"))
        .withColumn(
            "part",
            F.expr(f"CASE WHEN days_from_snapshot < 0 THEN 'before'"
                   f" WHEN days_from_snapshot < {c.LABEL_HORIZON} THEN 'label window'"
                   f" ELSE 'outside' END"),
        )
        .orderBy("days_from_snapshot")
    )


def lifetime_churn(events: DataFrame) -> DataFrame:
    """Share of all users who ever removed the app."""
    per_user = events.groupBy(USER).agg(F.max(_removal().cast("int")).alias("removed"))
    totals = per_user.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.coalesce(F.sum("removed"), F.lit(0)).alias("removed_users"),
    )
    return totals.withColumn(
        "churn_pct", _ratio(F.col("removed_users"), F.col("total_users"), 100.0, 1)
    )


def rate_per_snapshot(store: DataFrame) -> DataFrame:
    """Users, removals, rate and mean age per snapshot."""
    return (
        store.groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("users"),
             F.sum(F.col(c.LABEL).cast("long")).alias("uninstalled"),
             F.round(F.avg(c.LABEL) * 100, 2).alias("rate_pct"),
             F.round(F.avg("days_since_install")).alias("avg_age"))
        .orderBy("snapshot_date")
    )


def age_distribution_pct(store: DataFrame, before) -> DataFrame:
    """Rows by age with their share of all rows, and a line for the total."""
    buckets = (
        store.where(F.col("snapshot_date") < as_date(before))
        .withColumn("bucket", _age_bucket())
        .rollup("bucket")
        .agg(F.count(F.lit(1)).alias("n_rows"),
             F.sum(F.col(c.LABEL).cast("long")).alias("uninstalled"),
             F.round(F.avg(c.LABEL) * 100, 2).alias("rate_pct"),
             F.min("days_since_install").alias("min_age"),
             F.grouping("bucket").alias("is_total"))
    )
    # One row per bucket and one for the total.
    total = F.max(F.when(F.col("is_total") == 1, F.col("n_rows"))).over(
        Window.partitionBy(F.lit(1))
    )
    return (
        buckets.withColumn("pct", F.round(F.col("n_rows") * 100.0 / total, 1))
        .withColumn("bucket", F.coalesce("bucket", F.lit("TOTAL")))
        .orderBy("is_total", "min_age")
        .select("bucket", "n_rows", "pct", "uninstalled", "rate_pct")
    )


def install_date_distribution(events: DataFrame, after, days: int = 60) -> DataFrame:
    """Events and users per install date, the first ``days`` dates."""
    per_user = (
        events.where(F.col("install_date") > as_date(after))
        .groupBy(F.expr("cast(install_date AS date)").alias("idate"), USER)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_user.groupBy("idate")
        .agg(F.sum("n").alias("n_events"), F.count(F.lit(1)).alias("unique_users"))
        .orderBy("idate").limit(days)
    )


def snapshot_age_split(store: DataFrame, before) -> DataFrame:
    """Per snapshot, the rate of users up to a week old and of older ones."""
    young = F.col("days_since_install") <= 7

    def rate(cond: Column) -> Column:
        return F.round(F.avg(F.when(cond, F.col(c.LABEL))) * 100, 2)

    return (
        store.where(F.col("snapshot_date") < as_date(before))
        .groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("total"),
             F.count_if(young).alias("d0_d7"),
             F.count_if(F.col("days_since_install") <= 30).alias("d0_d30"),
             rate(F.lit(True)).alias("overall_rate"),
             rate(young).alias("d0_d7_rate"),
             rate(~young).alias("d8plus_rate"))
        .orderBy("snapshot_date")
    )


def weekly_removals(events: DataFrame, first) -> DataFrame:
    """Removal events and users by week, weeks starting on Monday."""
    per_user = (
        events.where(_removal() & (F.col(DAY) >= as_date(first)))
        .groupBy(F.trunc(DAY, "week").alias("week"), USER)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_user.groupBy("week")
        .agg(F.sum("n").alias("remove_events"), F.count(F.lit(1)).alias("unique_removers"))
        .orderBy("week")
    )


def manual_label_rate(events: DataFrame, snapshot) -> DataFrame:
    """Label rate of a snapshot straight from events, install date taken per row."""
    s = _day(snapshot)
    removed = _removal() & (F.col(DAY) >= as_date(s))
    installed = F.expr("cast(install_date AS date)")
    per_user = (
        between_days(events, *calendar_scan(s, s))
        .where(installed.between(as_date(s - timedelta(days=c.MAX_INSTALL_AGE_DAYS)), as_date(s)))
        .groupBy(USER).agg(F.max(removed.cast("int")).alias("removed"))
    )
    totals = per_user.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.coalesce(F.sum("removed"), F.lit(0)).alias("uninstallers"),
    )
    return totals.withColumn(
        "rate_pct", _ratio(F.col("uninstallers"), F.col("total_users"), 100.0, 2)
    )


def old_removers(events: DataFrame, data_start, first, last) -> DataFrame:
    """Users who removed the app in the period and installed before the data begin."""
    return (
        between_days(events, first, last).where(_removal())
        .groupBy(USER)
        .agg(F.min(F.expr("cast(install_date AS date)")).alias("idate"),
             F.min(DAY).alias("remove_date"))
        .where(F.col("idate") < as_date(data_start))
    )


def old_user_age_at_start(events: DataFrame, data_start, first, last) -> DataFrame:
    """Old removers by their age when the data begin."""
    age = F.datediff(as_date(data_start), "idate")
    bucket = F.lit(OLDEST_USER_BUCKET)
    for upper, name in reversed(OLD_USER_BUCKETS):
        bucket = F.when(F.col("age") < upper, name).otherwise(bucket)
    return (
        old_removers(events, data_start, first, last)
        .withColumn("age", age)
        .groupBy(bucket.alias("age_bucket"))
        .agg(F.count(F.lit(1)).alias("users"),
             F.min("idate").alias("oldest_install"),
             F.max("idate").alias("newest_install"),
             F.min("age").alias("min_age"))
        .orderBy("min_age")
    )


def old_user_recent_activity(events: DataFrame, data_start, first, last) -> DataFrame:
    """How many old removers had a session in the 30 days before their first removal.

    Sessions are reduced to days per user before they meet the removers.
    """
    removers = old_removers(events, data_start, first, last)
    session_days = (
        between_days(events, _day(first) - timedelta(days=c.FEATURE_WINDOW), last)
        .where(F.col("event_name") == c.SESSION_EVENT)
        .select(USER, F.col(DAY).alias("session_day")).distinct()
    )
    recent = F.datediff("remove_date", "session_day").between(1, c.FEATURE_WINDOW)
    per_user = (
        removers.join(session_days, USER, "left")
        .groupBy(USER)
        .agg(F.max(F.coalesce(recent, F.lit(False)).cast("int")).alias("recent"))
    )
    totals = per_user.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.coalesce(F.sum("recent"), F.lit(0)).alias("with_recent_session"),
    )
    return totals.withColumn(
        "pct", _ratio(F.col("with_recent_session"), F.col("total_users"), 100.0, 1)
    )
