"""Training rows: closed labels, one version per key, split by time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline import config as c
from stayline.operators.anchors import _day
from stayline.operators.encoding import of_kind
from stayline.operators.rollup import USER
from stayline.sources.events import as_date
from stayline.sources.store import latest_version


def training_set(store: DataFrame, as_of, kind: str = "milestone") -> DataFrame:
    """Store rows whose label window closed before ``as_of``.

    ``kind`` is ``milestone``, ``calendar`` or ``all``.
    """
    cutoff = _day(as_of) - timedelta(days=c.LABEL_HORIZON + 1)
    rows = store.where(
        (F.col("snapshot_date") <= as_date(cutoff)) & F.col(c.LABEL).isNotNull()
    )
    rows = of_kind(rows, kind)
    if "created_at" in store.columns:
        rows = latest_version(rows, c.STORE_KEY, "created_at")
    return rows


def require_rows(rows: DataFrame, what: str) -> DataFrame:
    """The frame itself, or an error when it is empty."""
    if rows.limit(1).isEmpty():
        raise ValueError(f"no rows in {what}")
    return rows


def dataset_summary(rows: DataFrame) -> DataFrame:
    """Rows, snapshots and label rate; one row per snapshot meets the last step."""
    by_snapshot = rows.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(c.LABEL).alias("positive")
    )
    return by_snapshot.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_snapshots"),
        F.round(F.sum("positive") / F.sum("n"), 6).alias("label_rate"),
    )


def last_snapshot_per_user(rows: DataFrame) -> DataFrame:
    """Each user's snapshot of the highest age."""
    return latest_version(rows, (USER,), ("days_since_install", "snapshot_date", "milestone_day"))


def split_date(rows: DataFrame, ratio: float = c.TRAIN_RATIO):
    """First validation day.

    The snapshots are a list of days, small by nature; the result is a literal,
    so both sides of the split prune partitions.
    """
    days = sorted(r[0] for r in rows.select("snapshot_date").distinct().collect())
    if len(days) < 2:
        raise ValueError("a split by time needs at least two snapshots")
    return days[min(max(1, int(len(days) * ratio)), len(days) - 1)]


def time_split(rows: DataFrame, ratio: float = c.TRAIN_RATIO,
               embargo_days: int = 0) -> tuple[DataFrame, DataFrame]:
    """Train rows before the split day, validation rows from it on.

    ``embargo_days`` drops the train snapshots whose labels reach into the
    validation period.
    """
    first = split_date(rows, ratio)
    train = rows.where(F.col("snapshot_date") < as_date(first - timedelta(days=embargo_days)))
    return train, rows.where(F.col("snapshot_date") >= as_date(first))
