"""Running totals along a global order, without one task seeing all rows.

Borders cut the order into buckets.  Sums run within each bucket in parallel
and the totals of the buckets before it are added.  The borders only decide how
even the work is; the result is exact whatever they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKETS = 256


def bucket_of(order: str, borders: Sequence) -> Column:
    """Number of borders at or below the value."""
    if not borders:
        return F.lit(0)
    return F.size(F.filter(F.lit(list(borders)), lambda b: b <= F.col(order)))


def running_totals(frame: DataFrame, order: str, borders: Sequence, totals: dict[str, str],
                   by=(), descending: bool = False) -> DataFrame:
    """Add running sums, the row's own value included.

    ``totals`` maps new columns to summed ones; values of ``order`` are
    distinct within ``by``.
    """
    by = list(by)
    direction = F.desc if descending else F.asc
    placed = frame.withColumn("_bucket", bucket_of(order, borders))
    sums = placed.groupBy(*by, "_bucket").agg(
        *[F.sum(x).alias(f"_sum_{n}") for n, x in totals.items()]
    )
    # One row per bucket here.
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy(direction("_bucket")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sums.select(
        *by, "_bucket",
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}")
          for n in totals],
    )
    within = Window.partitionBy(*by, "_bucket").orderBy(direction(order)).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return placed.join(offsets, [*by, "_bucket"]).select(
        *frame.columns,
        *[(F.sum(x).over(within) + F.col(f"_before_{n}")).alias(n) for n, x in totals.items()],
    )
