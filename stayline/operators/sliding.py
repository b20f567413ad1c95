"""State of all users, moved on day by day.

A calendar snapshot looks at 30 days and, for the label, at 7 more.  The state holds what
it needs of these days, reduced further than day tables: measures per user and day,
facets per user, day and gap, and the last day each value was seen.  A new day closes the
gaps of the values it sees again, which moves one distinct value per match from the open
gap to the found one; all else is added.  So moving on reads one day and one state, and
the values of the days before, the largest of the reduced rows, are not read again.

States are tables of rows that add up, so a user of any share of all rows is many rows.
A state moved on is a new folder; the old one stays until it is complete.
"""

from __future__ import annotations

from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline import config as c
from stayline.operators.anchors import _day
from stayline.operators.rollup import DAY, FAR_GAP, USER, DayTables, Rollup, facet_rows
from stayline.sources.events import as_date, between_days

#: Days of a state: the windows before a snapshot and the label window from it on.
SPAN = c.FEATURE_WINDOW + c.LABEL_HORIZON
_TABLES = ("measures", "facets", "seen")


class State(NamedTuple):
    """What is known of the days up to and including ``through``."""

    through: date
    measures: DataFrame
    facets: DataFrame
    seen: DataFrame
    spec: Rollup

    @property
    def first(self) -> date:
        return self.through - timedelta(days=SPAN - 1)

    def tables(self) -> DayTables:
        """The state in place of day tables, for calendar features."""
        return DayTables(self.measures, self.facets, self.spec)

    def snapshot(self) -> date:
        """The snapshot whose label window the state closes."""
        return self.through - timedelta(days=c.LABEL_HORIZON - 1)


def start(days: DayTables, through) -> State:
    """The state of a day from the day tables of its whole span."""
    through = _day(through)
    spanned = days.between(through - timedelta(days=SPAN - 1), through)
    seen = spanned.values.groupBy(USER, "kind", "value").agg(F.max(DAY).alias("last_day"))
    return State(through, spanned.measures, facet_rows(spanned.values, days.spec), seen, days.spec)


def advance(state: State, days: DayTables) -> State:
    """The state of the next day; of ``days`` only that day is read."""
    spec, day = state.spec, state.through + timedelta(days=1)
    first, today = day - timedelta(days=SPAN - 1), as_date(day)
    new = days.between(day, day)
    values = new.values.where(F.col("kind").isin(*spec.facets))
    # Today's values have no later day, so their gaps are open.
    opened = facet_rows(values, spec)
    again = values.select(USER, "kind", "value").join(state.seen, [USER, "kind", "value"])
    gap = F.datediff(today, "last_day")
    again = again.where((gap < FAR_GAP) & (F.col("last_day") >= as_date(first)))
    moves = again.groupBy(USER, F.col("last_day").alias(DAY), gap.alias("gap")).agg(
        *[F.count_if(F.col("kind") == kind).alias(f"distinct_{kind}") for kind in spec.facets])
    moves = moves.withColumn("step", F.explode(F.array(F.lit(1), F.lit(-1))))
    moves = moves.select(
        USER, DAY, F.when(F.col("step") < 0, FAR_GAP).otherwise(F.col("gap")).alias("gap"),
        *[(F.col(f"distinct_{kind}") * F.col("step")).alias(f"distinct_{kind}") for kind in spec.facets])
    kept = between_days(state.facets, first, day)
    every = kept.unionByName(opened).unionByName(moves, allowMissingColumns=True)
    sums = [f"coalesce(sum({n}), 0L) AS {n}" for kind, facet in spec.facets.items() for n in (f"distinct_{kind}", *facet.counts)]
    ends = [f"{how}({name}_{kind}) AS {name}_{kind}" for kind, facet in spec.facets.items() if facet.ends
            for how, name in (("min", "first"), ("max", "latest"))]
    facets = every.groupBy(USER, DAY, "gap").agg(*map(F.expr, (*sums, *ends)))
    seen = state.seen.where(F.col("last_day") >= as_date(first)).unionByName(
        new.values.select(USER, "kind", "value", F.col(DAY).alias("last_day")))
    seen = seen.groupBy(USER, "kind", "value").agg(F.max("last_day").alias("last_day"))
    measures = between_days(state.measures, first, day).unionByName(new.measures)
    return State(day, measures, facets, seen, spec)


def write_state(state: State, path: str) -> State:
    """The state as tables below ``path/<day>``, read back."""
    spark = state.measures.sparkSession
    at = f"{path}/{state.through}"
    for name in _TABLES:
        getattr(state, name).write.mode("overwrite").parquet(f"{at}/{name}")
    return State(state.through, *(
        spark.read.schema(getattr(state, n).schema).parquet(f"{at}/{n}") for n in _TABLES), state.spec)


def read_state(spark: SparkSession, path: str, through, spec: Rollup) -> State:
    at = f"{path}/{through}"
    return State(_day(through), *(spark.read.parquet(f"{at}/{n}") for n in _TABLES), spec)
