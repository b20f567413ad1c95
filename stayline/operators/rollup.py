"""Reduce events to a bounded number of rows per user and day.

Every feature looks at whole days, so events are first summed per
``(user, day)``.  This is what makes the wide, anchored aggregation safe: a
user with billions of events enters it with one row per day, whatever share of
the table that user owns.  Only partial aggregates of events are shuffled.

Two narrow passes with nearly disjoint columns feed two tables:

* *measures*: counters, sums, maxima and the latest attribute of the day;
* *values*: one row per ``(user, kind, value, day)`` for what is counted per
  value or counted distinct (screens, buttons, sessions).

Both only look at one day, so they can be kept as tables partitioned by day and
extended day by day (:mod:`stayline.sources.store`).

Distinct counts over a window of days become plain sums by one observation: a
value is in the window exactly once as "last day seen within the window".
:func:`facet_rows` therefore gives each ``(user, value, day)`` its ``gap``, the
number of days until the value is seen again; it counts in a window that ends
before that day.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayline import config as c
from stayline.sources.events import between_days

USER, DAY = "user_pseudo_id", "event_date"

# One more than the longest window: "not seen again within any window".
FAR_GAP = c.FEATURE_WINDOW + 1


@dataclass(frozen=True)
class Facet:
    """Values of one kind, taken from an event by the SQL in ``value``.

    ``counts`` maps a day column to a predicate over ``value``; ``ends`` also
    keeps the first and the last value of the day.
    """

    value: str
    counts: Mapping[str, str] = field(default_factory=dict)
    ends: bool = False


@dataclass(frozen=True)
class Rollup:
    """What to keep per day; every string is SQL over event columns."""

    counts: Mapping[str, str] = field(default_factory=dict)
    sums: Mapping[str, str] = field(default_factory=dict)
    maxima: Mapping[str, str] = field(default_factory=dict)
    attributes: Mapping[str, str] = field(default_factory=dict)
    facets: Mapping[str, Facet] = field(default_factory=dict)
    # Attributes for which '' is a value like any other.
    allow_empty: tuple[str, ...] = ()

    def only(self, used: set[str]) -> Rollup:
        """The part of the rollup that delivers the day columns in ``used``."""

        def part(columns: Mapping[str, str]) -> dict[str, str]:
            return {n: x for n, x in columns.items() if n in used}

        facets = {}
        for kind, facet in self.facets.items():
            counts = part(facet.counts)
            ends = facet.ends and not used.isdisjoint({f"first_{kind}", f"latest_{kind}"})
            if counts or ends or f"distinct_{kind}" in used:
                facets[kind] = replace(facet, counts=counts, ends=ends)
        return replace(
            self, counts=part(self.counts), sums=part(self.sums), maxima=part(self.maxima),
            attributes={n: x for n, x in self.attributes.items() if f"latest_{n}" in used},
            facets=facets,
        )


class DayTables(NamedTuple):
    """The two reduced tables of one rollup."""

    measures: DataFrame
    values: DataFrame | None
    spec: Rollup
    #: number of measure rows, where it is known
    rows: int | None = None

    def between(self, first, last) -> DayTables:
        values = self.values if self.values is None else between_days(self.values, first, last)
        return self._replace(measures=between_days(self.measures, first, last), values=values)


def day_tables(events: DataFrame, spec: Rollup) -> DayTables:
    """Reduce events according to a rollup."""
    values = value_rows(events, spec) if spec.facets else None
    return DayTables(measure_rows(events, spec), values, spec)


def measure_rows(events: DataFrame, spec: Rollup) -> DataFrame:
    """One row per user and day."""
    installed = "cast(install_date AS date)"
    measures = [
        *[f"sum(CASE WHEN {cond} THEN 1L ELSE 0L END) AS {n}" for n, cond in spec.counts.items()],
        *[f"sum({x}) AS {n}" for n, x in spec.sums.items()],
        *[f"max({x}) AS {n}" for n, x in spec.maxima.items()],
        f"min({installed}) AS install_any",
        f"min(CASE WHEN abs(datediff({DAY}, {installed})) <= 1 THEN {installed} END)"
        " AS install_near",
    ]
    if not spec.attributes:
        return events.groupBy(USER, DAY).agg(*map(F.expr, measures))

    # The attributes hardly change within a day, so grouping by them as they
    # are keeps numeric buffers only: a hash aggregate with map-side combine.
    # Only its few result rows go through the aggregate over strings.
    tuples = events.groupBy(
        USER, DAY, *[F.expr(f"{x} AS a_{n}") for n, x in spec.attributes.items()]
    ).agg(*map(F.expr, measures), F.expr("max(event_timestamp) AS seen"))

    def latest(name: str) -> str:
        usable = f"a_{name} IS NOT NULL" if name in spec.allow_empty else f"a_{name} <> ''"
        return (f"max(CASE WHEN {usable} THEN struct(seen AS at, a_{name} AS value) END)"
                f" AS latest_{name}")

    merged = [
        *[f"sum({n}) AS {n}" for n in (*spec.counts, *spec.sums)],
        *[f"max({n}) AS {n}" for n in spec.maxima],
        *[f"min({n}) AS {n}" for n in ("install_any", "install_near")],
        *[latest(n) for n in spec.attributes],
    ]
    return tuples.groupBy(USER, DAY).agg(*map(F.expr, merged))


def value_rows(events: DataFrame, spec: Rollup) -> DataFrame:
    """One row per user, kind, value and day."""
    pairs = ", ".join(f"'{kind}', {facet.value}" for kind, facet in spec.facets.items())
    wanted = " OR ".join(f"({facet.value}) IS NOT NULL" for facet in spec.facets.values())
    return (
        events.where(wanted)
        .select(USER, DAY, "event_timestamp",
                F.expr(f"stack({len(spec.facets)}, {pairs}) AS (kind, value)"))
        .where("value IS NOT NULL")
        .groupBy(USER, "kind", "value", DAY)
        .agg(F.count(F.lit(1)).alias("n"),
             F.min("event_timestamp").alias("first_at"),
             F.max("event_timestamp").alias("last_at"))
    )


def facet_rows(values: DataFrame, spec: Rollup) -> DataFrame:
    """One row per user, day and gap; at most ``FAR_GAP`` rows per user and day.

    Rows that have their gap, as in a state moved on day by day, stay as they are.
    """
    if "gap" in values.columns:
        return values
    values = values.where(F.col("kind").isin(*spec.facets))
    # One row per day and value, so a window partition is bounded by the scan.
    again = F.lead(DAY).over(Window.partitionBy(USER, "kind", "value").orderBy(DAY))
    gapped = values.withColumn(
        "gap", F.least(F.coalesce(F.datediff(again, DAY), F.lit(FAR_GAP)), F.lit(FAR_GAP))
    )
    return gapped.groupBy(USER, DAY, "gap").agg(*map(F.expr, facet_measures(spec)))


def facet_measures(spec: Rollup) -> list[str]:
    """What is kept per user, day and gap, as SQL over values."""
    measures = []
    for kind, facet in spec.facets.items():
        own = f"CASE WHEN kind = '{kind}'"
        measures.append(f"sum({own} THEN 1L ELSE 0L END) AS distinct_{kind}")
        measures += [f"sum({own} AND {pred} THEN n ELSE 0L END) AS {name}"
                     for name, pred in facet.counts.items()]
        if facet.ends:
            measures += [
                f"min({own} THEN struct(first_at AS at, value) END) AS first_{kind}",
                f"max({own} THEN struct(last_at AS at, value) END) AS latest_{kind}",
            ]
    return measures
