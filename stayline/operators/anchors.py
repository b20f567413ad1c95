"""Anchors and cohorts: which users are looked at, and from which day.

Milestone anchors follow from the user's install date, so day rows are joined
with the cohort; calendar anchors are literal dates and need no join.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline import config as c
from stayline.operators.rollup import DAY, USER
from stayline.sources.events import as_date, between_days


def _day(value) -> date:
    return value if isinstance(value, date) else date.fromisoformat(str(value))


def snapshot_dates(first, last, step: int = 1) -> list[date]:
    """Calendar anchors from ``first`` to ``last``."""
    first, last = _day(first), _day(last)
    return [first + timedelta(days=n) for n in range(0, (last - first).days + 1, step)]


def milestone_slices(install_from, install_to, milestones=c.MILESTONES) -> list[tuple[date, int]]:
    """(install day, milestone) pairs of a range."""
    return [(day, m) for day in snapshot_dates(install_from, install_to) for m in milestones]


def milestone_scan(slices) -> tuple[date, date]:
    """First and last event day that a build of these slices can read."""
    return (
        min(day for day, _ in slices) - timedelta(days=c.FEATURE_WINDOW),
        max(day + timedelta(days=m) for day, m in slices) + timedelta(days=c.LABEL_HORIZON - 1),
    )


def calendar_scan(first, last) -> tuple[date, date]:
    """First and last event day that a calendar build can read."""
    return (
        _day(first) - timedelta(days=c.FEATURE_WINDOW),
        _day(last) + timedelta(days=c.LABEL_HORIZON - 1),
    )


#: Day rows that a task multiplies and sorts; fewer than so many tasks' rows are left to adaptive execution.
TASK_ROWS, FEW_TASKS = 50_000, 8


def tasks_for(n: int | None) -> int | None:
    """Tasks for ``n`` day rows, None where adaptive execution may choose.

    The aggregates over anchored rows sort several times the rows that arrive, so tasks
    cut by shuffled bytes alone would spill.
    """
    tasks = (n or 0) // TASK_ROWS
    return tasks if tasks >= FEW_TASKS else None


def by_user(rows: DataFrame, tasks: int | None) -> DataFrame:
    return rows.repartition(tasks, USER) if tasks else rows.repartition(USER)


def milestone_rows(rows: DataFrame, anchors: DataFrame, as_of=None,
                   batch_bound: bool = False, within=(1 - c.LABEL_HORIZON, None), n: int | None = None) -> DataFrame:
    """Day rows of the anchored users, once per milestone, with ``d``.

    ``anchors`` has one row per user with the install date and an array of
    milestones.  Both sides hold a bounded number of rows per user.  The rows move by
    user before they are multiplied, not after; adaptive execution broadcasts the anchors
    when they turn out small, as in a daily run, else they move to the rows.  The
    following aggregate uses the partitioning again.  ``n`` is the number of day rows,
    where it is known.

    ``batch_bound`` keeps everything the scan delivered instead of the 30 days
    before the user's install.  ``as_of`` drops anchors that lie in the future.
    ``within`` bounds ``d``; the upper bound may be None.
    """
    tasks = tasks_for(n)
    joined = by_user(rows, tasks).join(by_user(anchors, tasks) if tasks else anchors, USER)
    if not batch_bound:
        joined = joined.where(F.col(DAY) >= F.date_sub("install_date", c.FEATURE_WINDOW))
    # Only the milestones whose windows or label reach the day are multiplied out.
    low, high = within
    to_anchor = f"datediff(install_date, {DAY}) + m"
    reached = f"{to_anchor} >= {low}" if high is None else f"{to_anchor} BETWEEN {low} AND {high}"
    reach = f"filter(milestones, m -> {reached})"
    anchored = (
        joined.withColumn("milestone_day", F.explode(F.expr(reach))).drop("milestones")
        .withColumn("d", F.expr(f"datediff(install_date, {DAY}) + milestone_day"))
    )
    if as_of is not None:
        anchored = anchored.where(
            F.expr("date_add(install_date, milestone_day)") <= as_date(as_of)
        )
    return anchored


def with_milestones(cohort: DataFrame, slices) -> DataFrame:
    """The cohort with the milestones due for each install day, as an array."""
    due: dict[date, list[int]] = {}
    for day, milestone in slices:
        due.setdefault(day, []).append(milestone)
    if len({tuple(x) for x in due.values()}) == 1 and len(due) == (max(due) - min(due)).days + 1:
        return cohort.withColumn("milestones", F.lit(next(iter(due.values()))))
    # One row per install day.
    table = cohort.sparkSession.createDataFrame(
        list(due.items()), "install_date date, milestones array<int>"
    )
    return cohort.join(F.broadcast(table), "install_date")


def calendar_rows(rows: DataFrame, dates, within=(1 - c.LABEL_HORIZON, None), n: int | None = None) -> DataFrame:
    """Day rows, once per snapshot date whose windows contain the day.

    The rows move by user before they are multiplied, not after.  ``within``
    bounds ``d``; without an upper bound it is the feature window.  ``n`` is the number
    of day rows, where it is known.
    """
    dates = sorted(_day(x) for x in dates)
    if len(dates) > 1:
        rows = by_user(rows, tasks_for(n))
    # Only the dates within reach of the day are multiplied out.
    low, high = within
    high = c.FEATURE_WINDOW if high is None else min(high, c.FEATURE_WINDOW)
    reach = F.filter(F.lit(dates), lambda x: F.datediff(x, F.col(DAY)).between(low, high))
    return rows.withColumn("snapshot_date", F.explode(reach)).withColumn(
        "d", F.datediff("snapshot_date", DAY))


def user_install_date(events: DataFrame, column: str = "install_date") -> DataFrame:
    """One install date per user: the earliest one seen."""
    return events.groupBy(USER).agg(
        F.min(F.expr(f"cast({column} AS date)")).alias("install_date")
    )


def install_cohort(events: DataFrame, install_from, install_to) -> DataFrame:
    """Users installed in the range, seen within one day of their install.

    The last condition makes a wide range equal to the union of its days.
    """
    near = _around_install_days(events, install_from, install_to).where(
        F.expr(f"abs(datediff({DAY}, cast(install_date AS date))) <= 1")
    )
    return _installed_between(user_install_date(near), install_from, install_to)


def rolled_up_cohort(measures: DataFrame, install_from, install_to) -> DataFrame:
    """The same cohort from day measures, where the one-day rule is already applied."""
    near = _around_install_days(measures, install_from, install_to)
    return _installed_between(
        user_install_date(near, "install_near"), install_from, install_to
    )


def _around_install_days(rows: DataFrame, install_from, install_to) -> DataFrame:
    return between_days(
        rows, _day(install_from) - timedelta(days=1), _day(install_to) + timedelta(days=1)
    )


def _installed_between(users: DataFrame, first, last) -> DataFrame:
    return users.where(
        (F.col("install_date") >= as_date(first)) & (F.col("install_date") <= as_date(last))
    )


def milestone_anchors(cohort: DataFrame, milestones=c.MILESTONES) -> DataFrame:
    """One row per user and milestone with the anchor date."""
    return cohort.withColumn("milestone_day", F.explode(F.lit(list(milestones)))).withColumn(
        "snapshot_date", F.expr("date_add(install_date, milestone_day)")
    )


def calendar_cohort(events: DataFrame, snapshot) -> DataFrame:
    """Users installed in the 30 days up to the snapshot, with any event in its windows."""
    snapshot = _day(snapshot)
    scanned = between_days(events, *calendar_scan(snapshot, snapshot))
    youngest = snapshot - timedelta(days=c.MAX_INSTALL_AGE_DAYS)
    return _installed_between(user_install_date(scanned), youngest, snapshot).withColumn(
        "snapshot_date", as_date(snapshot)
    )


def label_complete_slices(run_date, milestones=c.MILESTONES) -> list[tuple[date, int]]:
    """(install date, milestone) pairs whose label window closed on the run day."""
    run = _day(run_date)
    return [(run - timedelta(days=m + c.LABEL_HORIZON), m) for m in milestones]


def rolling_install_range(run_date, days: int = 28) -> tuple[date, date]:
    """Install days of the rolling cohort."""
    run = _day(run_date)
    return run - timedelta(days=days), run


def default_install_day(today) -> date:
    """The cohort built when no range is given: yesterday's installs."""
    return _day(today) - timedelta(days=1)
