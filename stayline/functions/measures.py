"""Aggregates over day rows around an anchor, as SQL text.

The input is the result of :func:`stayline.operators.rollup.day_rows` with a
column ``d``, the number of days from the event day to the anchor.  The past is
``d >= 1``, the last *n* days are ``d BETWEEN 1 AND n`` and the days from the
anchor on are ``d <= 0``: no feature here reads a row with ``d < 1``, only the
label does.

Text, not columns: a feature is then a plain value that can be listed and
searched for its inputs without a session.
"""

from __future__ import annotations

from stayline import config as c


def _days(n: int, first_day: int) -> str:
    return f"d BETWEEN {first_day} AND {n}"


def _at_most(n: int, most: int) -> None:
    if n > most:
        raise ValueError(f"a window of {n} days exceeds {most}")


def sum_in_days(measure: str, n: int, first_day: int = 1) -> str:
    """Sum of a day measure, 0 when there is none."""
    return f"coalesce(sum(CASE WHEN {_days(n, first_day)} THEN {measure} END), 0)"


def count_in_days(measure: str, n: int, first_day: int = 1) -> str:
    """Sum of a day counter as a long."""
    return f"cast({sum_in_days(measure, n, first_day)} AS bigint)"


def distinct_in_days(facet: str, n: int, first_day: int = 1) -> str:
    """Exact number of distinct facet values seen in the window.

    A value counts on the last day it was seen within the window, that is
    when it comes back only after the window has ended.  Gaps are known up to
    the feature window, so longer windows are refused.
    """
    _at_most(n, c.FEATURE_WINDOW)
    return (
        f"coalesce(sum(CASE WHEN {_days(n, first_day)} AND gap > d - {first_day}"
        f" THEN distinct_{facet} END), 0L)"
    )


def days_with(measure: str, n: int) -> str:
    """Number of days on which the counter was positive; the days are bits of a long."""
    _at_most(n, 63)
    seen = f"CASE WHEN {_days(n, 1)} AND {measure} > 0 THEN shiftleft(1L, d - 1) END"
    return f"cast(bit_count(coalesce(bit_or({seen}), 0L)) AS bigint)"


def max_before(measure: str) -> str:
    """Maximum over the past, 0 when there is none."""
    return f"coalesce(max(CASE WHEN d >= 1 THEN {measure} END), 0)"


def latest_before(name: str) -> str:
    """Latest value over the past, '' when there is none.

    Equal timestamps are settled by the greater value.
    """
    return f"coalesce(max(CASE WHEN d >= 1 THEN latest_{name} END).value, '')"


def first_before(name: str) -> str:
    """First value over the past, '' when there is none."""
    return f"coalesce(min(CASE WHEN d >= 1 THEN first_{name} END).value, '')"


def recency_hours(measure: str, never: int = c.NEVER_HOURS) -> str:
    """Hours since the last day with a positive counter."""
    return (
        f"coalesce(min(CASE WHEN d >= 1 AND {measure} > 0 THEN d END) * 24L, {never}L)"
    )


def ever(measure: str) -> str:
    """1 when the counter was positive on any past day, else 0."""
    return f"max(CASE WHEN d >= 1 AND {measure} > 0 THEN 1 ELSE 0 END)"


def within_horizon(measure: str, horizon: int = c.LABEL_HORIZON) -> str:
    """1 when the counter is positive in ``[anchor, anchor + horizon)``."""
    return (
        f"max(CASE WHEN d BETWEEN {1 - horizon} AND 0 AND {measure} > 0 THEN 1 ELSE 0 END)"
    )


# --- over finished measures ------------------------------------------------


def safe_ratio(part: str, whole: str, default: float = 0.0) -> str:
    """``part / whole``, or the default when ``whole`` is not positive."""
    return (
        f"CASE WHEN {whole} > 0 THEN cast({part} AS double) / cast({whole} AS double)"
        f" ELSE cast({default} AS double) END"
    )


def trend_ratio(current: str, previous: str) -> str:
    """Growth from one window to the next: 2 from nothing, 1 when both are empty."""
    return (
        f"CASE WHEN {previous} > 0 THEN cast({current} AS double) / cast({previous} AS double)"
        f" WHEN {current} > 0 THEN 2.0D ELSE 1.0D END"
    )


def both(a: str, b: str) -> str:
    """1 when both flags are set, in any order of events."""
    return f"least({a}, {b})"


def funnel_depth(*steps: str) -> str:
    """Number of steps reached."""
    return " + ".join(steps)
