"""The feature snapshot: one row per user and anchor.

One column builder serves both anchors.  A section maps each feature to a
column; ``Measure`` and ``OfFacets`` columns are aggregates over the two kinds of
day rows, ``Derived`` columns are computed from finished aggregates.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline import config as c
from stayline.functions import measures as m
from stayline.operators import anchors
from stayline.operators.lookup import is_small
from stayline.operators.rollup import (
    USER, DayTables, Facet, Rollup, day_tables, facet_rows,
)
from stayline.sources.events import as_date, between_days


def _event(*names: str) -> str:
    return f"event_name IN ({c.sql_list(names)})"


CHURN_ROLLUP = Rollup(
    counts={
        "n_events": "true",
        "n_screen_views": _event(*c.SCREEN_EVENTS),
        "n_clicks": _event(c.CLICK_EVENT),
        "n_ads": _event(*c.AD_EVENTS),
        "n_load_ad": _event(c.LOAD_AD_EVENT),
        "n_show_ad": _event(c.SHOW_AD_EVENT),
        "n_paid_ad": _event(c.PAID_AD_EVENT),
        "n_engagements": _event(c.ENGAGEMENT_EVENT),
        "n_purchases": _event(c.PURCHASE_EVENT),
        "n_exceptions": _event(c.EXCEPTION_EVENT),
        "n_clear_data": _event(c.CLEAR_DATA_EVENT),
        "n_updates": _event(c.UPDATE_EVENT),
        "n_exits": _event(c.EXIT_EVENT),
        "n_removals": _event(c.REMOVE_EVENT),
        "n_attributions": _event(c.ATTRIBUTION_EVENT),
    },
    # A decimal sum does not depend on the order of the rows.
    sums={
        "engagement": "engagement_time",
        "revenue": "cast(ep_revenue AS decimal(20, 6))",
    },
    maxima={
        "age_days": "days_since_install",
        "age_hours": "hours_since_install",
        "age_minutes": "minutes_since_install",
        "age_seconds": "seconds_since_install",
    },
    attributes={
        "media_source": "up_af_media_source",
        "campaign": "up_af_campaign",
        "country": "country",
        "language": "up_language",
        "app_version": "app_version",
        "platform": "platform",
        "notification": "up_allow_notification",
    },
    allow_empty=("app_version", "platform", "notification"),
    facets={
        "session": Facet(f"CASE WHEN {_event(c.SESSION_EVENT)} THEN unique_session_id END"),
        "screen": Facet(
            "nullif(mapped_screen, '')",
            counts={
                "n_screens": "true",
                "n_permission_screens": f"value LIKE '{c.PERMISSION_PATTERN}'",
                **{f"screen_{c.column_name(s)}": f"value = '{s}'" for s in c.SCREENS},
            },
            ends=True,
        ),
        "button": Facet(
            "nullif(click_button_name, '')",
            counts={
                "n_search_buttons": f"value IN ({c.sql_list(c.SEARCH_BUTTONS)})",
                **{f"btn_{c.column_name(b)}": f"value = '{b}'" for b in c.BUTTONS},
            },
            ends=True,
        ),
    },
)


class Measure(NamedTuple):
    """Aggregate over day measures."""

    sql: str


class OfFacets(NamedTuple):
    """Aggregate over facet rows; users without any facet row get the default."""

    sql: str
    default: object = 0


class Derived(NamedTuple):
    """Computed from other features."""

    sql: str


def _screen(name: str) -> str:
    return f"screen_{c.column_name(name)}"


def _screens_7d(*names: str) -> str:
    return "(" + " + ".join(f"{_screen(s)}_cnt_7d" for s in names) + ")"


def _any_screen(*names: str) -> str:
    return m.ever(" + ".join(_screen(s) for s in names))


def helpers() -> dict[str, Measure | OfFacets]:
    """Aggregates that only feed derived features."""
    return {
        "_session_cnt_prev": OfFacets(m.distinct_in_days("session", 14, first_day=8)),
        "_engagement_prev": Measure(m.count_in_days("engagement", 14, first_day=8)),
        "_screens_7d": OfFacets(m.count_in_days("n_screens", 7)),
        "_screen_views_7d": Measure(m.count_in_days("n_screen_views", 7)),
        "_ever_exit": Measure(m.ever("n_exits")),
        "_ever_song_or_video": OfFacets(_any_screen(c.SONG_SCREEN, c.VIDEO_SCREEN)),
        "_ever_video": OfFacets(_any_screen(c.VIDEO_SCREEN)),
        "_churned": Measure(m.ever("n_removals")),
        c.LABEL: Measure(m.within_horizon("n_removals")),
    }


def sections() -> dict[str, dict[str, Measure | OfFacets | Derived]]:
    """Feature columns by section, in output order."""
    M, V, D = Measure, OfFacets, Derived
    return {
        "a": {
            "media_source": M(m.latest_before("media_source")),
            "campaign": M(m.latest_before("campaign")),
            "has_attribution": M(m.ever("n_attributions")),
        },
        "b": {
            "country": M(m.latest_before("country")),
            "language": M(m.latest_before("language")),
        },
        "c": {
            "app_version": M(m.latest_before("app_version")),
            "platform": M(m.latest_before("platform")),
        },
        "d": {
            "days_since_install": M(m.max_before("age_days")),
            "hours_since_install": M(m.max_before("age_hours")),
            "minutes_since_install": M(m.max_before("age_minutes")),
            "seconds_since_install": M(m.max_before("age_seconds")),
            "is_day0_user": D("cast(days_since_install = 0 AS int)"),
            "is_day1_user": D("cast(days_since_install = 1 AS int)"),
            "is_week1_user": D("cast(days_since_install <= 7 AS int)"),
        },
        "e": {
            **{f"session_cnt_{n}d": V(m.distinct_in_days("session", n))
               for n in (1, 3, 7, 14, 30)},
            "active_days_7d": M(m.days_with("n_events", 7)),
            "active_days_30d": M(m.days_with("n_events", 30)),
            "avg_sessions_per_day_7d": D(m.safe_ratio("session_cnt_7d", "active_days_7d")),
            "session_trend_7d": D(m.trend_ratio("session_cnt_7d", "_session_cnt_prev")),
        },
        "f": {
            **{f"engagement_time_ms_{n}d": M(m.count_in_days("engagement", n))
               for n in (1, 3, 7, 30)},
            "avg_engagement_per_session_7d": D(
                m.safe_ratio("engagement_time_ms_7d", "session_cnt_7d")
            ),
            "engagement_trend_7d": D(m.trend_ratio("engagement_time_ms_7d", "_engagement_prev")),
        },
        "g": {
            "hours_since_last_session": M(m.recency_hours("n_events")),
            "hours_since_last_screen": M(m.recency_hours("n_screen_views")),
            "hours_since_last_click": M(m.recency_hours("n_clicks")),
            "hours_since_last_ad": M(m.recency_hours("n_ads")),
            "hours_since_last_search": V(m.recency_hours("n_search_buttons"), c.NEVER_HOURS),
            "hours_since_last_engagement": M(m.recency_hours("n_engagements")),
        },
        "h": {
            **{f"{_screen(s)}_cnt_7d": V(m.count_in_days(_screen(s), 7)) for s in c.SCREENS},
            "unique_screen_cnt_7d": V(m.distinct_in_days("screen", 7)),
            "home_ratio_7d": D(m.safe_ratio(_screens_7d(c.HOME_SCREEN), "_screens_7d")),
            "video_ratio_7d": D(m.safe_ratio(_screens_7d(*c.VIDEO_SCREENS), "_screens_7d")),
            "lyrics_ratio_7d": D(m.safe_ratio(_screens_7d(c.LYRICS_SCREEN), "_screens_7d")),
            "permission_screen_ratio_7d": D(
                m.safe_ratio("permission_screen_cnt_7d", "_screens_7d")
            ),
        },
        "i": {
            **{f"btn_{c.column_name(b)}_cnt_7d": V(m.count_in_days(f"btn_{c.column_name(b)}", 7))
               for b in c.BUTTONS},
            "unique_button_cnt_7d": V(m.distinct_in_days("button", 7)),
        },
        "j": {
            "search_online_cnt_7d": D("btn_Search_cnt_7d"),
            "search_quick_cnt_7d": D("btn_QuickSearchClicked_cnt_7d"),
            "search_screen_cnt_7d": D(_screens_7d(c.SEARCH_SCREEN)),
            "used_search_7d": D(
                "cast(btn_Search_cnt_7d + btn_QuickSearchClicked_cnt_7d > 0 AS int)"
            ),
            "search_days_7d": V(m.days_with("n_search_buttons", 7)),
        },
        "k": {
            "lyrics_screen_cnt_7d": D(_screens_7d(c.LYRICS_SCREEN)),
            "audio_player_cnt_7d": D(_screens_7d(c.SONG_SCREEN)),
            "playlist_cnt_7d": D(_screens_7d(*c.PLAYLIST_SCREENS)),
            "queue_cnt_7d": D(_screens_7d(c.QUEUE_SCREEN)),
            "audio_screen_ratio_7d": D(
                m.safe_ratio(_screens_7d(*c.AUDIO_SCREENS), "_screen_views_7d")
            ),
        },
        "l": {
            "video_player_cnt_7d": D(_screens_7d(c.VIDEO_SCREEN)),
            "video_tab_cnt_7d": D(_screens_7d(c.VIDEO_TAB_SCREEN)),
            "floating_video_cnt_7d": D(_screens_7d(c.FLOATING_VIDEO_SCREEN)),
        },
        "m": {
            "seen_notification_permission": V(_any_screen(c.NOTIFICATION_SCREEN)),
            "seen_any_permission": V(m.ever("n_permission_screens")),
            "permission_screen_cnt_7d": V(m.count_in_days("n_permission_screens", 7)),
            "notif_permission_status": M(m.latest_before("notification")),
        },
        "n": {
            "load_ad_cnt_7d": M(m.count_in_days("n_load_ad", 7)),
            "show_ad_cnt_7d": M(m.count_in_days("n_show_ad", 7)),
            "paid_ad_impression_cnt_7d": M(m.count_in_days("n_paid_ad", 7)),
            "ads_per_session_7d": D(m.safe_ratio("show_ad_cnt_7d", "session_cnt_7d")),
            "ad_revenue_7d": M(f"cast({m.sum_in_days('revenue', 7)} AS double)"),
        },
        "o": {
            "iap_cnt_30d": M(m.count_in_days("n_purchases", 30)),
            "payer_flag": M(m.ever("n_purchases")),
        },
        "p": {
            "app_exception_cnt_7d": M(m.count_in_days("n_exceptions", 7)),
            "app_clear_data_cnt_30d": M(m.count_in_days("n_clear_data", 30)),
            "app_update_cnt_30d": M(m.count_in_days("n_updates", 30)),
            "app_exit_cnt_7d": M(m.count_in_days("n_exits", 7)),
        },
        "q": {
            "first_screen": V(m.first_before("screen"), ""),
            "last_screen": V(m.latest_before("screen"), ""),
            "first_button": V(m.first_before("button"), ""),
            "last_button": V(m.latest_before("button"), ""),
            "home_to_search_flag": D(m.both("visited_home", "visited_search")),
            "search_to_lyrics_flag": D(m.both("visited_search", "visited_lyrics")),
            "search_to_video_flag": D(m.both("visited_search", "_ever_video")),
            "lyrics_to_exit_flag": D(m.both("visited_lyrics", "_ever_exit")),
            "permission_to_exit_flag": D(m.both("seen_any_permission", "_ever_exit")),
        },
        "r": {
            "visited_home": V(_any_screen(c.HOME_SCREEN)),
            "visited_player": V(_any_screen(c.SONG_SCREEN, c.LYRICS_SCREEN, c.VIDEO_SCREEN)),
            "visited_lyrics": V(_any_screen(c.LYRICS_SCREEN)),
            "visited_search": V(_any_screen(c.SEARCH_SCREEN)),
            "visited_video": V(_any_screen(c.VIDEO_SCREEN, c.VIDEO_TAB_SCREEN)),
            "visited_playlist": V(_any_screen(*c.PLAYLIST_SCREENS)),
            "visited_scan_music": V(_any_screen(c.SCAN_SCREEN)),
            "funnel_depth": D(m.funnel_depth(
                "visited_home", "_ever_song_or_video", "visited_lyrics",
                "visited_search", "visited_playlist",
            )),
        },
        "t": {
            f"{dim}_uninstall_rate": D(f"cast({c.UNKNOWN_RATE} AS double)") for dim in c.RISK_DIMENSIONS
        },
    }


SECTIONS = sections()
FEATURES = {name: spec for part in SECTIONS.values() for name, spec in part.items()}
AGGREGATES = {
    **{n: spec for n, spec in FEATURES.items() if not isinstance(spec, Derived)}, **helpers(),
}

# Numerical inputs of the models, then the categories.
MODEL_INPUTS = [n for n in FEATURES if n not in {*c.STORED_ONLY, *c.CATEGORICAL_FEATURES}] + list(
    c.CATEGORICAL_FEATURES
)

Aggregates = dict[str, "Measure | OfFacets"]


def _names(sql: str) -> set[str]:
    return set(re.findall(r"[A-Za-z_]\w*", sql))


def aggregates_for(columns) -> Aggregates:
    """The aggregates behind some features."""
    needed: set[str] = set()
    for name in columns:
        spec = FEATURES.get(name)
        needed |= _names(spec.sql) if isinstance(spec, Derived) else {name}
    return {n: spec for n, spec in AGGREGATES.items() if n in needed}


# Windows of up to so many days are aggregated apart from longer ones.
RECENT_DAYS = 7
ANY_DAY = (1 - c.LABEL_HORIZON, None)


def _days_read(sql: str) -> tuple[int, int | None]:
    """The least and the greatest ``d`` that an aggregate reads, as far as its text says."""
    windows = [(int(a), int(b)) for a, b in re.findall(r"\bd BETWEEN (-?\d+) AND (-?\d+)", sql)]
    past = re.findall(r"\bd >= 1\b", sql)
    if not windows and not past:
        return ANY_DAY
    low = min([a for a, _ in windows] + [1] * bool(past))
    return low, None if past else max(b for _, b in windows)


def _parts(of_facets: Aggregates, stored: bool):
    """Facet aggregates to compute together, with the ``d`` they read.

    Most of them look at a few days only, so over stored rows these are aggregated
    apart: few rows meet many columns, and the others stay narrow.
    """
    if not stored:
        return [(of_facets, ANY_DAY)]
    parts: dict[bool, Aggregates] = {}
    for name, spec in of_facets.items():
        low, high = _days_read(spec.sql)
        recent = low >= 1 and high is not None and high <= RECENT_DAYS
        parts.setdefault(recent, {})[name] = spec
    return [(part, (1, RECENT_DAYS) if recent else
             (min(_days_read(s.sql)[0] for s in part.values()), None))
            for recent, part in parts.items()]


def _aggregate(tables: DayTables, anchor, keys: tuple[str, ...],
               aggregates: Aggregates) -> DataFrame:
    """Aggregates per anchor; ``anchor`` turns day rows into anchored rows.

    The two kinds of rows are aggregated apart, so that neither carries the
    other's columns, and joined at the size of the result.  Everyone has day
    measures; who has no facet row gets the defaults.
    """
    result = anchor(tables.measures, ANY_DAY).groupBy(*keys).agg(
        F.min("install_date").alias("install_date"),
        *[F.expr(f"{s.sql} AS {n}") for n, s in aggregates.items() if isinstance(s, Measure)],
    )
    of_facets = {n: s for n, s in aggregates.items() if isinstance(s, OfFacets)}
    if of_facets:
        rows = facet_rows(tables.values, tables.spec)
        for part, within in _parts(of_facets, "gap" in tables.values.columns):
            faceted = anchor(rows, within).groupBy(*keys).agg(
                *[F.expr(f"{s.sql} AS {n}") for n, s in part.items()]
            )
            result = result.join(faceted, list(keys), "left").na.fill(
                {n: s.default for n, s in part.items()}
            )
    return result


def _tables(events: DataFrame | DayTables, scan, spec: Rollup,
            aggregates: Aggregates) -> DayTables:
    """Day tables of the scanned days, as far as the aggregates need them."""
    used = set().union(*[_names(s.sql) for s in aggregates.values()]) if aggregates else set()
    if isinstance(events, DayTables):
        return events.between(*scan)._replace(spec=events.spec.only(used))
    return day_tables(between_days(events, *scan), spec.only(used))


def at_milestones(events: DataFrame | DayTables, spec: Rollup, aggregates: Aggregates,
                  slices, *, as_of=None, batch_bound: bool = False,
                  narrow: bool = False) -> DataFrame:
    """Any aggregates of (install day, milestone) slices.

    With ``narrow`` the cohort is counted first; if it is small, events of
    other users are dropped in the scan, before anything is shuffled.
    """
    scan = anchors.milestone_scan(slices)
    days = [day for day, _ in slices]
    if isinstance(events, DayTables):
        cohort = anchors.rolled_up_cohort(events.measures, min(days), max(days))
    else:
        cohort = anchors.install_cohort(events, min(days), max(days))
    anchored = anchors.with_milestones(cohort, slices)
    if narrow and not isinstance(events, DayTables) and is_small(anchored):
        events = events.join(F.broadcast(anchored.select(USER)), USER, "left_semi")

    def anchor(rows: DataFrame, within) -> DataFrame:
        return anchors.milestone_rows(rows, anchored, as_of, batch_bound, within, tables.rows)

    tables = _tables(events, scan, spec, aggregates)
    return _aggregate(
        tables, anchor, (USER, "milestone_day"), aggregates
    ).withColumn("snapshot_date", F.expr("date_add(install_date, milestone_day)"))


def at_dates(events: DataFrame | DayTables, spec: Rollup, aggregates: Aggregates,
             dates) -> DataFrame:
    """Any aggregates at calendar dates, for users installed in the 30 days before each."""
    dates = sorted(anchors._day(x) for x in dates)
    tables = _tables(events, anchors.calendar_scan(dates[0], dates[-1]), spec, aggregates)
    tables = tables._replace(
        measures=tables.measures.withColumnRenamed("install_any", "install_date")
    )
    result = _aggregate(
        tables, lambda rows, within: anchors.calendar_rows(rows, dates, within, tables.rows),
        (USER, "snapshot_date"), aggregates,
    )
    age = F.datediff("snapshot_date", "install_date")
    return result.where(age.between(0, c.MAX_INSTALL_AGE_DAYS)).withColumn(
        "milestone_day", F.lit(0)
    )


def _finish(frame: DataFrame, columns, as_of) -> DataFrame:
    """Features in output order, the label last."""
    if as_of is not None and c.LABEL in columns:
        # Unknown while the label window is open.
        closed = F.date_add("snapshot_date", c.LABEL_HORIZON) <= as_date(as_of)
        frame = frame.withColumn(c.LABEL, F.when(closed, F.col(c.LABEL)))
    return frame.selectExpr(
        "snapshot_date", USER, "install_date", "milestone_day",
        *[f"{FEATURES[n].sql} AS {n}" if isinstance(FEATURES.get(n), Derived) else n
          for n in columns],
    )


ALL_COLUMNS = (*FEATURES, c.LABEL)


def milestone_features(events: DataFrame | DayTables, install_from, install_to,
                       milestones=c.MILESTONES, **options) -> DataFrame:
    """Feature rows at fixed ages, all milestones in one job."""
    slices = anchors.milestone_slices(install_from, install_to, milestones)
    return slice_features(events, slices, **options)


def slice_features(events: DataFrame | DayTables, slices, *, columns=ALL_COLUMNS,
                   exclude_churned: bool = True, as_of=None, batch_bound: bool = False,
                   narrow: bool = False) -> DataFrame:
    """Feature rows of (install day, milestone) slices, all in one job.

    Users who removed the app before an anchor are left out of it.  With fewer
    ``columns`` only what these need is read and shuffled.
    """
    needed = aggregates_for([*columns, "_churned"] if exclude_churned else columns)
    frame = at_milestones(
        events, CHURN_ROLLUP, needed, slices, as_of=as_of, batch_bound=batch_bound,
        narrow=narrow,
    )
    if exclude_churned:
        frame = frame.where("_churned = 0")
    return _finish(frame, columns, as_of)


def calendar_range(events: DataFrame | DayTables, dates, *, columns=ALL_COLUMNS,
                   exclude_churned: bool = False, require_past_event: bool = False,
                   as_of=None) -> DataFrame:
    """Feature rows at calendar dates, all dates in one job."""
    extra = ["_churned"] * exclude_churned + ["hours_since_last_session"] * require_past_event
    frame = at_dates(events, CHURN_ROLLUP, aggregates_for([*columns, *extra]), dates)
    if exclude_churned:
        frame = frame.where("_churned = 0")
    if require_past_event:
        frame = frame.where(F.col("hours_since_last_session") < c.NEVER_HOURS)
    return _finish(frame, columns, as_of)


def calendar_features(events: DataFrame | DayTables, snapshot_date, **options) -> DataFrame:
    """Feature rows of everyone installed in the 30 days up to one date."""
    return calendar_range(events, [snapshot_date], **options)
