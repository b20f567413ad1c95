"""SQL of the flat view, the anchors and every feature, written the plain way.

Each feature is one aggregate over events joined with anchors: no day rows, no
gaps, no shared measures.  Only the vocabularies and windows come from the
configuration.
"""

from __future__ import annotations

from stayline import config as c

FLAT = """
flat AS (
  SELECT user_pseudo_id, event_id, event_date, ts AS event_timestamp, install_date,
    CASE WHEN event_type='error' AND k >= 95 THEN 'app_remove'
         WHEN event_type='error' AND k < 20 THEN 'app_exception'
         WHEN event_type='error' AND k < 35 THEN 'app_exit'
         WHEN event_type='error' AND k < 50 THEN 'app_clear_data'
         WHEN event_type='error' AND k < 60 THEN 'app_update'
         WHEN event_type='error' THEN 'user_engagement'
         WHEN event_type='signup' THEN 'session_start'
         WHEN event_type='view' THEN 'screen_view'
         WHEN event_type='click' THEN 'click_btn_ev'
         WHEN k < 30 THEN 'load_ad_ev' WHEN k < 55 THEN 'show_ad_ev'
         WHEN k < 80 THEN 'paid_ad_impression' WHEN k < 90 THEN 'af_attribution_received'
         ELSE 'iap_ev' END AS event_name,
    concat(user_pseudo_id, '-', cast(event_date AS varchar), '-', cast(k % 3 AS varchar))
      AS unique_session_id,
    CASE WHEN event_type <> 'view' THEN NULL WHEN k % 9 = 0 THEN ''
         WHEN k % 9 = 1 THEN 'VideoPlayer' WHEN k % 9 = 2 THEN 'AudioPlayerSong'
         WHEN k % 9 = 3 THEN 'AudioPlayerLyrics' WHEN k % 9 = 4 THEN 'MainAudioHome'
         WHEN k % 9 = 5 THEN 'AudioSearchAll' WHEN k % 9 = 6 THEN 'AudioPlaylistsDetail'
         WHEN k % 9 = 7 THEN 'MainAudio_RequestNotificationPermission'
         ELSE 'ScanMusic' END AS mapped_screen,
    CASE WHEN event_type <> 'click' THEN NULL WHEN k % 7 = 0 THEN ''
         WHEN k % 7 = 1 THEN 'Play' WHEN k % 7 = 2 THEN 'Pause' WHEN k % 7 = 3 THEN 'Next'
         WHEN k % 7 = 4 THEN 'Search' WHEN k % 7 = 5 THEN 'QuickSearchClicked'
         ELSE 'Back' END AS click_button_name,
    CASE WHEN event_type IN ('view','error') THEN cast(floor(value * 100) AS bigint) END
      AS engagement_time,
    CASE WHEN event_type = 'purchase' THEN value END AS ep_revenue,
    CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN ''
         ELSE concat('src', cast(user_id % 3 AS varchar)) END AS up_af_media_source,
    CASE WHEN k % 4 = 0 THEN NULL ELSE concat('cmp', cast(k % 4 AS varchar)) END
      AS up_af_campaign,
    concat('c', cast(user_id % 5 AS varchar)) AS country,
    CASE WHEN k % 6 = 0 THEN '' ELSE concat('l', cast(k % 3 AS varchar)) END AS up_language,
    concat('1.', cast(k % 4 AS varchar)) AS app_version, 'ANDROID' AS platform,
    CASE WHEN k % 10 = 0 THEN 'granted' WHEN k % 10 = 1 THEN 'denied' END
      AS up_allow_notification,
    CASE WHEN event_date >= install_date THEN age END AS days_since_install,
    CASE WHEN event_date >= install_date THEN age * 24 END AS hours_since_install,
    CASE WHEN event_date >= install_date THEN age * 1440 END AS minutes_since_install,
    CASE WHEN event_date >= install_date THEN age * 86400 END AS seconds_since_install
  FROM (SELECT t.*, cast(date_diff('day', install_date, event_date) AS integer) AS age
        FROM (SELECT e.*, cast(ts AS date) AS event_date,
                cast(user_id AS varchar) AS user_pseudo_id,
                cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k,
                date '2024-01-01' + cast(user_id % 14 AS int) AS install_date
              FROM events e) t) u
)"""


def with_flat(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([FLAT.strip(), *ctes]) + "\n" + body


# --- anchored events -------------------------------------------------------


def cohort(first: str, last: str) -> str:
    return f"""
cohort AS (
  SELECT user_pseudo_id, min(install_date) AS install_date FROM flat
  WHERE event_date BETWEEN date '{first}' - 1 AND date '{last}' + 1
    AND abs(date_diff('day', install_date, event_date)) <= 1
  GROUP BY user_pseudo_id
  HAVING min(install_date) BETWEEN date '{first}' AND date '{last}'
)"""


def milestone_events(first: str, last: str, milestones=c.MILESTONES) -> list[str]:
    days = ", ".join(f"({m})" for m in milestones)
    return [
        cohort(first, last),
        f"""
anchored AS (
  SELECT f.* EXCLUDE (install_date), h.install_date AS idate, m.milestone_day,
    h.install_date + m.milestone_day AS snapshot_date,
    date_diff('day', f.event_date, h.install_date + m.milestone_day) AS d
  FROM flat f JOIN cohort h ON f.user_pseudo_id = h.user_pseudo_id,
    (VALUES {days}) m(milestone_day)
  WHERE f.event_date >= h.install_date - {c.FEATURE_WINDOW}
    AND f.event_date < date '{last}' + m.milestone_day + {c.LABEL_HORIZON}
)""",
    ]


def calendar_events(dates) -> list[str]:
    days = ", ".join(f"(date '{x}')" for x in dates)
    return [
        f"""
anchored AS (
  SELECT f.* EXCLUDE (install_date), f.install_date AS idate, 0 AS milestone_day,
    s.snapshot_date, date_diff('day', f.event_date, s.snapshot_date) AS d
  FROM flat f JOIN (VALUES {days}) s(snapshot_date)
    ON f.event_date >= s.snapshot_date - {c.FEATURE_WINDOW}
   AND f.event_date < s.snapshot_date + {c.LABEL_HORIZON}
)"""
    ]


# --- features --------------------------------------------------------------


def n(cond: str, days: int = 7) -> str:
    return f"count(*) FILTER (WHERE {cond} AND d BETWEEN 1 AND {days})"


def distinct(x: str, cond: str, days: int, first: int = 1) -> str:
    return f"count(DISTINCT {x}) FILTER (WHERE {cond} AND d BETWEEN {first} AND {days})"


def total(x: str, days: int, first: int = 1) -> str:
    return f"cast(coalesce(sum({x}) FILTER (WHERE d BETWEEN {first} AND {days}), 0) AS bigint)"


def ever(cond: str) -> str:
    return f"cast(count(*) FILTER (WHERE {cond} AND d >= 1) > 0 AS integer)"


def newest(x: str, usable: str) -> str:
    return f"coalesce(arg_max({x}, event_timestamp) FILTER (WHERE {usable} AND d >= 1), '')"


def oldest(x: str) -> str:
    return f"coalesce(arg_min({x}, event_timestamp) FILTER (WHERE {x} <> '' AND d >= 1), '')"


def biggest(x: str) -> str:
    return f"coalesce(max({x}) FILTER (WHERE d >= 1), 0)"


def hours_since(cond: str) -> str:
    return f"coalesce(min(d) FILTER (WHERE {cond} AND d >= 1) * 24, 9999)"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN cast({a} AS double) / cast({b} AS double) ELSE 0.0::double END"


def trend(a: str, b: str) -> str:
    return (
        f"CASE WHEN {b} > 0 THEN cast({a} AS double) / cast({b} AS double)"
        f" WHEN {a} > 0 THEN 2.0::double ELSE 1.0::double END"
    )


def is_in(x: str, values) -> str:
    return f"{x} IN ({c.sql_list(values)})"


def feature_sql() -> dict[str, dict[str, str]]:
    """Feature expressions by section."""
    start = "event_name = 'session_start'"
    views = "event_name IN ('screen_view', 'screen_view_ev')"
    some_screen = "mapped_screen <> ''"
    permission = "mapped_screen LIKE '%Permission%'"
    search = "click_button_name IN ('Search', 'QuickSearchClicked')"
    removal = "event_name = 'app_remove'"

    def screen(*names):
        return is_in("mapped_screen", names)

    def sessions(days, first=1):
        return distinct("unique_session_id", start, days, first)

    def flag_and(*conds):
        return "least(" + ", ".join(ever(x) for x in conds) + ")"

    home, searching, lyrics = "MainAudioHome", "AudioSearchAll", "AudioPlayerLyrics"
    playlists = ("AudioPlaylistsDetail", "MainAudioTabPlaylists")
    out = {
        "a": {
            "media_source": newest("up_af_media_source", "up_af_media_source <> ''"),
            "campaign": newest("up_af_campaign", "up_af_campaign <> ''"),
            "has_attribution": ever("event_name = 'af_attribution_received'"),
        },
        "b": {
            "country": newest("country", "country <> ''"),
            "language": newest("up_language", "up_language <> ''"),
        },
        "c": {
            "app_version": newest("app_version", "app_version IS NOT NULL"),
            "platform": newest("platform", "platform IS NOT NULL"),
        },
        "d": {
            **{f"{u}_since_install": biggest(f"{u}_since_install")
               for u in ("days", "hours", "minutes", "seconds")},
            "is_day0_user": f"cast({biggest('days_since_install')} = 0 AS integer)",
            "is_day1_user": f"cast({biggest('days_since_install')} = 1 AS integer)",
            "is_week1_user": f"cast({biggest('days_since_install')} <= 7 AS integer)",
        },
        "e": {
            **{f"session_cnt_{w}d": sessions(w) for w in (1, 3, 7, 14, 30)},
            "active_days_7d": distinct("event_date", "true", 7),
            "active_days_30d": distinct("event_date", "true", 30),
            "avg_sessions_per_day_7d": ratio(sessions(7), distinct("event_date", "true", 7)),
            "session_trend_7d": trend(sessions(7), sessions(14, 8)),
        },
        "f": {
            **{f"engagement_time_ms_{w}d": total("engagement_time", w) for w in (1, 3, 7, 30)},
            "avg_engagement_per_session_7d": ratio(total("engagement_time", 7), sessions(7)),
            "engagement_trend_7d": trend(
                total("engagement_time", 7), total("engagement_time", 14, 8)),
        },
        "g": {
            "hours_since_last_session": hours_since("true"),
            "hours_since_last_screen": hours_since(views),
            "hours_since_last_click": hours_since("event_name = 'click_btn_ev'"),
            "hours_since_last_ad": hours_since(
                "event_name IN ('show_ad_ev', 'load_ad_ev', 'paid_ad_impression')"),
            "hours_since_last_search": hours_since(search),
            "hours_since_last_engagement": hours_since("event_name = 'user_engagement'"),
        },
        "h": {
            **{f"screen_{s}_cnt_7d": n(screen(s)) for s in c.SCREENS},
            "unique_screen_cnt_7d": distinct("mapped_screen", some_screen, 7),
            "home_ratio_7d": ratio(n(screen(home)), n(some_screen)),
            "video_ratio_7d": ratio(
                n(screen("VideoPlayer", "MainVideoTabLocal", "FloatingVideo", "VideoSelection")),
                n(some_screen)),
            "lyrics_ratio_7d": ratio(n(screen(lyrics)), n(some_screen)),
            "permission_screen_ratio_7d": ratio(n(permission), n(some_screen)),
        },
        "i": {
            **{f"btn_{b}_cnt_7d": n(f"click_button_name = '{b}'") for b in c.BUTTONS},
            "unique_button_cnt_7d": distinct("click_button_name", "click_button_name <> ''", 7),
        },
        "j": {
            "search_online_cnt_7d": n("click_button_name = 'Search'"),
            "search_quick_cnt_7d": n("click_button_name = 'QuickSearchClicked'"),
            "search_screen_cnt_7d": n(screen(searching)),
            "used_search_7d": f"cast({n(search)} > 0 AS integer)",
            "search_days_7d": distinct("event_date", search, 7),
        },
        "k": {
            "lyrics_screen_cnt_7d": n(screen(lyrics)),
            "audio_player_cnt_7d": n(screen("AudioPlayerSong")),
            "playlist_cnt_7d": n(screen(*playlists)),
            "queue_cnt_7d": n(screen("AudioPlayerQueue")),
            "audio_screen_ratio_7d": ratio(
                n(screen("AudioPlayerSong", lyrics, "AudioPlayerQueue")), n(views)),
        },
        "l": {
            "video_player_cnt_7d": n(screen("VideoPlayer")),
            "video_tab_cnt_7d": n(screen("MainVideoTabLocal")),
            "floating_video_cnt_7d": n(screen("FloatingVideo")),
        },
        "m": {
            "seen_notification_permission": ever(
                screen("MainAudio_RequestNotificationPermission")),
            "seen_any_permission": ever(permission),
            "permission_screen_cnt_7d": n(permission),
            "notif_permission_status": newest(
                "up_allow_notification", "up_allow_notification IS NOT NULL"),
        },
        "n": {
            "load_ad_cnt_7d": n("event_name = 'load_ad_ev'"),
            "show_ad_cnt_7d": n("event_name = 'show_ad_ev'"),
            "paid_ad_impression_cnt_7d": n("event_name = 'paid_ad_impression'"),
            "ads_per_session_7d": ratio(n("event_name = 'show_ad_ev'"), sessions(7)),
            "ad_revenue_7d": "cast(coalesce(sum(cast(ep_revenue AS decimal(20, 6)))"
                             " FILTER (WHERE d BETWEEN 1 AND 7), 0) AS double)",
        },
        "o": {
            "iap_cnt_30d": n("event_name = 'iap_ev'", 30),
            "payer_flag": ever("event_name = 'iap_ev'"),
        },
        "p": {
            "app_exception_cnt_7d": n("event_name = 'app_exception'"),
            "app_clear_data_cnt_30d": n("event_name = 'app_clear_data'", 30),
            "app_update_cnt_30d": n("event_name = 'app_update'", 30),
            "app_exit_cnt_7d": n("event_name = 'app_exit'"),
        },
        "q": {
            "first_screen": oldest("mapped_screen"),
            "last_screen": newest("mapped_screen", some_screen),
            "first_button": oldest("click_button_name"),
            "last_button": newest("click_button_name", "click_button_name <> ''"),
            "home_to_search_flag": flag_and(screen(home), screen(searching)),
            "search_to_lyrics_flag": flag_and(screen(searching), screen(lyrics)),
            "search_to_video_flag": flag_and(screen(searching), screen("VideoPlayer")),
            "lyrics_to_exit_flag": flag_and(screen(lyrics), "event_name = 'app_exit'"),
            "permission_to_exit_flag": flag_and(permission, "event_name = 'app_exit'"),
        },
        "r": {
            "visited_home": ever(screen(home)),
            "visited_player": ever(screen("AudioPlayerSong", lyrics, "VideoPlayer")),
            "visited_lyrics": ever(screen(lyrics)),
            "visited_search": ever(screen(searching)),
            "visited_video": ever(screen("VideoPlayer", "MainVideoTabLocal")),
            "visited_playlist": ever(screen(*playlists)),
            "visited_scan_music": ever(screen("ScanMusic")),
            "funnel_depth": " + ".join(
                ever(x) for x in (screen(home), screen("AudioPlayerSong", "VideoPlayer"),
                                  screen(lyrics), screen(searching), screen(*playlists))),
        },
        "t": {f"{x}_uninstall_rate": "-1.0::double"
              for x in ("country", "campaign", "media_source", "app_version")},
        "label": {
            c.LABEL: f"cast(count(*) FILTER (WHERE {removal} AND d BETWEEN -6 AND 0) > 0"
                     " AS integer)",
        },
    }
    return out


KEYS = "snapshot_date, user_pseudo_id, min(idate) AS install_date, milestone_day"


def _columns(names) -> str:
    every = {k: v for part in feature_sql().values() for k, v in part.items()}
    names = list(every) if names is None else names
    return ",\n  ".join(f"{every[x]} AS {x}" for x in names)


def milestone_select(names=None, exclude_churned: bool = True) -> str:
    having = (
        "HAVING count(*) FILTER (WHERE event_name = 'app_remove' AND d >= 1) = 0"
        if exclude_churned else ""
    )
    return (
        f"SELECT {KEYS}, {_columns(names)}\nFROM anchored\n"
        f"GROUP BY snapshot_date, user_pseudo_id, milestone_day, idate {having}"
    )


def calendar_select(names=None) -> str:
    return (
        f"SELECT {KEYS}, {_columns(names)}\nFROM anchored\n"
        "GROUP BY snapshot_date, user_pseudo_id, milestone_day\n"
        f"HAVING min(idate) BETWEEN snapshot_date - {c.MAX_INSTALL_AGE_DAYS} AND snapshot_date"
    )
