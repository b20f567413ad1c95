"""Vocabularies, windows, defaults and model inputs.

Everything that names a concrete event, screen or button lives here; the
operators only see these lists.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Windows (days)
# ---------------------------------------------------------------------------
LABEL_HORIZON = 7
FEATURE_WINDOW = 30
MAX_INSTALL_AGE_DAYS = 30
MILESTONES = (1, 7, 14, 21, 28)
NEVER_HOURS = 9999

# ---------------------------------------------------------------------------
# Screens and buttons that get a count column each
# ---------------------------------------------------------------------------
SCREENS = (
    "VideoPlayer", "AudioPlayerSong", "AudioPlayerLyrics", "MainAudioSongs",
    "AudioPlayerQueue", "PhotoDetail", "AudioSelection", "FloatingPlayer",
    "MainVideoTabLocal", "MainAudioHome", "Equalizer", "AudioSearchAll",
    "AudioPlaylistsDetail", "LockScreen", "VideoSelection", "FloatingVideo",
    "MainMore", "ScanMusic", "MainAudioTabPlaylists", "MainAudioFolder",
    "MainAudio_RequestNotificationPermission", "ConfigTheme",
    "AudioFolderDetail", "VideoFolderDetail", "MainAudioAlbum", "AudioEditTag",
)

BUTTONS = (
    "Play", "Pause", "Next", "Previous", "Seek", "Forward10s", "Backward10s",
    "Back", "Close", "Search", "QuickSearchClicked", "Favourite", "Delete",
    "Ok", "Cancel", "Confirm", "TabVideo", "TabSong", "TabLyric", "TabAudio",
    "TabPhoto", "Playlist", "Save", "Home", "MainMore", "PlayAsAudio",
    "Rotate", "ItemMore", "More", "RepeatOne", "RepeatAll", "RepeatOff",
)

# Screens and buttons with a role of their own
HOME_SCREEN = "MainAudioHome"
SONG_SCREEN = "AudioPlayerSong"
LYRICS_SCREEN = "AudioPlayerLyrics"
QUEUE_SCREEN = "AudioPlayerQueue"
SEARCH_SCREEN = "AudioSearchAll"
VIDEO_SCREEN = "VideoPlayer"
VIDEO_TAB_SCREEN = "MainVideoTabLocal"
FLOATING_VIDEO_SCREEN = "FloatingVideo"
SCAN_SCREEN = "ScanMusic"
NOTIFICATION_SCREEN = "MainAudio_RequestNotificationPermission"
VIDEO_SCREENS = ("VideoPlayer", "MainVideoTabLocal", "FloatingVideo", "VideoSelection")
AUDIO_SCREENS = ("AudioPlayerSong", "AudioPlayerLyrics", "AudioPlayerQueue")
PLAYLIST_SCREENS = ("AudioPlaylistsDetail", "MainAudioTabPlaylists")
PERMISSION_PATTERN = "%Permission%"
SEARCH_BUTTONS = ("Search", "QuickSearchClicked")

# Event names
SESSION_EVENT = "session_start"
SCREEN_EVENTS = ("screen_view", "screen_view_ev")
CLICK_EVENT = "click_btn_ev"
ENGAGEMENT_EVENT = "user_engagement"
LOAD_AD_EVENT = "load_ad_ev"
SHOW_AD_EVENT = "show_ad_ev"
PAID_AD_EVENT = "paid_ad_impression"
AD_EVENTS = (SHOW_AD_EVENT, LOAD_AD_EVENT, PAID_AD_EVENT)
PURCHASE_EVENT = "iap_ev"
EXCEPTION_EVENT = "app_exception"
CLEAR_DATA_EVENT = "app_clear_data"
UPDATE_EVENT = "app_update"
EXIT_EVENT = "app_exit"
REMOVE_EVENT = "app_remove"
ATTRIBUTION_EVENT = "af_attribution_received"

# ---------------------------------------------------------------------------
# Flat event table
# ---------------------------------------------------------------------------
FLAT_SCHEMA = """
    user_pseudo_id string, event_date date, event_timestamp long,
    event_name string, install_date timestamp,
    days_since_install int, hours_since_install int,
    minutes_since_install int, seconds_since_install int,
    unique_session_id string, engagement_time long,
    mapped_screen string, click_button_name string,
    up_af_media_source string, up_af_campaign string,
    country string, up_language string, app_version string, platform string,
    up_allow_notification string, ep_revenue double
"""

# ---------------------------------------------------------------------------
# Model inputs and store columns
# ---------------------------------------------------------------------------
RISK_DIMENSIONS = ("country", "campaign", "media_source", "app_version")
LABEL = "label_uninstall_7d"
STORE_KEY = ("snapshot_date", "user_pseudo_id", "milestone_day")

CATEGORICAL_FEATURES = (
    "media_source", "campaign", "country", "language", "app_version",
    "first_screen", "last_screen", "first_button", "last_button",
    "notif_permission_status",
)

SECTIONS = "abcdefghijklmnopqrt"

# Stored, but not given to the models.
STORED_ONLY = ("has_attribution", "platform")

# Training, scoring
TRAIN_RATIO = 0.8
MISSING_CATEGORY = "__NA__"
MIN_RISK_SAMPLE = 100
UNKNOWN_RATE = -1.0
SEED = 42
SELECTION_METRIC = "auc_pr"
MODEL_NAMES = ("gbt_a", "gbt_b", "gbt_c")
SEGMENT_LIMITS = ((0.7, "very_high"), (0.5, "high"), (0.3, "medium"))
LOWEST_SEGMENT = "low"

# Right-closed bins of the segment report, (lower, upper, name)
SEGMENT_BINS = {
    "days_since_install": (
        (0, 1, "D0"), (1, 3, "D1-3"), (3, 7, "D4-7"), (7, 30, "D8-30"),
        (30, 9999, "D30+"),
    ),
    "session_cnt_7d": ((0, 1, "0"), (1, 3, "1-3"), (3, 7, "4-7"), (7, 99999, "8+")),
    "funnel_depth": (
        (-1, 0, "0"), (0, 1, "1"), (1, 2, "2"), (2, 3, "3"), (3, 5, "4-5"),
    ),
}


def column_name(value: str) -> str:
    """Vocabulary value as part of a column name."""
    return value.replace("-", "_").replace(" ", "_")


def sql_list(values) -> str:
    """Values as the inside of a SQL ``IN (...)``."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)
