"""The flat event table: reading, staging and the adapter for test data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline import config as c


def read_flat_events(spark: SparkSession, path: str) -> DataFrame:
    """Read a flat event table, parquet partitioned by ``event_date``.

    The schema is given, so no file is opened for inference and a filter on
    ``event_date`` prunes whole partitions.
    """
    return spark.read.schema(c.FLAT_SCHEMA).parquet(path)


def stage_flat_events(events: DataFrame, path: str) -> None:
    """Write events partitioned by day.

    ``rebalance`` lets adaptive execution split a heavy day over several
    tasks and merge light ones, so the file size stays even.
    """
    (
        events.hint("rebalance", "event_date")
        .write.mode("overwrite")
        .partitionBy("event_date")
        .parquet(path)
    )


def between_days(events: DataFrame, first, last) -> DataFrame:
    """Rows with ``first <= event_date <= last``; the bounds are literals."""
    return events.where(
        (F.col("event_date") >= as_date(first)) & (F.col("event_date") <= as_date(last))
    )


def as_date(value) -> Column:
    """A date literal from a ``date`` or an ISO string."""
    return F.lit(str(value)).cast("date")


# Adapter: the test table `events` seen through the flat schema.  Fixed values:
# which (event_type, k) plays which role is a definition shared with the SQL
# checks.
_ADAPTED_COLUMNS = (
    "user_pseudo_id",
    "event_id",
    "event_date",
    "ts AS event_timestamp",
    "install_date",
    """CASE WHEN event_type = 'error' THEN
           CASE WHEN k >= 95 THEN 'app_remove' WHEN k < 20 THEN 'app_exception'
                WHEN k < 35 THEN 'app_exit' WHEN k < 50 THEN 'app_clear_data'
                WHEN k < 60 THEN 'app_update' ELSE 'user_engagement' END
         WHEN event_type = 'signup' THEN 'session_start'
         WHEN event_type = 'view' THEN 'screen_view'
         WHEN event_type = 'click' THEN 'click_btn_ev'
         WHEN k < 30 THEN 'load_ad_ev' WHEN k < 55 THEN 'show_ad_ev'
         WHEN k < 80 THEN 'paid_ad_impression' WHEN k < 90 THEN 'af_attribution_received'
         ELSE 'iap_ev' END AS event_name""",
    "concat_ws('-', user_pseudo_id, event_date, k % 3) AS unique_session_id",
    """CASE WHEN event_type = 'view' THEN
           element_at(array('', 'VideoPlayer', 'AudioPlayerSong', 'AudioPlayerLyrics',
                            'MainAudioHome', 'AudioSearchAll', 'AudioPlaylistsDetail',
                            'MainAudio_RequestNotificationPermission', 'ScanMusic'),
                      k % 9 + 1) END AS mapped_screen""",
    """CASE WHEN event_type = 'click' THEN
           element_at(array('', 'Play', 'Pause', 'Next', 'Search',
                            'QuickSearchClicked', 'Back'), k % 7 + 1) END AS click_button_name""",
    """CASE WHEN event_type IN ('view', 'error') THEN cast(floor(value * 100) AS bigint) END
      AS engagement_time""",
    "CASE WHEN event_type = 'purchase' THEN value END AS ep_revenue",
    """CASE WHEN k % 5 = 1 THEN '' WHEN k % 5 > 1 THEN concat('src', user_id % 3) END
      AS up_af_media_source""",
    "CASE WHEN k % 4 > 0 THEN concat('cmp', k % 4) END AS up_af_campaign",
    "concat('c', user_id % 5) AS country",
    "CASE WHEN k % 6 = 0 THEN '' ELSE concat('l', k % 3) END AS up_language",
    "concat('1.', k % 4) AS app_version",
    "'ANDROID' AS platform",
    "CASE k % 10 WHEN 0 THEN 'granted' WHEN 1 THEN 'denied' END AS up_allow_notification",
    "CASE WHEN age >= 0 THEN age END AS days_since_install",
    "CASE WHEN age >= 0 THEN age * 24 END AS hours_since_install",
    "CASE WHEN age >= 0 THEN age * 1440 END AS minutes_since_install",
    "CASE WHEN age >= 0 THEN age * 86400 END AS seconds_since_install",
)


def adapt_test_events(raw: DataFrame) -> DataFrame:
    """Give the driver's ``events`` table the flat event schema."""
    keyed = raw.selectExpr(
        "*",
        "cast(ts AS date) AS event_date",
        "cast(user_id AS string) AS user_pseudo_id",
        "cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k",
        "date_add(date'2024-01-01', cast(user_id % 14 AS int)) AS install_date",
    ).withColumn("age", F.expr("datediff(event_date, install_date)"))
    return keyed.selectExpr(*_ADAPTED_COLUMNS)


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat event table of one test scale."""
    return adapt_test_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
