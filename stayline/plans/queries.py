"""Every operator as a query over the test tables.

Each query takes a session and a test-scale folder.  Cohorts and snapshots are
wide enough to cover all users of the event table.
"""

from __future__ import annotations

import hashlib
from datetime import timedelta

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline import config as c
from stayline.functions import measures as m
from stayline.operators import (
    anchors, boosting, dataset, encoding, metrics, models, reports, scoring, sliding,
)
from stayline.operators import features as f
from stayline.operators.features import Measure, OfFacets
from stayline.operators.rollup import DAY, USER, Facet, Rollup
from stayline.plans import jobs
from stayline.sources import store as tables
from stayline.sources.events import as_date, between_days, flat_events
from stayline.sources.shared import new_folder, saved, scratch, shared_folder

# Parameters shared with the SQL checks
INSTALL_FROM, INSTALL_TO = "2024-01-01", "2024-01-14"
SNAPSHOT = "2024-01-15"
SNAPSHOTS = ("2024-01-08", "2024-01-15", "2024-01-22")
RUN_DATE = "2024-01-20"
COHORT = ("2024-01-03", "2024-01-10")
CUTOFF, EARLY_CUTOFF, MIN_N = "2024-01-22", "2024-01-12", 10
AS_OF = "2024-01-26"
DATA_START, REMOVALS = "2024-01-08", ("2024-01-10", "2024-01-30")
LATE_DAY = "2024-01-14"
REPLACED_SLICE, EMPTIED_SLICE = (7, "2024-01-12"), (1, "2024-01-09")
KEYS = ("snapshot_date", USER, "install_date", "milestone_day")

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- the test workspace ----------------------------------------------------

_built: set[tuple[str, str]] = set()


def workspace(spark: SparkSession, sf_dir: str) -> jobs.Workspace:
    """Feature store of one test scale, built once per application."""
    app = spark.sparkContext.applicationId
    name = hashlib.sha1(f"{app} {sf_dir}".encode()).hexdigest()[:12]
    ws = jobs.Workspace(f"{shared_folder(spark)}/{name}")
    if (app, sf_dir) not in _built:
        scans = (anchors.milestone_scan(anchors.milestone_slices(INSTALL_FROM, INSTALL_TO)),
                 anchors.calendar_scan(SNAPSHOTS[0], SNAPSHOTS[-1]))
        with scratch(spark):
            days = jobs.reduced_days(
                flat_events(spark, sf_dir), min(first for first, _ in scans), max(last for _, last in scans))
            jobs.build_milestones(spark, ws, days, INSTALL_FROM, INSTALL_TO)
            jobs.build_snapshots(spark, ws, days, SNAPSHOTS)
        _built.add((app, sf_dir))
    return ws


def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workspace(spark, sf_dir).store(spark)


def training_rows(spark, sf_dir) -> DataFrame:
    return dataset.training_set(feature_store(spark, sf_dir), AS_OF)


# Three scores with many ties, computed from features alike in both engines.
INACTIVITY = ("cast(least(hours_since_last_session, 720) AS double)"
              " / cast(720 + 24 * active_days_7d AS double)")
SCORES = {
    "gbt_a": INACTIVITY,
    "gbt_b": "cast(1 AS double) / cast(1 + session_cnt_7d AS double)",
    "gbt_c": "cast(5 - funnel_depth AS double) / cast(5 AS double)",
}


def scored_rows(spark, sf_dir) -> DataFrame:
    """Training rows, once per model, with its score."""
    pairs = ", ".join(f"'{k}', {x}" for k, x in SCORES.items())
    return training_rows(spark, sf_dir).select(
        *KEYS, F.col(c.LABEL).alias("label"), *c.SEGMENT_BINS,
        F.expr(f"stack({len(SCORES)}, {pairs}) AS (model, score)"),
    )


def predicted(spark, sf_dir) -> DataFrame:
    """Predictions of the calendar snapshots, shaped like the prediction table."""
    rows = feature_store(spark, sf_dir).where("milestone_day = 0")
    return rows.select(
        F.col("snapshot_date").alias("prediction_date"), USER,
        *[F.expr(x).alias(f"uninstall_prob_{k}") for k, x in SCORES.items()],
        F.expr(INACTIVITY).alias("uninstall_prob"),
    ).withColumn("risk_segment", scoring.risk_segment("uninstall_prob"))


# --- sources and sinks -----------------------------------------------------


QUERIES["flat_events"] = flat_events


@query
def event_scan_window(spark, sf_dir):
    scan = anchors.calendar_scan(SNAPSHOT, SNAPSHOT)
    return between_days(flat_events(spark, sf_dir), *scan).select(
        USER, "event_id", DAY, "event_name"
    )


def _two_versions(store: DataFrame) -> DataFrame:
    """The store with a second version of the rows of older users."""
    first = store.withColumn(c.LABEL, F.lit(0)).withColumn("version", F.lit(1))
    second = store.where("days_since_install >= 7").withColumn("version", F.lit(2))
    return first.unionByName(second).drop("created_at")


@query
def store_scan_latest(spark, sf_dir):
    versions = _two_versions(feature_store(spark, sf_dir))
    return tables.latest_version(versions, c.STORE_KEY, "version").select(
        *KEYS, "version", c.LABEL, "session_cnt_7d", "last_screen"
    )


@query
def store_project(spark, sf_dir):
    return feature_store(spark, sf_dir).select(*KEYS, *f.MODEL_INPUTS, c.LABEL)


@query
def write_features(spark, sf_dir):
    return feature_store(spark, sf_dir).select(*KEYS, "session_cnt_7d", "country", c.LABEL)


@query
def write_risk_baseline(spark, sf_dir):
    path = new_folder(spark)
    baseline = encoding.risk_baseline(feature_store(spark, sf_dir), CUTOFF, MIN_N)
    tables.write_risk_baseline(baseline, path)
    return spark.read.parquet(path)


@query
def write_predictions(spark, sf_dir):
    path = new_folder(spark)
    tables.write_predictions(predicted(spark, sf_dir), path)
    return spark.read.parquet(path).drop("created_at")


@query
def write_metrics(spark, sf_dir):
    path = new_folder(spark)
    compared = metrics.model_selection(metrics.model_metrics(scored_rows(spark, sf_dir)))
    tables.write_metrics(compared.withColumn("run_id", F.lit("r1")), path)
    return spark.read.parquet(path).select("model", "auc_roc", "auc_pr", "rank")


@query
def table_schema(spark, sf_dir):
    """Slices written before two columns existed, read with the ones written after."""
    path, added = new_folder(spark), ["minutes_since_install", "seconds_since_install"]
    store = feature_store(spark, sf_dir)
    tables.write_slices(store.where("milestone_day > 0").drop(*added), path)
    tables.write_slices(store.where("milestone_day = 0"), path)
    return tables.read_store(spark, path, f.FEATURES).select(*KEYS, *added)


# --- anchors and cohorts ---------------------------------------------------


@query
def user_install_date(spark, sf_dir):
    return anchors.user_install_date(flat_events(spark, sf_dir))


@query
def install_cohort(spark, sf_dir):
    return anchors.install_cohort(flat_events(spark, sf_dir), *COHORT)


@query
def milestone_anchor(spark, sf_dir):
    return anchors.milestone_anchors(
        anchors.install_cohort(flat_events(spark, sf_dir), INSTALL_FROM, INSTALL_TO)
    )


@query
def calendar_cohort(spark, sf_dir):
    return anchors.calendar_cohort(flat_events(spark, sf_dir), SNAPSHOT)


@query
def exclude_already_churned(spark, sf_dir):
    spec = Rollup(counts={"n_removals": f"event_name = '{c.REMOVE_EVENT}'"})
    rows = _at(spark, sf_dir, spec, {"churned": Measure(m.ever("n_removals"))})
    return rows.where("churned = 0").drop("churned")


@query
def snapshot_dates(spark, sf_dir):
    """Weekly anchors over the days that have events."""
    span = flat_events(spark, sf_dir).agg(F.min(DAY).alias("lo"), F.max(DAY).alias("hi")).first()
    dates = anchors.snapshot_dates(span.lo, span.hi, 7) if span.lo else []
    return spark.createDataFrame([(d,) for d in dates], "snapshot_date date")


@query
def label_complete_cohort(spark, sf_dir):
    slices = anchors.label_complete_slices(RUN_DATE)
    days = [d for d, _ in slices]
    cohort = anchors.install_cohort(flat_events(spark, sf_dir), min(days), max(days))
    # One row per milestone.
    table = spark.createDataFrame(slices, "install_date date, milestone_day int")
    return cohort.join(F.broadcast(table), "install_date")


@query
def rolling_cohort(spark, sf_dir):
    span = anchors.rolling_install_range(RUN_DATE)
    return anchors.milestone_anchors(anchors.install_cohort(flat_events(spark, sf_dir), *span))


@query
def default_cohort(spark, sf_dir):
    day = anchors.default_install_day("2024-01-09")
    return anchors.milestone_anchors(
        anchors.install_cohort(flat_events(spark, sf_dir), day, day)
    )


# --- feature aggregates ----------------------------------------------------


def _at(spark, sf_dir, spec, aggregates) -> DataFrame:
    return f.at_milestones(
        flat_events(spark, sf_dir), spec, aggregates,
        anchors.milestone_slices(INSTALL_FROM, INSTALL_TO),
    ).select(*KEYS, *aggregates)


_SESSIONS = {
    "session": Facet(f"CASE WHEN event_name = '{c.SESSION_EVENT}' THEN unique_session_id END")
}
_SCREENS = Facet("nullif(mapped_screen, '')", ends=True)
_BUTTONS = Facet("nullif(click_button_name, '')", ends=True)


@query
def latest_value(spark, sf_dir):
    spec = Rollup(
        attributes={"media_source": "up_af_media_source", "language": "up_language",
                    "notification": "up_allow_notification"},
        facets={"screen": _SCREENS}, allow_empty=("notification",),
    )
    return _at(spark, sf_dir, spec, {
        "media_source": Measure(m.latest_before("media_source")),
        "language": Measure(m.latest_before("language")),
        "notif_permission_status": Measure(m.latest_before("notification")),
        "last_screen": OfFacets(m.latest_before("screen"), ""),
    })


@query
def first_value(spark, sf_dir):
    spec = Rollup(facets={"screen": _SCREENS, "button": _BUTTONS})
    return _at(spark, sf_dir, spec, {
        "first_screen": OfFacets(m.first_before("screen"), ""),
        "first_button": OfFacets(m.first_before("button"), ""),
    })


@query
def count_where_window(spark, sf_dir):
    spec = Rollup(counts={
        "n_iap": f"event_name = '{c.PURCHASE_EVENT}'",
        "n_show": f"event_name = '{c.SHOW_AD_EVENT}'",
    })
    return _at(spark, sf_dir, spec, {
        "iap_cnt_30d": Measure(m.count_in_days("n_iap", 30)),
        "show_ad_cnt_7d": Measure(m.count_in_days("n_show", 7)),
    })


@query
def distinct_where_window(spark, sf_dir):
    return _at(spark, sf_dir, Rollup(facets=_SESSIONS), {
        **{f"session_cnt_{n}d": OfFacets(m.distinct_in_days("session", n))
           for n in (1, 3, 7, 14, 30)},
        "session_cnt_prev": OfFacets(m.distinct_in_days("session", 14, first_day=8)),
    })


@query
def distinct_days(spark, sf_dir):
    spec = Rollup(counts={
        "n_events": "true", "n_search": f"click_button_name IN ({c.sql_list(c.SEARCH_BUTTONS)})",
    })
    return _at(spark, sf_dir, spec, {
        "active_days_7d": Measure(m.days_with("n_events", 7)),
        "active_days_30d": Measure(m.days_with("n_events", 30)),
        "search_days_7d": Measure(m.days_with("n_search", 7)),
    })


@query
def sum_where_window(spark, sf_dir):
    spec = Rollup(sums={"engagement": "engagement_time",
                        "revenue": "cast(ep_revenue AS decimal(20, 6))"})
    return _at(spark, sf_dir, spec, {
        "engagement_time_ms_7d": Measure(m.count_in_days("engagement", 7)),
        "engagement_time_ms_30d": Measure(m.count_in_days("engagement", 30)),
        "ad_revenue_7d": Measure(f"cast({m.sum_in_days('revenue', 7)} AS double)"),
    })


@query
def max_before(spark, sf_dir):
    spec = Rollup(maxima={"days": "days_since_install", "hours": "hours_since_install"})
    return _at(spark, sf_dir, spec, {
        "days_since_install": Measure(m.max_before("days")),
        "hours_since_install": Measure(m.max_before("hours")),
    })


@query
def recency_hours(spark, sf_dir):
    spec = Rollup(counts={
        "n_events": "true", "n_clicks": f"event_name = '{c.CLICK_EVENT}'",
        "n_ads": f"event_name IN ({c.sql_list(c.AD_EVENTS)})",
    })
    return _at(spark, sf_dir, spec, {
        "hours_since_last_session": Measure(m.recency_hours("n_events")),
        "hours_since_last_click": Measure(m.recency_hours("n_clicks")),
        "hours_since_last_ad": Measure(m.recency_hours("n_ads")),
    })


_FLAG_ROLLUP = Rollup(counts={
    "n_home": f"mapped_screen = '{c.HOME_SCREEN}'",
    "n_search": f"mapped_screen = '{c.SEARCH_SCREEN}'",
    "n_lyrics": f"mapped_screen = '{c.LYRICS_SCREEN}'",
    "n_main": f"mapped_screen IN ('{c.SONG_SCREEN}', '{c.VIDEO_SCREEN}')",
    "n_playlist": f"mapped_screen IN ({c.sql_list(c.PLAYLIST_SCREENS)})",
    "n_exit": f"event_name = '{c.EXIT_EVENT}'",
    "n_iap": f"event_name = '{c.PURCHASE_EVENT}'",
})


@query
def ever_flag(spark, sf_dir):
    return _at(spark, sf_dir, _FLAG_ROLLUP, {
        "payer_flag": Measure(m.ever("n_iap")), "visited_home": Measure(m.ever("n_home")),
    })


@query
def both_flag(spark, sf_dir):
    rows = _at(spark, sf_dir, _FLAG_ROLLUP, {
        n: Measure(m.ever(n)) for n in ("n_home", "n_search", "n_lyrics", "n_exit")
    })
    return rows.select(
        *KEYS, F.expr(m.both("n_home", "n_search")).alias("home_to_search_flag"),
        F.expr(m.both("n_lyrics", "n_exit")).alias("lyrics_to_exit_flag"),
    )


@query
def funnel_depth(spark, sf_dir):
    steps = ("n_home", "n_main", "n_lyrics", "n_search", "n_playlist")
    rows = _at(spark, sf_dir, _FLAG_ROLLUP, {n: Measure(m.ever(n)) for n in steps})
    return rows.select(*KEYS, F.expr(m.funnel_depth(*steps)).alias("funnel_depth"))


_RATIO_ROLLUP = Rollup(
    counts={"n_events": "true", "n_show": f"event_name = '{c.SHOW_AD_EVENT}'"},
    sums={"engagement": "engagement_time"}, facets=_SESSIONS,
)


@query
def safe_ratio(spark, sf_dir):
    rows = _at(spark, sf_dir, _RATIO_ROLLUP, {
        "ads": Measure(m.count_in_days("n_show", 7)),
        "days": Measure(m.days_with("n_events", 7)),
        "sessions": OfFacets(m.distinct_in_days("session", 7)),
    })
    return rows.select(
        *KEYS, F.expr(m.safe_ratio("ads", "sessions")).alias("ads_per_session_7d"),
        F.expr(m.safe_ratio("sessions", "days")).alias("avg_sessions_per_day_7d"),
    )


@query
def trend_ratio(spark, sf_dir):
    rows = _at(spark, sf_dir, _RATIO_ROLLUP, {
        "e": Measure(m.count_in_days("engagement", 7)),
        "e0": Measure(m.count_in_days("engagement", 14, first_day=8)),
        "s": OfFacets(m.distinct_in_days("session", 7)),
        "s0": OfFacets(m.distinct_in_days("session", 14, first_day=8)),
    })
    return rows.select(
        *KEYS, F.expr(m.trend_ratio("s", "s0")).alias("session_trend_7d"),
        F.expr(m.trend_ratio("e", "e0")).alias("engagement_trend_7d"),
    )


@query
def vocab_counts(spark, sf_dir):
    counted = [x for x in f.FEATURES
               if x.startswith(("screen_", "btn_")) and x.endswith("_cnt_7d")]
    return f.milestone_features(
        flat_events(spark, sf_dir), INSTALL_FROM, INSTALL_TO, columns=counted,
        exclude_churned=False,
    )


@query
def label_within(spark, sf_dir):
    spec = Rollup(counts={"n_removals": f"event_name = '{c.REMOVE_EVENT}'"})
    return _at(spark, sf_dir, spec, {c.LABEL: Measure(m.within_horizon("n_removals"))})


@query
def unique_values(spark, sf_dir):
    spec = Rollup(facets={"screen": _SCREENS, "button": _BUTTONS})
    return _at(spark, sf_dir, spec, {
        "unique_screen_cnt_7d": OfFacets(m.distinct_in_days("screen", 7)),
        "unique_button_cnt_7d": OfFacets(m.distinct_in_days("button", 7)),
    })


@query
def milestone_features(spark, sf_dir):
    return f.milestone_features(flat_events(spark, sf_dir), INSTALL_FROM, INSTALL_TO)


@query
def calendar_features(spark, sf_dir):
    return f.calendar_features(flat_events(spark, sf_dir), SNAPSHOT)


@query
def calendar_range(spark, sf_dir):
    return f.calendar_range(flat_events(spark, sf_dir), SNAPSHOTS)


@query
def milestone_features_from_days(spark, sf_dir):
    """The same features from stored day tables."""
    ws = jobs.Workspace(new_folder(spark))
    events = flat_events(spark, sf_dir)
    jobs.refresh_days(events, ws, "2024-01-01", "2024-01-15")
    jobs.refresh_days(events, ws, "2024-01-15", "2024-02-29")
    return f.milestone_features(jobs.day_tables(spark, ws), INSTALL_FROM, INSTALL_TO)


def _section(mode, name):
    def run(spark, sf_dir):
        events, columns = flat_events(spark, sf_dir), list(f.SECTIONS[name])
        if mode == "milestone":
            return f.milestone_features(events, INSTALL_FROM, INSTALL_TO, columns=columns)
        return f.calendar_range(events, SNAPSHOTS, columns=columns)
    return run


for _mode in ("milestone", "calendar"):
    for _name in c.SECTIONS:
        QUERIES[f"features_{_mode}_{_name}"] = _section(_mode, _name)


# --- store maintenance -----------------------------------------------------


@query
def slice_exists(spark, sf_dir):
    """The check per slice, and whether a build would skip it, for present and absent slices."""
    ws, store = workspace(spark, sf_dir), feature_store(spark, sf_dir)
    days = [*anchors.snapshot_dates("2024-01-05", "2024-01-08"), *anchors.snapshot_dates("2024-02-11", "2024-02-12")]
    wanted = [(m, day) for m in (0, 7, 28) for day in days]
    done = jobs.finished_slices(spark, ws, days)
    rows = [(m, day, tables.slice_exists(store, milestone_day=m, snapshot_date=day), (m, day) in done)
            for m, day in wanted]
    return spark.createDataFrame(rows, "milestone_day int, snapshot_date date, found boolean, finished boolean")


@query
def stale_slices(spark, sf_dir):
    """Slices that are due again after one late event, by the checksums they were built from."""
    ws = jobs.Workspace(new_folder(spark))
    events = flat_events(spark, sf_dir)
    slices = [(m, day + timedelta(days=m)) for day, m in anchors.milestone_slices(*COHORT)] + [
        (0, anchors._day(x)) for x in SNAPSHOTS]
    tables.write_inputs(tables.slice_inputs(events, spark, slices), ws.path("inputs"))
    late = events.where(F.col(DAY) == as_date(LATE_DAY)).orderBy("event_id").limit(1).withColumn("event_name", F.lit("late"))
    changed = jobs.changed_slices(spark, ws, events.unionByName(late), slices)
    return spark.createDataFrame(sorted(changed), "milestone_day int, snapshot_date date")


@query
def sliding_features(spark, sf_dir):
    """Calendar features from a state that was moved on by three days."""
    ws = jobs.Workspace(new_folder(spark))
    last = anchors._day(SNAPSHOT) + timedelta(days=c.LABEL_HORIZON - 1)
    jobs.refresh_days(flat_events(spark, sf_dir), ws, last - timedelta(days=sliding.SPAN + 3), last)
    for back in (3, 2, 1, 0):
        state = jobs.advance_state(spark, ws, last - timedelta(days=back))
    return f.calendar_features(state.tables(), state.snapshot())


@query
def slice_rows(spark, sf_dir):
    return tables.slice_rows(feature_store(spark, sf_dir))


@query
def latest_version(spark, sf_dir):
    versions = _two_versions(feature_store(spark, sf_dir))
    newest = tables.latest_version(versions, c.STORE_KEY, "version")
    return newest.groupBy("milestone_day", "version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(c.LABEL).cast("long")).alias("positive")
    )


@query
def replace_slice(spark, sf_dir):
    """All slices written, then one of them replaced by fewer rows and one by none."""
    path, (milestone, day) = new_folder(spark), REPLACED_SLICE
    store = feature_store(spark, sf_dir)
    tables.write_slices(store, path)
    one = store.where(
        (F.col("milestone_day") == milestone) & (F.col("snapshot_date") == as_date(day))
    )
    tables.write_slices(one.where("session_cnt_30d > 0").withColumn(c.LABEL, F.lit(1)), path)
    # another one is replaced by no rows
    milestone, day = EMPTIED_SLICE
    gone = store.where(
        (F.col("milestone_day") == milestone) & (F.col("snapshot_date") == as_date(day))
    )
    tables.write_slices(gone.where("session_cnt_30d < 0"), path, replacing=[EMPTIED_SLICE])
    return tables.read_store(spark, path, f.FEATURES).select(*KEYS, c.LABEL, "session_cnt_30d")


@query
def build_report(spark, sf_dir):
    return tables.build_report(feature_store(spark, sf_dir))


@query
def store_update_from(spark, sf_dir):
    store = feature_store(spark, sf_dir)
    baseline = saved(encoding.risk_baseline(store, CUTOFF, MIN_N))
    return encoding.update_from(store, baseline, SNAPSHOT).select(
        *KEYS, *[f"{d}_uninstall_rate" for d in c.RISK_DIMENSIONS]
    )


# --- target encoding -------------------------------------------------------


@query
def risk_baseline(spark, sf_dir):
    return encoding.risk_baseline(feature_store(spark, sf_dir), CUTOFF, MIN_N)


@query
def risk_baseline_closed(spark, sf_dir):
    """What the job writes: rates of milestone rows whose label window had ended."""
    return encoding.risk_baseline(
        feature_store(spark, sf_dir), CUTOFF, MIN_N, label_closed=True, kind="milestone"
    )


@query
def apply_risk(spark, sf_dir):
    store = feature_store(spark, sf_dir)
    baseline = saved(encoding.risk_baseline(store, CUTOFF, MIN_N))
    rated = encoding.apply_risk(store, baseline)
    return rated.select(*KEYS, *c.RISK_DIMENSIONS,
                        *[f"{d}_uninstall_rate" for d in c.RISK_DIMENSIONS])


@query
def known_risk(spark, sf_dir):
    """Rates of every row as they were known on its snapshot day."""
    store = feature_store(spark, sf_dir)
    versions = encoding.rate_versions(store, MIN_N)
    return encoding.apply_known_risk(store, versions).select(*KEYS, *c.RISK_DIMENSIONS, *(f"{d}_uninstall_rate" for d in c.RISK_DIMENSIONS))


@query
def merge_baseline(spark, sf_dir):
    store = feature_store(spark, sf_dir)
    old = encoding.risk_baseline(store, CUTOFF, MIN_N).withColumn("updated_at", F.lit(1))
    # Fewer values reach the larger minimum, so some old rates stay.
    new = encoding.risk_baseline(store, EARLY_CUTOFF, 3 * MIN_N).withColumn(
        "updated_at", F.lit(2)
    )
    return encoding.merge_baseline(old, new)


# --- training data ---------------------------------------------------------


@query
def training_set(spark, sf_dir):
    return training_rows(spark, sf_dir).select(*KEYS, "session_cnt_7d", "last_button", c.LABEL)


@query
def dataset_summary(spark, sf_dir):
    return dataset.dataset_summary(training_rows(spark, sf_dir))


@query
def last_snapshot_per_user(spark, sf_dir):
    return dataset.last_snapshot_per_user(training_rows(spark, sf_dir)).select(
        *KEYS, "days_since_install", c.LABEL
    )


@query
def time_split(spark, sf_dir):
    train, valid = dataset.time_split(training_rows(spark, sf_dir))
    parts = train.withColumn("part", F.lit("train")).unionByName(
        valid.withColumn("part", F.lit("valid"))
    )
    return parts.select(*KEYS, "part", c.LABEL)


@query
def fit_ordinal(spark, sf_dir):
    train, _ = dataset.time_split(training_rows(spark, sf_dir))
    return encoding.fit_ordinal(train)


@query
def apply_ordinal(spark, sf_dir):
    train, valid = dataset.time_split(training_rows(spark, sf_dir))
    encoded = encoding.apply_ordinal(valid, saved(encoding.fit_ordinal(train)))
    return encoded.select(*KEYS, *c.CATEGORICAL_FEATURES)


@query
def history_dictionary(spark, sf_dir):
    history = feature_store(spark, sf_dir).where(F.col("snapshot_date") < as_date(SNAPSHOT))
    return encoding.fit_ordinal(history)


@query
def stable_dictionary(spark, sf_dir):
    """Codes of the train rows, with the new values of the held-out rows behind them."""
    train, valid = dataset.time_split(training_rows(spark, sf_dir))
    return encoding.extend_ordinal(saved(encoding.fit_ordinal(train)), valid, 1)


@query
def assemble(spark, sf_dir):
    inputs = f.MODEL_INPUTS
    rows = training_rows(spark, sf_dir)
    encoded = encoding.apply_ordinal(rows, saved(encoding.fit_ordinal(rows)))
    vectors = encoding.assemble(encoded, inputs).select(
        *KEYS, vector_to_array("features").alias("x")
    )
    return vectors.select(
        *KEYS, F.size("x").alias("n_inputs"),
        F.expr("x[0]").alias("first_input"), F.expr("element_at(x, -1)").alias("last_input"),
    )


# --- models and scores -----------------------------------------------------

_trained: dict = {}


def _encoded_split(spark, sf_dir):
    """Encoded train and validation rows and the dictionary, written once."""
    ws = workspace(spark, sf_dir)
    names = ("encoded/train", "encoded/valid", "dictionary")
    if not ws.complete(spark, "encoded/valid"):
        train, valid = dataset.time_split(training_rows(spark, sf_dir))
        encoding.fit_ordinal(train).write.mode("overwrite").parquet(ws.path("dictionary"))
        dictionary = spark.read.parquet(ws.path("dictionary"))
        for name, rows in zip(names, (train, valid)):
            encoding.apply_ordinal(rows, dictionary).write.mode("overwrite").parquet(
                ws.path(name)
            )
    return [spark.read.parquet(ws.path(name)) for name in names]


def _model(spark, sf_dir, name):
    """A model of the library's parameters on the train part, its held-out rows and inputs."""
    train, valid, dictionary = _encoded_split(spark, sf_dir)
    sizes = models.dictionary_sizes(dictionary)
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _trained:
        fitted = models.train(models.MODELS[name], train, valid, f.MODEL_INPUTS, sizes)
        _trained[key] = scoring.Trained(fitted, dictionary, f.MODEL_INPUTS)
    return _trained[key], valid, sizes


def _held_out(name):
    """The held-out rows with scores that are probabilities, and whether the model learned anything.

    A model learned if the loss of its train rows is below that of their label rate.
    """
    def run(spark, sf_dir):
        trained, valid, sizes = _model(spark, sf_dir, name)
        nominal = models.MODELS[name].nominal
        train = _encoded_split(spark, sf_dir)[0]
        fitted = models.probability(trained.model, train, f.MODEL_INPUTS, sizes, nominal, "score")
        y = F.col(c.LABEL)
        loss = fitted.agg(
            F.avg(-F.log(F.when(y == 1, F.col("score")).otherwise(1 - F.col("score")))).alias("loss"), F.avg(y).alias("rate"))
        learns = loss.select((F.expr("-rate * ln(rate) - (1 - rate) * ln(1 - rate)") - F.col("loss") > 1e-3)).first()[0]
        return models.probability(trained.model, valid, f.MODEL_INPUTS, sizes, nominal, "score").select(
            *KEYS, c.LABEL, F.col("score").between(0, 1).alias("is_probability"), F.lit(learns).alias("learns"))
    return run


for _name in c.MODEL_NAMES:
    QUERIES[f"train_{_name}"] = _held_out(_name)


@query
def feature_importance(spark, sf_dir):
    trained, valid, sizes = _model(spark, sf_dir, "gbt_a")
    ranked = models.top(
        models.feature_importance(trained.model, valid, f.MODEL_INPUTS, sizes), len(f.MODEL_INPUTS)
    )
    return _importance_facts(spark, trained.model, ranked)


@query
def write_importance(spark, sf_dir):
    path = new_folder(spark)
    trained, valid, sizes = _model(spark, sf_dir, "gbt_b")
    tables.write_importance(
        models.feature_importance(trained.model, valid, f.MODEL_INPUTS, sizes), path
    )
    written = spark.read.csv(path, header=True, schema="feature string, importance double")
    return _importance_facts(spark, trained.model, written)


def _known_model(dictionary) -> scoring.Trained:
    """Three stumps that SQL can follow."""
    inputs = ["session_cnt_7d", "days_since_install", "country"]
    stump = lambda k, left, right, rows: boosting.Tree(
        np.array([k, -1, -1]), np.array([0, 0, 0]), np.array([1, -1, -1]), np.array([2, -1, -1]),
        np.array([0.0, left, right]), np.array([1.0, 0, 0]), np.array([sum(rows), *rows]))
    trees = [stump(0, 0.5, -0.4, (30, 70)), stump(1, -0.2, 0.3, (60, 40)), stump(2, 0.25, -0.125, (50, 50))]
    fitted = boosting.Trees(inputs, [np.array([2.0]), np.array([7.0]), np.array([3.0])], -1.0, trees)
    return scoring.Trained(models.Model(fitted), dictionary, inputs)


def _known_snapshot(spark, sf_dir) -> DataFrame:
    return feature_store(spark, sf_dir).where(
        (F.col("milestone_day") == 0) & (F.col("snapshot_date") == as_date(SNAPSHOTS[-1])))


@query
def score_known(spark, sf_dir):
    """Scores of one snapshot by a model whose trees are given."""
    trained = {"gbt_a": _known_model(_encoded_split(spark, sf_dir)[2])}
    scored = scoring.score(_known_snapshot(spark, sf_dir), trained, "gbt_a")
    return scored.select(
        "prediction_date", USER, F.round("uninstall_prob_gbt_a", 9).alias("uninstall_prob"), "uninstall_prob_gbt_b", "risk_segment")


@query
def contributions_known(spark, sf_dir):
    """Additive contributions to the margin of a model whose trees are given, and what they are added to."""
    trained = _known_model(_encoded_split(spark, sf_dir)[2])
    encoded = encoding.apply_ordinal(_known_snapshot(spark, sf_dir), trained.dictionary)
    found = boosting.with_contributions(trained.model.trees, encoded, KEYS)
    return found.select(*KEYS, F.round("base", 9).alias("base"), *(
        F.round(F.col("contributions")[k], 9).alias(f"by_{x}") for k, x in enumerate(trained.inputs)))


@query
def importance_known(spark, sf_dir):
    """Mean absolute contributions, most important input first."""
    trained = _known_model(_encoded_split(spark, sf_dir)[2])
    encoded = encoding.apply_ordinal(_known_snapshot(spark, sf_dir), trained.dictionary)
    found = models.top(models.feature_importance(trained.model, encoded, trained.inputs, {}))
    return found.select("feature", F.round("importance", 9).alias("importance"))


def _importance_facts(spark, model, importance) -> DataFrame:
    """The number of values that a model tells apart, and whether its importance fits that."""
    trees = model.trees
    known = spark.createDataFrame(list(zip(trees.inputs, trees.values)), "feature string, distinct_values int")
    fits = (F.col("importance") >= 0) & ((F.col("distinct_values") > 1) | F.col("distinct_values").isNull() | (F.col("importance") == 0))
    return importance.join(known, "feature").select("feature", "distinct_values", fits.alias("is_importance"))


@query
def split_gains(spark, sf_dir):
    """The best first split of every input by itself, with both penalties."""
    train = _encoded_split(spark, sf_dir)[0]
    params = boosting.Params(l1=0.1, l2=0.1, minInstancesPerNode=5)
    found = boosting.root_gains(train, f.MODEL_INPUTS, c.LABEL, models.row_key(), params)
    return found.where("distinct_values IS NOT NULL").withColumn("rows_below", F.col("rows_below").cast("long"))


@query
def ordered_statistics(spark, sf_dir):
    """Categories of train rows as label rates of the rows before in a random order."""
    train = _encoded_split(spark, sf_dir)[0]
    found = encoding.ordered_statistics(train, c.CATEGORICAL_FEATURES, c.SEED)
    return found.select(*KEYS, *(F.round(x, 9).alias(x) for x in c.CATEGORICAL_FEATURES))


@query
def category_statistics(spark, sf_dir):
    """Held-out rows with categories as label rates of all train rows."""
    train, valid, _ = _encoded_split(spark, sf_dir)
    statistics = saved(encoding.category_statistics(train, c.CATEGORICAL_FEATURES))
    found = encoding.with_statistics(valid, statistics, c.CATEGORICAL_FEATURES)
    return found.select(*KEYS, *(F.round(x, 9).alias(x) for x in c.CATEGORICAL_FEATURES))


@query
def model_rounds(spark, sf_dir):
    """Rounds of every model: it stopped in time, and its best round is the one of the recorded metric."""
    rows = []
    for name in c.MODEL_NAMES:
        trained, valid, sizes = _model(spark, sf_dir, name)
        spec, trees = models.MODELS[name], trained.model.trees
        found = models.rounds(spark, {name: trained.model}).first()
        scored = models.probability(trained.model, valid, f.MODEL_INPUTS, sizes, spec.nominal, "score")
        got = metrics.ranking_metrics(scored, (), "score", c.LABEL).first()
        waited = found.rounds_run - found.best_round
        rows.append((name, valid.count(), 0 <= waited < spec.params["patience"] + boosting.EVERY,
                     len(trees.trees) == found.best_round, abs(got.auc_pr - found.auc_pr) < 1e-3))
    return spark.createDataFrame(
        rows, "model string, n_valid long, stopped_in_time boolean, is_cut boolean, is_recorded boolean")


@query
def choose_model(spark, sf_dir):
    compared = metrics.model_selection(metrics.model_metrics(scored_rows(spark, sf_dir)))
    chosen = scoring.choose_model(compared.withColumn("run_id", F.lit("r1")), c.MODEL_NAMES)
    return compared.where(F.col("model") == chosen).select("model", "auc_pr")


@query
def score(spark, sf_dir):
    """Scores of one snapshot by all models, reduced to what holds for any models."""
    trained = {name: _model(spark, sf_dir, name)[0] for name in c.MODEL_NAMES}
    snapshot = feature_store(spark, sf_dir).where(
        (F.col("milestone_day") == 0) & (F.col("snapshot_date") == as_date(SNAPSHOTS[-1]))
    )
    scored = scoring.score(snapshot, trained, "gbt_a")
    probabilities = [F.col(f"uninstall_prob_{m}").between(0, 1) for m in c.MODEL_NAMES]
    return scored.select(
        "prediction_date", USER,
        F.least(*[p.cast("int") for p in probabilities]).cast("boolean").alias("are_probabilities"),
        (F.col("uninstall_prob") == F.col("uninstall_prob_gbt_a")).alias("is_primary"),
        F.expr("""risk_segment = CASE WHEN uninstall_prob < 0.3 THEN 'low'
            WHEN uninstall_prob < 0.5 THEN 'medium' WHEN uninstall_prob < 0.7 THEN 'high'
            ELSE 'very_high' END""").alias("is_segment"),
    )


@query
def risk_segment(spark, sf_dir):
    return predicted(spark, sf_dir).select(
        "prediction_date", USER, "uninstall_prob", "risk_segment"
    )


@query
def segment_distribution(spark, sf_dir):
    return scoring.segment_distribution(predicted(spark, sf_dir))


@query
def mean_probability(spark, sf_dir):
    means = scoring.mean_probability(predicted(spark, sf_dir))
    return means.select(*[F.round(x, 6).alias(x) for x in means.columns])


# --- metrics ---------------------------------------------------------------


@query
def confusion_metrics(spark, sf_dir):
    return metrics.confusion_metrics(scored_rows(spark, sf_dir), ("model",))


@query
def roc_auc(spark, sf_dir):
    return metrics.ranking_metrics(scored_rows(spark, sf_dir), ("model",)).select(
        "model", "auc_roc"
    )


@query
def average_precision(spark, sf_dir):
    return metrics.ranking_metrics(scored_rows(spark, sf_dir), ("model",)).select(
        "model", "auc_pr"
    )


@query
def model_selection(spark, sf_dir):
    return metrics.model_selection(metrics.model_metrics(scored_rows(spark, sf_dir)))


@query
def segment_analysis(spark, sf_dir):
    rows = scored_rows(spark, sf_dir).where(F.col("model") == "gbt_a")
    return metrics.segment_analysis(rows)


# --- diagnostics -----------------------------------------------------------


@query
def event_name_search(spark, sf_dir):
    return reports.event_name_search(flat_events(spark, sf_dir))


@query
def removal_totals(spark, sf_dir):
    return reports.removal_totals(flat_events(spark, sf_dir))


@query
def rate_by_age_bucket(spark, sf_dir):
    return reports.rate_by_age_bucket(feature_store(spark, sf_dir), AS_OF)


@query
def removal_offset_histogram(spark, sf_dir):
    return reports.removal_offset_histogram(flat_events(spark, sf_dir), SNAPSHOT)


@query
def lifetime_churn(spark, sf_dir):
    return reports.lifetime_churn(flat_events(spark, sf_dir))


@query
def rate_per_snapshot(spark, sf_dir):
    return reports.rate_per_snapshot(feature_store(spark, sf_dir))


@query
def age_distribution_pct(spark, sf_dir):
    return reports.age_distribution_pct(feature_store(spark, sf_dir), AS_OF)


@query
def install_date_distribution(spark, sf_dir):
    return reports.install_date_distribution(flat_events(spark, sf_dir), "2023-12-31")


@query
def snapshot_age_split(spark, sf_dir):
    return reports.snapshot_age_split(feature_store(spark, sf_dir), AS_OF)


@query
def weekly_removals(spark, sf_dir):
    return reports.weekly_removals(flat_events(spark, sf_dir), "2024-01-01")


@query
def manual_label_rate(spark, sf_dir):
    return reports.manual_label_rate(flat_events(spark, sf_dir), SNAPSHOT)


@query
def old_user_age_at_start(spark, sf_dir):
    return reports.old_user_age_at_start(flat_events(spark, sf_dir), DATA_START, *REMOVALS)


@query
def old_user_recent_activity(spark, sf_dir):
    return reports.old_user_recent_activity(flat_events(spark, sf_dir), DATA_START, *REMOVALS)
