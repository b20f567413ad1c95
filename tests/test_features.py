"""Windows, defaults, leakage and cohorts on hand-made events."""

import random
from datetime import date, timedelta

import pytest
from rows import INSTALL, row
from pyspark.sql import functions as F

from stayline import config as c
from stayline.functions import measures as m
from stayline.operators import anchors
from stayline.operators import features as f
from stayline.operators.features import Measure, OfFacets
from stayline.operators.rollup import Facet, Rollup, day_tables
from stayline.plans import jobs
from stayline.sources.store import default_value, store_schema

ANCHOR = 14  # milestone used below
AT = INSTALL + timedelta(days=ANCHOR)


def build(events, **options):
    rows = f.milestone_features(events, INSTALL, INSTALL, [ANCHOR], **options).collect()
    return {r.user_pseudo_id: r for r in rows}


def at(d, **values):
    """An event ``d`` days before the anchor."""
    return row(AT - timedelta(days=d), **values)


def test_inputs_and_columns():
    assert len(f.MODEL_INPUTS) == len(set(f.MODEL_INPUTS)) == 146
    assert len(f.FEATURES) == 148
    assert len(c.SCREENS) == 26 and len(c.BUTTONS) == 32
    assert "".join(f.SECTIONS) == c.SECTIONS


def test_schema_matches_the_declared_one(frame):
    built = f.milestone_features(frame([row(0)]), INSTALL, INSTALL)
    declared = store_schema(f.FEATURES)
    assert [(x.name, x.dataType) for x in built.schema] == [
        (x.name, x.dataType) for x in declared if x.name != "created_at"
    ]


def test_window_edges(frame):
    days = [-7, -6, 0, 1, 3, 4, 7, 8, 14, 15, 30, 31]
    events = [row(0)] + [
        at(d, event_name="session_start", unique_session_id=f"s{d}", engagement_time=2 ** i)
        for i, d in enumerate(days)
    ]
    got = build(frame(events))["u"]
    assert [got[f"session_cnt_{n}d"] for n in (1, 3, 7, 14, 30)] == [1, 2, 4, 6, 8]
    assert got.session_trend_7d == 4 / 2  # days 8 and 14 are the week before
    assert got.engagement_time_ms_7d == 2 ** 3 + 2 ** 4 + 2 ** 5 + 2 ** 6
    assert got.active_days_7d == 4 and got.active_days_30d == 8
    assert got.hours_since_last_session == 24


@pytest.mark.parametrize("offset, expected", [(-7, 0), (-6, 1), (0, 1)])
def test_label_edges(frame, offset, expected):
    events = [row(0), at(offset, event_name="app_remove")]
    assert build(frame(events))["u"][c.LABEL] == expected


def test_removal_before_the_anchor_excludes_the_user(frame):
    events = frame([row(0), at(1, event_name="app_remove")])
    assert build(events) == {}
    assert build(events, exclude_churned=False)["u"][c.LABEL] == 0
    assert len(f.calendar_features(events, AT).collect()) == 1


def test_defaults_without_a_past(frame):
    late = INSTALL + timedelta(days=1)
    events = frame([row(late, event_name="app_remove", country="x", mapped_screen="VideoPlayer")])
    got = f.milestone_features(events, INSTALL, INSTALL, [1]).collect()[0].asDict()
    assert got[c.LABEL] == 1
    for name in f.FEATURES:
        # An age of 0 days is also "day 0" and "first week".
        assert got[name] == (1 if name in ("is_day0_user", "is_week1_user")
                             else default_value(name)), name


def test_latest_and_first_skip_null_and_empty(frame):
    stamp = row(5)["event_timestamp"]
    events = frame([
        row(0),
        row(5, country="old", app_version="1", mapped_screen="B", event_timestamp=stamp),
        row(5, country="new", app_version="2", mapped_screen="A", event_timestamp=stamp + 1),
        row(5, country="", app_version="", mapped_screen="", event_timestamp=stamp + 2),
        row(5, event_timestamp=stamp + 3),
        row(6, click_button_name="Play", event_timestamp=stamp + 10),
        row(6, click_button_name="Back", event_timestamp=stamp + 10),
    ])
    got = build(events)["u"]
    assert got.country == "new" and got.app_version == ""
    assert (got.first_screen, got.last_screen) == ("B", "A")
    # Equal timestamps: the smaller value is first, the greater one last.
    assert (got.first_button, got.last_button) == ("Back", "Play")


def test_funnel_counts_lyrics_apart_from_the_player(frame):
    got = build(frame([row(0), row(3, mapped_screen=c.LYRICS_SCREEN)]))["u"]
    assert (got.visited_player, got.visited_lyrics, got.funnel_depth) == (1, 1, 1)
    got = build(frame([row(0), row(3, mapped_screen=c.VIDEO_TAB_SCREEN)]))["u"]
    assert (got.visited_video, got.visited_player, got.funnel_depth) == (1, 0, 0)


def test_audio_ratio_is_over_screen_events(frame):
    events = frame([
        row(0),
        at(2, event_name="screen_view", mapped_screen=c.SONG_SCREEN),
        at(2, event_name="other", mapped_screen=c.LYRICS_SCREEN),
    ])
    got = build(events)["u"]
    assert got.audio_screen_ratio_7d == 2.0 and got.lyrics_ratio_7d == 0.5


def test_later_events_change_no_feature(frame):
    rng = random.Random(7)
    screens, buttons = [*c.SCREENS, "", None, "Else"], [*c.BUTTONS, "", None]
    names = ["session_start", "screen_view", "click_btn_ev", "show_ad_ev", "iap_ev", "app_exit"]

    def events(days):
        return [
            at(d, event_name=rng.choice(names), mapped_screen=rng.choice(screens),
               click_button_name=rng.choice(buttons), unique_session_id=f"s{rng.randint(0, 20)}",
               engagement_time=rng.randint(0, 9), country=rng.choice(["a", "b", ""]),
               event_timestamp=rng.randint(1, 10 ** 6), days_since_install=ANCHOR - d)
            for d in days
        ]

    past = [row(0), *events([rng.randint(1, 14) for _ in range(60)])]
    future = events([rng.randint(-6, 0) for _ in range(40)])
    for mode in ("milestone", "calendar"):
        run = build if mode == "milestone" else (
            lambda e: {r.user_pseudo_id: r for r in f.calendar_features(e, AT).collect()})
        before, after = run(frame(past))["u"].asDict(), run(frame(past + future))["u"].asDict()
        assert before == after


def test_label_of_an_open_window_is_null(frame):
    events = frame([row(0), row(5)])
    assert build(events, as_of=AT + timedelta(days=6))["u"][c.LABEL] is None
    assert build(events, as_of=AT + timedelta(days=7))["u"][c.LABEL] == 0
    assert build(events, as_of=AT - timedelta(days=1)) == {}


def test_batch_width_does_not_change_a_row(frame):
    """Events long before the install are out, however wide the batch is."""
    events = frame([
        row(-40, event_name="iap_ev"), row(0), row(0, user_pseudo_id="v"),
        row(-25, user_pseudo_id="v", install_date=INSTALL - timedelta(days=25)),
    ])
    narrow = f.milestone_features(events, INSTALL, INSTALL, [1, 7]).collect()
    wide = f.milestone_features(events, INSTALL - timedelta(days=30), INSTALL, [1, 7])
    same_install = [r for r in wide.collect() if r.install_date == INSTALL]
    assert sorted(r for r in narrow if r.user_pseudo_id == "u") == sorted(
        r for r in same_install if r.user_pseudo_id == "u")
    flag = f.milestone_features(
        events, INSTALL - timedelta(days=30), INSTALL, [1], batch_bound=True
    ).where("user_pseudo_id = 'u'").collect()[0].payer_flag
    assert (flag, narrow[0].payer_flag) == (1, 0)


def test_install_cohort(frame):
    events = frame([
        row(0), row(0, user_pseudo_id="some", install_date=None),
        row(1, user_pseudo_id="some"), row(0, user_pseudo_id="none", install_date=None),
        row(5, user_pseudo_id="late"),  # seen, but not near the install day
    ])
    got = {r.user_pseudo_id: r.install_date
           for r in anchors.install_cohort(events, INSTALL, INSTALL + timedelta(days=9)).collect()}
    assert got == {"u": INSTALL, "some": INSTALL}
    for day, n in ((INSTALL, 4), (INSTALL + timedelta(days=31), 0)):
        assert anchors.calendar_cohort(events, day).count() == n - (n > 0)


def test_calendar_keeps_young_users_only(frame):
    old = INSTALL - timedelta(days=31)
    events = frame([row(0), row(0, user_pseudo_id="old", install_date=old),
                    row(2, user_pseudo_id="next", install_date=INSTALL + timedelta(days=2))])
    got = f.calendar_features(events, INSTALL).collect()
    assert [r.user_pseudo_id for r in got] == ["u"]
    assert f.calendar_features(events, INSTALL, require_past_event=True).count() == 0


def test_dates():
    assert anchors.snapshot_dates("2024-01-01", "2024-01-15", 7) == [
        date(2024, 1, 1), date(2024, 1, 8), date(2024, 1, 15)]
    assert anchors.label_complete_slices("2024-02-29", [1, 28]) == [
        (date(2024, 2, 21), 1), (date(2024, 1, 25), 28)]
    assert anchors.rolling_install_range("2024-01-29") == (date(2024, 1, 1), date(2024, 1, 29))
    assert anchors.default_install_day("2024-03-01") == date(2024, 2, 29)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_distinct_counts_by_gap_equal_plain_distinct(frame, spark, seed):
    """Values that come back on later days, against COUNT(DISTINCT)."""
    rng = random.Random(seed)
    events = [row(0, user_pseudo_id=u) for u in "abc"]
    for _ in range(400):
        events.append(row(
            rng.randint(-20, 40), user_pseudo_id=rng.choice("abc"), event_name="session_start",
            unique_session_id=f"s{rng.randint(0, 12)}"))
    events = frame(events)
    spec = Rollup(facets={"session": Facet(
        "CASE WHEN event_name = 'session_start' THEN unique_session_id END")})
    windows = [(1, 1), (3, 1), (7, 1), (14, 1), (30, 1), (14, 8), (30, 15)]
    got = f.at_milestones(
        events, spec,
        {f"w{hi}_{lo}": OfFacets(m.distinct_in_days("session", hi, lo)) for hi, lo in windows},
        anchors.milestone_slices(INSTALL, INSTALL),
    )
    near = events.where(F.col("event_date") >= F.date_sub("install_date", 30))
    plain = near.withColumn("milestone_day", F.explode(F.lit(list(c.MILESTONES)))).withColumn(
        "d", F.expr("datediff(install_date, event_date) + milestone_day")
    ).groupBy("user_pseudo_id", "milestone_day").agg(*[
        F.expr(f"count(DISTINCT CASE WHEN d BETWEEN {lo} AND {hi} AND event_name ="
               f" 'session_start' THEN unique_session_id END) AS w{hi}_{lo}")
        for hi, lo in windows])
    columns = ["user_pseudo_id", "milestone_day", *[f"w{hi}_{lo}" for hi, lo in windows]]
    assert sorted(got.select(columns).collect()) == sorted(plain.select(columns).collect())


def test_a_hot_user_is_reduced_before_it_meets_the_anchors(frame, spark):
    """One user owning nearly all events leaves a bounded number of day rows."""
    hot = spark.range(60_000).selectExpr(
        "'hot' AS user_pseudo_id", "date_add(date'2024-03-01', cast(id % 10 AS int)) AS event_date",
        "id AS event_timestamp", "'session_start' AS event_name",
        "date'2024-03-01' AS install_date", "concat('s', id) AS unique_session_id",
    )
    events = frame([row(0)]).unionByName(hot, allowMissingColumns=True)
    tables = day_tables(events, f.CHURN_ROLLUP)
    from stayline.operators.rollup import facet_rows
    assert tables.measures.where("user_pseudo_id = 'hot'").count() == 10
    assert facet_rows(tables.values, tables.spec).where("user_pseudo_id = 'hot'").count() == 10
    got = build(events)["hot"]
    assert got.session_cnt_7d == 6000 * 3 and got.session_cnt_14d == 60_000


def test_stored_day_tables_give_the_same_features(frame, spark, tmp_path):
    rng = random.Random(3)
    rows = [row(0, user_pseudo_id=u) for u in "ab"] + [
        row(rng.randint(0, 30), user_pseudo_id=rng.choice("ab"), event_name="session_start",
            unique_session_id=f"s{rng.randint(0, 9)}", mapped_screen=rng.choice(c.SCREENS),
            country=rng.choice("xy"), ep_revenue=rng.random(),
            event_timestamp=rng.randint(1, 10 ** 9))
        for _ in range(200)
    ]
    events, ws = frame(rows), jobs.Workspace(str(tmp_path))
    for day in range(0, 31, 10):
        jobs.refresh_days(events, ws, INSTALL + timedelta(days=day),
                          INSTALL + timedelta(days=day + 9))
    jobs.refresh_days(events, ws, INSTALL, INSTALL + timedelta(days=3))  # again
    stored = jobs.day_tables(spark, ws)
    direct = f.milestone_features(events, INSTALL, INSTALL)
    assert sorted(direct.collect()) == sorted(
        f.milestone_features(stored, INSTALL, INSTALL).collect())
    few = ["session_cnt_7d", "last_screen", "country"]
    assert sorted(f.milestone_features(stored, INSTALL, INSTALL, columns=few).collect()) == sorted(
        direct.select("snapshot_date", "user_pseudo_id", "install_date", "milestone_day",
                      *few).collect())
    assert sorted(f.calendar_range(events, [AT]).collect()) == sorted(
        f.calendar_range(stored, [AT]).collect())


def test_measure_needs_no_facet_scan(frame):
    events = frame([row(0), row(2, event_name="iap_ev")])
    spec = Rollup(counts={"n": "event_name = 'iap_ev'"})
    got = f.at_milestones(events, spec, {"flag": Measure(m.ever("n"))},
                         anchors.milestone_slices(INSTALL, INSTALL, [1, 7]))
    assert {r.milestone_day: r.flag for r in got.collect()} == {1: 0, 7: 1}


def test_single_slices_equal_the_whole_range(frame):
    """A scattered set of slices, with and without the early filter."""
    rng = random.Random(9)
    users = {f"u{i}": INSTALL + timedelta(days=i % 7) for i in range(20)}
    events = frame([row(day, user_pseudo_id=u, install_date=day) for u, day in users.items()] + [
        row(rng.randint(0, 40), user_pseudo_id=(u := rng.choice(list(users))),
            install_date=users[u], event_name=rng.choice(["session_start", "app_remove", "iap_ev"]),
            unique_session_id=f"s{rng.randint(0, 5)}", event_timestamp=rng.randint(1, 10 ** 9))
        for _ in range(150)])
    columns = ["session_cnt_7d", "payer_flag", "hours_since_last_session", c.LABEL]
    whole = f.milestone_features(events, INSTALL, INSTALL + timedelta(days=6), columns=columns)
    slices = [(INSTALL + timedelta(days=d), m) for d, m in ((0, 28), (3, 7), (3, 1), (6, 14))]
    expected = sorted(
        r for r in whole.collect() if (r.install_date, r.milestone_day) in set(slices))
    for narrow in (False, True):
        got = f.slice_features(events, slices, columns=columns, narrow=narrow).collect()
        assert sorted(got) == expected and expected


def test_day_rows_move_before_they_are_multiplied(spark):
    rows = spark.createDataFrame([("u", date(2024, 1, 1), 1)], "user_pseudo_id string, event_date date, x int")
    cohort = spark.createDataFrame([("u", date(2024, 1, 1), [1, 7])], "user_pseudo_id string, install_date date, milestones array<int>")
    anchored = anchors.milestone_rows(rows, F.broadcast(cohort)).groupBy("user_pseudo_id", "milestone_day").agg(F.sum("x").alias("x"))
    plan = anchored._jdf.queryExecution().sparkPlan().toString() + anchored._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Exchange" not in plan[plan.rindex("HashAggregate"):plan.rindex("Generate")]
    assert sorted((r.milestone_day, r.x) for r in anchored.collect()) == [(1, 1), (7, 1)]


def test_many_day_rows_go_to_more_tasks(spark):
    rows = spark.createDataFrame([(f"u{i}", date(2024, 1, 1), 1) for i in range(40)], "user_pseudo_id string, event_date date, x int")
    cohort = spark.createDataFrame([(f"u{i}", date(2024, 1, 1), [1]) for i in range(40)], "user_pseudo_id string, install_date date, milestones array<int>")
    for n, tasks in ((9 * anchors.TASK_ROWS, 9), (90 * anchors.TASK_ROWS, 90)):
        anchored = anchors.milestone_rows(rows, cohort, n=n).groupBy("user_pseudo_id", "milestone_day").count()
        assert anchored.rdd.getNumPartitions() == tasks and anchored.count() == 40
        assert anchors.calendar_rows(rows, ["2024-01-02", "2024-01-03"], n=n).rdd.getNumPartitions() == tasks
