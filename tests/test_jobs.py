"""The scheduled jobs on the test tables."""

from datetime import date

from pyspark.sql import functions as F

from stayline import config as c
from stayline.plans import jobs
from stayline.sources.events import flat_events

SF = "/root/testdata/sf0.01"
QUICK = {"maxIter": 2, "maxDepth": 2, "minInstancesPerNode": 2, "ratio": 0.6}


def test_weekly_then_daily(spark, tmp_path):
    ws = jobs.Workspace(str(tmp_path))
    jobs.refresh_days(flat_events(spark, SF), ws, "2024-01-01", "2024-01-30")
    days = jobs.day_tables(spark, ws)
    first = jobs.weekly(spark, ws, days, "2024-01-24", min_n=5, names=("gbt_a", "gbt_b"), **QUICK)
    assert first.count() == 150
    assert first.where("uninstall_prob_gbt_c <> -1").count() == 0
    assert first.where("uninstall_prob NOT BETWEEN 0 AND 1").count() == 0

    store = ws.store(spark)
    # No rows from the future, no label while its window is open.
    assert store.agg(F.max("snapshot_date")).collect()[0][0] == date(2024, 1, 24)
    still_open = store.where("snapshot_date > '2024-01-17' AND milestone_day > 0")
    assert still_open.where(f"{c.LABEL} IS NOT NULL").count() == 0
    rated = store.where("snapshot_date BETWEEN '2023-12-27' AND '2024-01-23'")
    assert rated.where("country_uninstall_rate = -1").count() > 0  # nothing before the cutoff

    chosen = ws.metrics(spark).where("is_best = 1").collect()
    assert len(chosen) == 1 and chosen[0].run_id == "2024-01-24"
    importance = spark.read.csv(ws.path("runs/2024-01-24/importance/gbt_a"), header=True)
    assert importance.count() == 146
    assert spark.read.parquet(ws.path("runs/2024-01-24/segments")).count() > 0
    facts = ws.metrics(spark).where("model = 'gbt_a'").first()
    assert '"maxDepth": 2' in facts.params and facts.n_inputs == 146
    assert facts.train_rows > 0 and facts.valid_rows > 0 and facts.train_seconds > 0
    summary = spark.read.parquet(ws.path("runs/2024-01-24/summary")).first()
    assert summary.n_rows == facts.train_rows + facts.valid_rows
    assert spark.read.parquet(ws.path("reports/builds")).count() > 0
    scores = spark.read.parquet(ws.path("reports/scores/2024-01-24/segments"))
    assert scores.where("risk_segment = 'all'").first().users == 150
    assert spark.read.parquet(ws.path("reports/scores/2024-01-24/means")).count() == 1

    second = jobs.daily(spark, ws, days, "2024-01-25")
    assert second.count() == 150
    predictions = ws.predictions(spark)
    assert predictions.groupBy("prediction_date").count().count() == 2
    # Scoring again replaces the day.
    again = jobs.score_day(spark, ws, days, "2024-01-25")
    assert again.count() == 150 and ws.predictions(spark).count() == 300


def test_missing_slices_only(spark, tmp_path):
    ws, events = jobs.Workspace(str(tmp_path)), flat_events(spark, SF)
    assert jobs.build_milestones(spark, ws, events, "2024-01-02", "2024-01-03", [1, 7]) == 4
    before = ws.store(spark).groupBy("install_date", "milestone_day").count().collect()
    # A wider range builds the new days; those built before stay as they are.
    assert jobs.build_milestones(spark, ws, events, "2024-01-02", "2024-01-04", [1, 7]) == 2
    after = ws.store(spark).groupBy("install_date", "milestone_day").count().collect()
    assert set(before) <= set(after) and len(after) == 6
    assert jobs.build_milestones(spark, ws, events, "2024-01-02", "2024-01-04", [1, 7]) == 0
    # Slices whose label was open on the day of the build are due again.
    assert jobs.build_milestones(
        spark, ws, events, "2024-01-05", "2024-01-05", [1, 7], as_of="2024-01-13") == 2
    assert jobs.build_milestones(
        spark, ws, events, "2024-01-05", "2024-01-05", [1, 7], as_of="2024-01-20") == 1
    assert jobs.build_snapshots(spark, ws, events, ["2024-01-08"]) == 1
    assert jobs.build_snapshots(spark, ws, events, ["2024-01-08", "2024-01-09"]) == 1
    jobs.build_risk(spark, ws, "2024-01-10", min_n=1, first_date="2024-01-08")
    store = ws.store(spark)
    assert store.where("snapshot_date >= '2024-01-08' AND country_uninstall_rate >= 0").count() > 0
    assert store.where("snapshot_date < '2024-01-08' AND country_uninstall_rate >= 0").count() == 0


def test_rates_never_learn_from_open_labels(spark, tmp_path):
    """Events end on the run day, so the labels of the scoring snapshot are unknown."""
    ws = jobs.Workspace(str(tmp_path))
    events = flat_events(spark, SF).where("event_date < '2024-01-20'")
    jobs.build_milestones(spark, ws, events, "2024-01-01", "2024-01-12", [1, 7], as_of="2024-01-20")
    jobs.build_snapshots(spark, ws, events, ["2024-01-20"], as_of="2024-01-20")
    store = ws.store(spark)
    snapshot = store.where("milestone_day = 0")
    assert snapshot.count() > 0 and snapshot.where(f"{c.LABEL} IS NOT NULL").count() == 0
    # a snapshot that was built with false labels does not count either
    false = snapshot.withColumn(c.LABEL, F.lit(0)).withColumn("snapshot_date", F.lit("2024-01-10").cast("date"))
    jobs.tables.write_slices(false, ws.path("features"))
    jobs.build_risk(spark, ws, "2024-01-20", min_n=1)
    closed = store.where("milestone_day > 0 AND snapshot_date <= '2024-01-13'")
    for r in ws.baseline(spark).where("dimension = 'country'").collect():
        rows = closed.where(F.col("country") == r.value)
        assert r.sample_size == rows.count()
        assert r.uninstall_rate == round(rows.agg(F.avg(c.LABEL)).first()[0], 4)


def test_days_without_events_leave_none(spark, tmp_path):
    ws, events = jobs.Workspace(str(tmp_path)), flat_events(spark, SF)
    jobs.refresh_days(events, ws, "2024-01-08", "2024-01-10")
    jobs.refresh_days(events.where("event_date <> '2024-01-09'"), ws, "2024-01-09", "2024-01-09")
    left = jobs.day_tables(spark, ws)
    for table in (left.measures, left.values):
        days = {r[0] for r in table.select("event_date").distinct().collect()}
        assert date(2024, 1, 9) not in days and days


def test_runs_keep_their_own_dictionary(spark, tmp_path):
    ws, events = jobs.Workspace(str(tmp_path)), flat_events(spark, SF)
    jobs.build_milestones(spark, ws, events, "2024-01-01", "2024-01-12", [1, 7])
    jobs.train_models(spark, ws, "2024-01-28", names=("gbt_a", "gbt_b"), run_id="one", **QUICK)
    first = {r.user_pseudo_id: r for r in jobs.score_day(spark, ws, events, "2024-01-22").collect()}
    # other rows, so other codes; only one model is trained again
    store = ws.store(spark).where("milestone_day = 1 AND snapshot_date < '2024-01-09'")
    renamed = store.withColumn("country", F.concat(F.lit("a"), "country")).withColumn("last_screen", F.reverse("last_screen"))
    jobs.tables.write_slices(renamed, ws.path("features"))
    jobs.train_models(spark, ws, "2024-01-28", names=("gbt_a",), run_id="two", **QUICK)
    codes = [spark.read.parquet(ws.path(f"runs/{r}/dictionary")).exceptAll(
        spark.read.parquet(ws.path(f"runs/{s}/dictionary"))).count() for r, s in (("one", "two"), ("two", "one"))]
    assert max(codes) > 0
    assert ws.production(spark) == {"gbt_a": "two", "gbt_b": "one"}
    second = {r.user_pseudo_id: r for r in jobs.score_day(spark, ws, events, "2024-01-22").collect()}
    assert all(second[u].uninstall_prob_gbt_b == r.uninstall_prob_gbt_b for u, r in first.items())
    back = jobs.score_day(spark, ws, events, "2024-01-22", runs={"gbt_a": "one", "gbt_b": "one"})
    assert all(first[r.user_pseudo_id].uninstall_prob_gbt_a == r.uninstall_prob_gbt_a for r in back.collect())


def test_scratch_is_removed(spark):
    from stayline.sources.shared import saved, scratch
    with scratch(spark):
        path = saved(spark.range(3)).inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    import os
    assert not os.path.exists(path)


def test_days_reduced_once_give_the_rows_of_events(spark, tmp_path):
    events = flat_events(spark, "/root/testdata/sf0.001")
    made = []
    for name, read in (("raw", events), ("days", jobs.reduced_days(events, "2023-12-02", "2024-02-17"))):
        ws = jobs.Workspace(str(tmp_path / name))
        jobs.build_milestones(spark, ws, read, "2024-01-01", "2024-01-02", (1, 7))
        jobs.build_snapshots(spark, ws, read, ["2024-01-15"])
        made.append(sorted(map(str, ws.store(spark).drop("created_at").collect())))
    assert made[0] == made[1] and made[0]


def test_days_without_events_can_be_reduced(spark):
    none = flat_events(spark, "/root/testdata/sf0.001").where("event_date > '2030-01-01'")
    days = jobs.reduced_days(none, "2024-01-01", "2024-02-01")
    assert days.measures.count() == days.values.count() == 0


def test_gaps_are_found_once_for_all_builds(spark, frame):
    from rows import INSTALL, row

    from stayline.operators import features

    events = frame([row(day, event_name=name, mapped_screen=screen, unique_session_id=f"s{day % 3}", click_button_name=button,
                        user_pseudo_id=user)
                    for user in ("u", "v") for day, name, screen, button in (
                        (0, c.SESSION_EVENT, c.HOME_SCREEN, "Search"), (1, "x", c.SEARCH_SCREEN, None), (6, c.SESSION_EVENT, c.HOME_SCREEN, ""),
                        (7, c.SESSION_EVENT, None, "Play"), (8, "x", c.HOME_SCREEN, "Search"), (14, c.SESSION_EVENT, c.SCAN_SCREEN, None))
                    if user == "u" or day in (0, 14)])
    days = jobs.reduced_days(events, "2024-01-30", "2024-04-10")
    assert "gap" in days.values.columns
    for build in (lambda x: features.milestone_features(x, INSTALL, INSTALL),
                  lambda x: features.calendar_range(x, ["2024-03-08", "2024-03-09", "2024-03-16"])):
        raw, stored = build(events), build(days)
        assert "Window" not in stored._jdf.queryExecution().optimizedPlan().toString()
        rows = sorted(map(str, stored.collect()))
        assert rows == sorted(map(str, raw.collect())) and rows


def test_aggregates_of_few_days_read_these_days_only():
    from stayline.functions import measures as m
    from stayline.operators.features import OfFacets, _parts

    specs = {"seven": OfFacets(m.count_in_days("n", 7)), "long": OfFacets(m.distinct_in_days("x", 14, first_day=8)),
             "past": OfFacets(m.ever("n")), "label": OfFacets(m.within_horizon("n"))}
    assert _parts(specs, False) == [(specs, (1 - c.LABEL_HORIZON, None))]
    parts = {tuple(part): within for part, within in _parts(specs, True)}
    assert parts == {("seven",): (1, 7), ("long", "past", "label"): (1 - c.LABEL_HORIZON, None)}
