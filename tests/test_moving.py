"""State moved on by days, late events, rates and codes over time."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stayline import config as c
from stayline.operators import encoding, features, sliding
from stayline.plans import jobs
from stayline.sources import store as tables
from stayline.sources.events import as_date, flat_events

SF = "/root/testdata/sf0.001"
FIRST = date(2024, 1, 12)


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_state_equals_a_build_on_ten_days_in_a_row(spark, tmp_path):
    ws, events = jobs.Workspace(str(tmp_path)), flat_events(spark, SF).cache()
    jobs.refresh_days(events, ws, "2023-12-01", "2024-01-30")
    days = jobs.day_tables(spark, ws)
    through = FIRST + timedelta(days=c.LABEL_HORIZON - 1)
    some = ["session_cnt_1d", "session_cnt_30d", "unique_screen_cnt_7d", "active_days_7d", "last_screen", "hours_since_last_search", c.LABEL]
    for k in range(10):
        columns = features.ALL_COLUMNS if k == 9 else some
        state = jobs.advance_state(spark, ws, through + timedelta(days=k))
        assert state.snapshot() == FIRST + timedelta(days=k)
        assert rows(features.calendar_features(state.tables(), state.snapshot(), columns=columns)) == rows(
            features.calendar_features(days, state.snapshot(), columns=columns)), k
        # nothing before the span stays, and a state is read again, not built again
        assert state.measures.where(F.col("event_date") < as_date(state.first)).count() == 0
        assert state.facets.where(F.col("distinct_screen") < 0).count() == 0
    assert rows(jobs.advance_state(spark, ws, state.through).seen) == rows(state.seen)
    # of the day tables a step reads one day
    moved = sliding.advance(state, days)
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    plan = moved.facets._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    day = (state.through + timedelta(days=1)).isoformat()
    scans = [line for line in plan.splitlines() if "/days/values" in line]
    assert scans and all(f">= {day})" in x and f"<= {day})" in x for x in scans)
    # the state of the last days before a snapshot serves scoring on that day
    live = sliding.start(days, FIRST - timedelta(days=1))
    now = features.calendar_features(live.tables(), FIRST, columns=["session_cnt_7d", "unique_screen_cnt_7d"])
    past = features.calendar_features(events.where(F.col("event_date") < as_date(FIRST)), FIRST, columns=["session_cnt_7d", "unique_screen_cnt_7d"])
    assert rows(now) == rows(past)


def test_a_late_event_makes_exactly_its_slices_due(spark, tmp_path):
    ws, events = jobs.Workspace(str(tmp_path)), flat_events(spark, "/root/testdata/sf0.01").cache()
    options = {"milestones": [1, 7], "by_content": True}
    assert jobs.build_milestones(spark, ws, events, "2024-01-02", "2024-01-06", **options) == 10
    assert jobs.build_snapshots(spark, ws, events, ["2024-01-08", "2024-01-25"], by_content=True) == 2
    assert jobs.build_milestones(spark, ws, events.repartition(7), "2024-01-02", "2024-01-06", **options) == 0
    late = events.where("event_date = '2024-01-10'").limit(1)
    assert late.count() == 1
    more = events.unionByName(late.withColumn("event_name", F.lit("late")))
    wanted = [(m, date(2024, 1, i) + timedelta(days=m)) for i in range(2, 7) for m in (1, 7)] + [(0, date(2024, 1, 8)), (0, date(2024, 1, 25))]
    # the label window of a milestone of one day ends seven days after the install
    due = jobs.due_slices(spark, ws, more, wanted, by_content=True)
    assert set(due) == {(m, s) for m, s in wanted if s - timedelta(days=m + 30) <= date(2024, 1, 10) <= s + timedelta(days=6)}
    assert 0 < len(due) < len(wanted)
    assert jobs.due_slices(spark, ws, more, wanted) == []
    n = jobs.build_milestones(spark, ws, more, "2024-01-02", "2024-01-06", **options)
    assert n == sum(1 for m, _ in due if m) and jobs.build_milestones(spark, ws, more, "2024-01-02", "2024-01-06", **options) == 0
    # a null that changes its place is a change, an order is none
    a = spark.createDataFrame([(FIRST, None, "x"), (FIRST, "y", None)], "event_date date, a string, b string")
    b = spark.createDataFrame([(FIRST, "x", None), (FIRST, "y", None)], "event_date date, a string, b string")
    first, second = (tables.day_checksums(f).first().checksum for f in (a, b))
    assert first != second and first == tables.day_checksums(a.orderBy(F.desc("a"))).first().checksum


def test_rates_as_they_were_known(spark):
    store = spark.createDataFrame(
        [(FIRST + timedelta(days=d), "u", 1, v, y, -1.0) for d, v, y in
         [(0, "a", 1), (0, "a", 0), (1, "a", 1), (8, "a", 0), (7, "a", 0), (9, "", 1), (20, "a", 1), (20, None, 0), (7, "b", 1), (30, "b", None)]],
        f"snapshot_date date, user_pseudo_id string, milestone_day int, country string, {c.LABEL} int, country_uninstall_rate double")
    versions = encoding.rate_versions(store, 2, ["country"])
    got = encoding.apply_known_risk(store, versions, ["country"])
    known = {((r.snapshot_date - FIRST).days, r.country): r.country_uninstall_rate for r in got.collect()}
    assert known == {(0, "a"): -1.0, (1, "a"): -1.0, (7, "a"): 0.5, (8, "a"): 0.6667, (9, ""): -1.0, (20, "a"): 0.4, (20, None): -1.0,
                     (7, "b"): -1.0, (30, "b"): -1.0}
    # no label that closed after a row's day is in its rate
    flipped = store.withColumn(c.LABEL, F.when(F.col("snapshot_date") > as_date(FIRST + timedelta(days=1)), 1 - F.col(c.LABEL)).otherwise(F.col(c.LABEL)))
    early = encoding.apply_known_risk(flipped, encoding.rate_versions(flipped, 2, ["country"]), ["country"]).where("snapshot_date <= '2024-01-20'")
    assert rows(early.select("snapshot_date", "country", "country_uninstall_rate")) == rows(
        got.where("snapshot_date <= '2024-01-20'").select("snapshot_date", "country", "country_uninstall_rate"))


def test_codes_stay(spark):
    def values(*pairs):
        return spark.createDataFrame([("u", *p) for p in pairs], "user_pseudo_id string, p string, q string")

    first = encoding.fit_ordinal(values(("b", "x"), ("d", "x")), ["p", "q"])
    second = encoding.extend_ordinal(first, values(("a", "x"), ("c", None), ("d", "w")), 1, ["p", "q"])
    third = encoding.extend_ordinal(second, values(("a", "x"), ("0", "x")), 2, ["p", "q"])
    got = {(r.feature, r.value): (r.code, r.version) for r in third.collect()}
    assert got == {("p", "b"): (0, 0), ("p", "d"): (1, 0), ("p", "a"): (2, 1), ("p", "c"): (3, 1), ("p", "0"): (4, 2),
                   ("q", "x"): (0, 0), ("q", "__NA__"): (1, 1), ("q", "w"): (2, 1)}
    assert rows(encoding.dictionary_at(third, 0)) == rows(first.select("feature", "value", "code"))
    assert rows(encoding.extend_ordinal(third, values(("a", "x")), 3, ["p", "q"])) == rows(third)
    new = values(("c", "zz"), ("nowhere", "w"))
    coded = encoding.apply_ordinal(new, encoding.dictionary_at(third, 1), ["p", "q"]).collect()
    assert [(r.p, r.q) for r in coded] == [(3, -1), (-1, 2)]


@pytest.mark.parametrize("seed", [1, 7])
def test_ordered_statistics_leave_out_the_own_label(spark, seed):
    frame = spark.createDataFrame(
        [(FIRST + timedelta(days=i % 5), f"u{i}", i % 3, i % 4 if i % 11 else None, (i * 7) % 5 == 0) for i in range(300)],
        f"snapshot_date date, user_pseudo_id string, milestone_day int, k int, {c.LABEL} boolean").withColumn(c.LABEL, F.col(c.LABEL).cast("int"))
    placed = frame.withColumn("place", encoding.random_order(seed)).orderBy("place").collect()
    seen, want = {}, {}
    for r in placed:
        pos, n = seen.get(r.k, (0, 0))
        want[r.user_pseudo_id] = (pos + 0.5) / (n + 1)
        seen[r.k] = (pos + r[c.LABEL], n + 1)
    got = {r.user_pseudo_id: r.k for r in encoding.ordered_statistics(frame, ["k"], seed).collect()}
    assert got == pytest.approx(want)
    table = encoding.category_statistics(frame, ["k"])
    whole = {r.user_pseudo_id: r.k for r in encoding.with_statistics(frame, table, ["k"]).collect()}
    assert whole["u1"] == pytest.approx((seen[1][0] + 0.5) / (seen[1][1] + 1))


def test_ordered_statistics_do_not_broadcast_rows(spark, tmp_path):
    """Files of encoded rows are far smaller than the rows, which the driver must not hold."""
    path = str(tmp_path / "encoded")
    spark.range(400).selectExpr(
        "cast(id AS string) AS user_pseudo_id", "date'2024-01-01' AS snapshot_date", "7 AS milestone_day",
        "cast(id % 3 AS int) AS k", f"cast(id % 2 AS int) AS {c.LABEL}").write.parquet(path)
    found = encoding.ordered_statistics(spark.read.parquet(path), ["k"], 1)
    assert len(found.collect()) == 400
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
