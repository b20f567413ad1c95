"""Slices, versions and small tables."""

from datetime import date, datetime

import pytest

from stayline import config as c
from stayline.operators import features as f
from stayline.plans import jobs
from stayline.sources import store as tables
from stayline.sources.shared import shared_folder

DAY = date(2024, 1, 8)


def slices(spark, rows):
    return spark.createDataFrame(
        rows, f"snapshot_date date, user_pseudo_id string, milestone_day int, {c.LABEL} int")


def test_replacing_a_slice_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    other = date(2024, 1, 9)
    tables.write_slices(slices(spark, [(DAY, "a", 0, 0), (DAY, "b", 0, 1), (DAY, "a", 7, 1),
                                       (other, "a", 0, 0)]), path)
    for _ in range(2):  # building twice leaves the same rows
        tables.write_slices(slices(spark, [(DAY, "z", 0, 1)]), path)
    got = sorted(tuple(r) for r in tables.read_store(spark, path, []).select(
        "snapshot_date", "milestone_day", "user_pseudo_id").collect())
    assert got == [(DAY, 0, "z"), (DAY, 7, "a"), (other, 0, "a")]
    store = tables.read_store(spark, path, [])
    assert tables.slice_exists(store, milestone_day=7, snapshot_date=DAY)
    assert not tables.slice_exists(store, milestone_day=14, snapshot_date=DAY)
    report = {(r.milestone_day, r.snapshot_date): (r.n_rows, r.label_rate)
              for r in tables.build_report(store).collect()}
    assert report[(0, DAY)] == (1, 1.0)


def test_a_store_can_be_read_and_replaced_in_place(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_slices(slices(spark, [(DAY, "a", 0, 0), (DAY, "b", 7, 0)]), path)
    store = tables.read_store(spark, path, [])
    tables.write_slices(store.replace(0, 1, [c.LABEL]), path)
    got = tables.read_store(spark, path, [])
    assert {r[c.LABEL] for r in got.collect()} == {1} and got.count() == 2


def test_latest_version(spark):
    rows = spark.createDataFrame(
        [("k", 1, "old"), ("k", 2, "new"), ("l", 5, "b"), ("l", 5, "a"), ("m", 1, None)],
        "key string, v int, x string")
    got = {r.key: (r.v, r.x) for r in tables.latest_version(rows, ["key"], "v").collect()}
    assert got == {"k": (2, "new"), "l": (5, "b"), "m": (1, None)}


def test_tables_are_created_once(spark, tmp_path):
    ws = jobs.Workspace(str(tmp_path))
    jobs.init_tables(spark, ws)
    assert ws.store(spark).count() == 0
    baseline = spark.createDataFrame(
        [("country", "x", 0.5, 100, datetime(2024, 1, 1))], tables.RISK_SCHEMA)
    tables.write_risk_baseline(baseline, ws.path("risk_baseline"))
    jobs.init_tables(spark, ws)
    assert spark.read.parquet(ws.path("risk_baseline")).count() == 1
    declared = {x.name: x.dataType for x in tables.store_schema(f.FEATURES)}
    assert len(declared) == 154


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_flat_events_are_staged_by_day(spark, tmp_path, frame):
    from rows import row

    from stayline.sources import events as e
    path = str(tmp_path / "flat")
    e.stage_flat_events(frame([row(0), row(1), row(1)]), path)
    back = e.between_days(e.read_flat_events(spark, path), "2024-03-02", "2024-03-05")
    assert back.count() == 2
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


@pytest.mark.parametrize("name, kind", [
    ("country", "string"), ("session_cnt_7d", "bigint"), ("home_ratio_7d", "double"),
    ("is_day0_user", "int"), ("funnel_depth", "int"), ("ad_revenue_7d", "double"),
])
def test_types(name, kind):
    assert tables.store_schema([name])[name].dataType.simpleString() == kind
