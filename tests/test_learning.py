"""Encoding, splits, metrics, models and scoring."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline import config as c
from stayline.operators import boosting, dataset, encoding, metrics, models, scoring
from stayline.operators.lookup import is_small, lookup
from stayline.sources.shared import saved

START = date(2024, 1, 1)


@pytest.fixture(scope="module")
def rates(spark):
    rows = [(START, "u", v, 1 if i == 0 else 0) for v, n in (("a", 9), ("b", 10), ("c", 11), ("", 30))
            for i in range(n)] + [(START, "u", None, 1)]
    return spark.createDataFrame(
        rows, f"snapshot_date date, user_pseudo_id string, country string, {c.LABEL} int")


def test_sparse_values_have_no_rate(rates):
    got = encoding.risk_baseline(rates, START + timedelta(days=1), 10, ["country"]).collect()
    assert {r.value: (r.uninstall_rate, r.sample_size) for r in got} == {
        "b": (0.1, 10), "c": (0.0909, 11)}
    assert encoding.risk_baseline(rates, START, 1, ["country"]).count() == 0
    closed = encoding.risk_baseline(rates, START + timedelta(days=7), 1, ["country"], True)
    assert closed.count() == 3
    open_ = encoding.risk_baseline(rates, START + timedelta(days=6), 1, ["country"], True)
    assert open_.count() == 0


def test_rates_by_value_and_untouched_dimensions(spark):
    store = spark.createDataFrame(
        [("u", "a", "x", -1.0, 0.3), ("u", "b", "x", -1.0, 0.3), ("u", None, "x", 0.7, 0.3)],
        "user_pseudo_id string, country string, campaign string,"
        " country_uninstall_rate double, campaign_uninstall_rate double")
    baseline = spark.createDataFrame(
        [("country", "a", 0.25)], "dimension string, value string, uninstall_rate double")
    got = encoding.apply_risk(store, baseline, ["country", "campaign"]).collect()
    assert [(r.country_uninstall_rate, r.campaign_uninstall_rate) for r in got] == [
        (0.25, 0.3), (-1.0, 0.3), (-1.0, 0.3)]


def test_stale_rates_stay(spark):
    def version(v, rows):
        return spark.createDataFrame(rows, "dimension string, value string, rate double").withColumn(
            "updated_at", F.lit(v))
    merged = encoding.merge_baseline(
        version(1, [("d", "a", 0.1), ("d", "b", 0.2)]), version(2, [("d", "a", 0.9)]))
    assert {(r.value, r.rate) for r in merged.collect()} == {("a", 0.9), ("b", 0.2)}


def test_large_lookups_are_spread_over_copies(spark):
    frame = spark.range(1000).selectExpr(
        "concat('u', id) AS u", "CASE WHEN id % 3 = 0 THEN '' ELSE concat('k', id % 7) END AS k")
    table = spark.createDataFrame([("", 0), ("k1", 1), ("k2", 2)], "key string, value int")

    def found(**how):
        joined = lookup(frame, "k", table, "v", spread_by="u", **how)
        return sorted(map(str, joined.select("u", "k", "v").collect()))

    assert found(small=True) == found(small=False, salts=5)
    assert is_small(table, 3) and not is_small(table, 2)


def test_codes_follow_the_sorted_train_values(spark):
    train = spark.createDataFrame(
        [("u", "b", None), ("u", "", "x"), ("u", "b", "x"), ("u", "A", "x")],
        "user_pseudo_id string, p string, q string")
    dictionary = encoding.fit_ordinal(train, ["p", "q"])
    got = {(r.feature, r.value): r.code for r in dictionary.collect()}
    assert got == {("p", ""): 0, ("p", "A"): 1, ("p", "b"): 2, ("q", "__NA__"): 0, ("q", "x"): 1}
    new = spark.createDataFrame([("u", "zz", None), ("u", "b", "y")],
                                "user_pseudo_id string, p string, q string")
    coded = encoding.apply_ordinal(new, dictionary, ["p", "q"]).collect()
    assert [(r.p, r.q) for r in coded] == [(-1, 0), (2, -1)]


def days(spark, n, per_day=2):
    rows = [(START + timedelta(days=d), f"u{i}", 7, d, i % 2) for d in range(n)
            for i in range(per_day)]
    return spark.createDataFrame(
        rows, "snapshot_date date, user_pseudo_id string, milestone_day int,"
              f" days_since_install int, {c.LABEL} int")


@pytest.mark.parametrize("n, first", [(2, 1), (5, 4), (10, 8)])
def test_split_by_time(spark, n, first):
    rows = days(spark, n)
    train, valid = dataset.time_split(rows)
    assert valid.agg(F.min("snapshot_date")).collect()[0][0] == START + timedelta(days=first)
    assert train.count() + valid.count() == rows.count()
    apart, _ = dataset.time_split(rows, embargo_days=1)
    assert apart.count() == train.count() - 2


def test_split_needs_two_snapshots(spark):
    with pytest.raises(ValueError, match="two snapshots"):
        dataset.time_split(days(spark, 1))
    with pytest.raises(ValueError, match="no rows"):
        dataset.require_rows(days(spark, 1).where("false"), "the training set")


def test_training_set_has_closed_labels_only(spark):
    rows = days(spark, 10).unionByName(days(spark, 10).withColumn("milestone_day", F.lit(0)))
    as_of = START + timedelta(days=12)
    got = dataset.training_set(rows, as_of)
    assert got.agg(F.max("snapshot_date")).collect()[0][0] == START + timedelta(days=4)
    assert got.count() == 10 and dataset.training_set(rows, as_of, "all").count() == 20
    summary = dataset.dataset_summary(got).collect()[0]
    assert (summary.n_rows, summary.n_snapshots, summary.label_rate) == (10, 5, 0.5)
    last = dataset.last_snapshot_per_user(rows).collect()
    assert {r.days_since_install for r in last} == {9} and len(last) == 2


def brute(pairs):
    """ROC AUC over all pairs, average precision over all thresholds."""
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    auc = None
    if pos and neg:
        auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / len(pos) / len(neg)
    ap, recall = 0.0, 0.0
    for t in sorted({s for s, _ in pairs}, reverse=True):
        hits = [y for s, y in pairs if s >= t]
        now = sum(hits) / len(pos) if pos else 0.0
        ap += (now - recall) * sum(hits) / len(hits)
        recall = now
    return auc, ap


@pytest.mark.parametrize("buckets", [1, 2, 7, 256])
def test_ranking_metrics_equal_brute_force(spark, buckets, monkeypatch):
    monkeypatch.setattr(metrics.ranking_curve, "__defaults__", ((), buckets))
    rng = random.Random(5)
    data = {
        "ties": [(rng.randint(0, 6) / 6, rng.randint(0, 1)) for _ in range(300)],
        "fine": [(rng.random(), rng.randint(0, 1)) for _ in range(300)],
        "hand": [(0.9, 1), (0.5, 0), (0.5, 1), (0.1, 0)],
        "hot": [(0.5, i % 2) for i in range(200)] + [(rng.random(), 1) for _ in range(50)],
        "only0": [(0.1, 0), (0.2, 0)], "only1": [(0.1, 1), (0.2, 1)],
    }
    frame = spark.createDataFrame(
        [(k, s, y) for k, v in data.items() for s, y in v], "model string, score double, label int")
    got = {r.model: r for r in metrics.ranking_metrics(frame, ("model",)).collect()}
    for name, pairs in data.items():
        auc, ap = brute(pairs)
        assert got[name].auc_roc == (None if auc is None else pytest.approx(auc, abs=6e-5))
        assert got[name].auc_pr == pytest.approx(ap, abs=6e-5)


def test_threshold_metrics(spark):
    frame = spark.createDataFrame(
        [("m", 0.5, 1), ("m", 0.9, 0), ("m", 0.4, 1), ("n", 0.1, 0)],
        "model string, score double, label int")
    got = {r.model: (r.precision, r.recall, r.f1)
           for r in metrics.confusion_metrics(frame, ("model",)).collect()}
    assert got == {"m": (0.5, 0.5, 0.5), "n": (0.0, 0.0, 0.0)}


def test_selection_prefers_the_first_of_equals(spark):
    frame = spark.createDataFrame([("gbt_c", 0.4), ("gbt_b", 0.7), ("gbt_a", 0.7)],
                                  "model string, auc_pr double")
    got = metrics.model_selection(frame).orderBy("rank").collect()
    assert [(r.model, r.is_best) for r in got] == [("gbt_a", 1), ("gbt_b", 0), ("gbt_c", 0)]
    runs = metrics.model_selection(frame).withColumn("run_id", F.lit("r"))
    assert scoring.choose_model(runs, ["gbt_a", "gbt_b"]) == "gbt_a"
    assert scoring.choose_model(runs, ["gbt_c"]) == "gbt_c"
    assert scoring.choose_model(None, ["gbt_c", "gbt_b"]) == "gbt_b"
    with pytest.raises(RuntimeError):
        scoring.choose_model(runs, [])


def test_bins_are_closed_above(spark):
    frame = spark.createDataFrame(
        [(0, 0, 0, 0.5, 1), (1, 1, 1, 0.5, 0), (30, 4, 5, 0.5, 0)],
        "days_since_install int, session_cnt_7d int, funnel_depth int, score double, label int")

    def segments(**options):
        return {(r.feature, r.segment): r.n
                for r in metrics.segment_analysis(frame, **options).collect()}

    got = segments()
    assert got == {("days_since_install", "D0"): 1, ("days_since_install", "D8-30"): 1,
                   ("session_cnt_7d", "0"): 1, ("session_cnt_7d", "4-7"): 1,
                   ("funnel_depth", "0"): 1, ("funnel_depth", "1"): 1, ("funnel_depth", "4-5"): 1}
    assert segments(include_lowest=True)[("days_since_install", "D0")] == 2


def test_segments_of_risk(spark):
    frame = spark.createDataFrame(
        [(0.7,), (0.69,), (0.5,), (0.3,), (0.29,)], "uninstall_prob double"
    ).withColumn("risk_segment", scoring.risk_segment("uninstall_prob"))
    assert [r.risk_segment for r in frame.collect()] == [
        "very_high", "high", "high", "medium", "low"]
    got = {r.risk_segment: (r.users, r.share_at_risk)
           for r in scoring.segment_distribution(frame).collect()}
    assert got["all"] == (5, 0.6) and got["high"] == (2, 1.0)


def test_models_use_their_inputs(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        k = rng.randint(0, 3)
        rows.append((START + timedelta(days=i % 4), f"u{i}", 7, k, rng.random(), int(k in (0, 2))))
    frame = spark.createDataFrame(
        rows, "snapshot_date date, user_pseudo_id string, milestone_day int, k int, noise double,"
              f" {c.LABEL} int")
    inputs, sizes = ["noise", "k"], {"k": 4}
    train, valid = dataset.time_split(frame)
    for name in ("gbt_a", "gbt_c"):
        spec = models.MODELS[name]
        model = models.train(spec, train, valid, inputs, sizes, maxIter=5, maxDepth=3,
                             minInstancesPerNode=5)
        scored = models.probability(model, valid, inputs, sizes, spec.nominal, "score")
        got = metrics.ranking_metrics(scored.withColumnRenamed(c.LABEL, "label")).collect()[0]
        assert got.auc_roc > 0.95
        ranked = models.top(models.feature_importance(model, valid, inputs, sizes, spec.nominal))
        assert [r.feature for r in ranked.collect()] == ["k", "noise"]
        own = models.impurity_importance(spark, model, inputs).collect()
        assert max(own, key=lambda r: r.importance).feature == "k"
    sample = models.importance_sample(frame, 50)
    assert sample.count() == 50 and sorted(sample.collect()) == sorted(
        models.importance_sample(frame.repartition(7), 50).collect())


def _signal_frame(spark, n, days=4):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        k = rng.randint(0, 3)
        rows.append((START + timedelta(days=i % days), f"u{i}", 7, k, rng.random(), int(rng.random() < (0.8 if k in (0, 2) else 0.1))))
    return spark.createDataFrame(
        rows, "snapshot_date date, user_pseudo_id string, milestone_day int, k int, noise double,"
              f" {c.LABEL} int")


def test_registered_parameters_learn(spark):
    """The parameters of the library, unchanged, beat chance on held-out rows."""
    train, valid = dataset.time_split(_signal_frame(spark, 3000).cache())
    for name, spec in models.MODELS.items():
        model = models.train(spec, train, valid, ["noise", "k"], {"k": 4})
        scored = models.probability(model, valid, ["noise", "k"], {"k": 4}, spec.nominal, "score")
        got = metrics.ranking_metrics(scored.withColumnRenamed(c.LABEL, "label")).collect()[0]
        assert got.auc_roc > 0.8, name


def test_importance_sees_every_row(spark):
    frame = _signal_frame(spark, 6001)
    train, valid = dataset.time_split(frame)
    model = models.train(models.MODELS["gbt_b"], train, valid, ["noise", "k"], {"k": 4}, maxIter=3)
    used = {r.feature: r.importance for r in models.feature_importance(model, frame, ["noise", "k"], {"k": 4}).collect()}
    fewer = {r.feature: r.importance for r in models.feature_importance(
        model, frame, ["noise", "k"], {"k": 4}, rows=5000).collect()}
    assert used["k"] != fewer["k"] and abs(used["k"] - fewer["k"]) < 0.05
    plan = models.feature_importance(model, frame, ["noise", "k"], {"k": 4})._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_long_windows_are_refused():
    from stayline.functions import measures

    with pytest.raises(ValueError):
        measures.distinct_in_days("session", 31)
    with pytest.raises(ValueError):
        measures.days_with("n", 64)


def test_a_snapshot_is_scored_by_many_tasks(spark):
    """A day lies in a file or two; its rows are dealt out before they are looked up and scored."""
    snapshot = spark.range(50).coalesce(1).selectExpr(
        "cast(id AS string) AS user_pseudo_id", "date'2024-01-22' AS snapshot_date", *(f"concat('v', id % 3) AS {x}" for x in c.CATEGORICAL_FEATURES))
    dictionary = saved(encoding.fit_ordinal(snapshot))
    trees = boosting.Trees(["country"], [np.array([0.0, 1.0])], -1.0, [])
    scored = scoring.score(snapshot, {"gbt_a": scoring.Trained(models.Model(trees), dictionary, ["country"])}, "gbt_a")
    assert "hashpartitioning(user_pseudo_id" in scored._jdf.queryExecution().executedPlan().toString()
    assert scored.count() == 50 and scored.select("uninstall_prob_gbt_b", "uninstall_prob_gbt_c", "risk_segment").distinct().count() == 1
