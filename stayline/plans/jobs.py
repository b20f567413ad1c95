"""The scheduled jobs: build, rate, train, score.

Every job takes its run date as an argument and reads and writes the tables of
a workspace.  Running a job again leaves the same tables.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline import config as c
from stayline.operators import (
    anchors, dataset, encoding, features, metrics, models, rollup, scoring, sliding,
)
from stayline.sources import store as tables
from stayline.sources.events import as_date, between_days
from stayline.sources.shared import saved, scratch


@dataclass(frozen=True)
class Workspace:
    """Where the tables of one deployment live."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def exists(self, spark: SparkSession, name: str) -> bool:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)

    def complete(self, spark: SparkSession, name: str) -> bool:
        """Whether a table was written to its end; a half-written folder is not."""
        return self.exists(spark, f"{name}/_SUCCESS")

    def store(self, spark: SparkSession) -> DataFrame:
        return tables.read_store(spark, self.path("features"), features.FEATURES)

    def baseline(self, spark: SparkSession) -> DataFrame:
        return tables.read_table(spark, self.path("risk_baseline"), tables.RISK_SCHEMA)

    def metrics(self, spark: SparkSession) -> DataFrame:
        return tables.read_table(spark, self.path("metrics"), tables.METRICS_SCHEMA)

    def production(self, spark: SparkSession) -> dict[str, str]:
        """The run each model is taken from: one row per model."""
        if not self.exists(spark, "production"):
            return {}
        rows = tables.read_table(spark, self.path("production"), tables.PRODUCTION_SCHEMA)
        return {r.model: r.run_id for r in rows.collect()}

    def predictions(self, spark: SparkSession) -> DataFrame:
        return tables.read_table(spark, self.path("predictions"), tables.PREDICTION_SCHEMA)


def init_tables(spark: SparkSession, ws: Workspace) -> None:
    """Create the tables that do not exist yet."""
    schema = tables.store_schema(features.FEATURES)
    tables.create_table(spark, ws.path("features"), schema, tables.SLICE)
    tables.create_table(spark, ws.path("risk_baseline"), tables.RISK_SCHEMA, ("dimension",))
    tables.create_table(
        spark, ws.path("predictions"), tables.PREDICTION_SCHEMA, ("prediction_date",)
    )


def refresh_days(events: DataFrame, ws: Workspace, first, last) -> None:
    """Reduce new days of events to day tables; days without events leave none."""
    tables.write_day_tables(
        between_days(events, first, last), features.CHURN_ROLLUP, ws.path("days"),
        anchors.snapshot_dates(first, last),
    )


def day_tables(spark: SparkSession, ws: Workspace):
    return tables.read_day_tables(spark, features.CHURN_ROLLUP, ws.path("days"))


def reduced_days(events: DataFrame, first, last) -> rollup.DayTables:
    """Day tables of some days, reduced once for several builds; values have their gaps."""
    days = rollup.day_tables(between_days(events, first, last), features.CHURN_ROLLUP)
    gapped = rollup.facet_rows(days.values, days.spec)
    measures = saved(days.measures)
    return days._replace(measures=measures, values=saved(gapped), rows=measures.count())


# --- feature builds --------------------------------------------------------


def finished_slices(spark: SparkSession, ws: Workspace, days) -> set[tuple[int, date]]:
    """Slices built after their label window had closed; there is one row per slice.

    A label that was still unknown makes a slice due again.  Only the partitions
    between the first and the last of ``days`` are read.
    """
    if not days or not ws.exists(spark, "features"):
        return set()
    built = (
        ws.store(spark)
        .where(F.col("snapshot_date").between(as_date(min(days)), as_date(max(days))))
        .groupBy(*tables.SLICE)
        .agg(F.max("created_at").alias("built"),
             F.count_if(F.col(c.LABEL).isNull()).alias("unknown"))
    )
    closed = (F.col("unknown") == 0) & (
        F.col("built") >= F.date_add("snapshot_date", c.LABEL_HORIZON)
    )
    return {(r.milestone_day, r.snapshot_date) for r in built.where(closed).collect()}


def changed_slices(spark: SparkSession, ws: Workspace, events, slices) -> set[tuple[int, date]]:
    """Slices that were built from other events than there are now, by checksums of their days."""
    if not slices:
        return set()
    if not ws.exists(spark, "inputs"):
        return set(slices)
    recorded = tables.read_table(spark, ws.path("inputs"), tables.INPUTS_SCHEMA)
    changed = tables.changed_slices(recorded, tables.slice_inputs(events, spark, slices))
    return {(r.milestone_day, r.snapshot_date) for r in changed.collect()}


def due_slices(spark: SparkSession, ws: Workspace, events, slices, *, force: bool = False,
               by_content: bool = False) -> list[tuple[int, date]]:
    """The slices to build, of ``(milestone day, snapshot date)``.

    With ``by_content`` finished slices are due again if a day they read has changed.
    """
    done = set() if force else finished_slices(spark, ws, [day for _, day in slices])
    if by_content:
        done -= changed_slices(spark, ws, events, sorted(done & set(slices)))
    return [x for x in slices if x not in done]


def _record_build(spark, ws, events, slices, by_content) -> None:
    _report_build(spark, ws, slices)
    if by_content:
        tables.write_inputs(tables.slice_inputs(events, spark, slices), ws.path("inputs"))


def build_milestones(spark: SparkSession, ws: Workspace, events, install_from, install_to,
                     milestones=c.MILESTONES, *, force: bool = False, as_of=None, by_content: bool = False) -> int:
    """Build the missing milestone slices; returns how many were due.

    Decided per install day and milestone, so a late day is never hidden by
    another slice of the same range.  With ``by_content`` slices keep checksums of the
    days they were built from, and late events make exactly the slices that read
    their day due again.
    """
    wanted = anchors.milestone_slices(install_from, install_to, milestones)
    return _build_slices(spark, ws, events, wanted, force, as_of, by_content=by_content)


def _build_slices(spark, ws, events, wanted, force, as_of, narrow=False, by_content=False) -> int:
    slices = [(m, day + timedelta(days=m)) for day, m in wanted]
    slices = due_slices(spark, ws, events, slices, force=force, by_content=by_content)
    if not slices:
        return 0
    due = [(day - timedelta(days=m), m) for m, day in slices]
    built = features.slice_features(events, due, as_of=as_of, narrow=narrow)
    tables.write_features(built, ws.path("features"), slices)
    _record_build(spark, ws, events, slices, by_content)
    return len(due)


def _report_build(spark, ws, slices) -> None:
    """Rows and label rate of the slices just built; one row per slice."""
    days = [day for _, day in slices]
    wanted = spark.createDataFrame(slices, "milestone_day int, snapshot_date date")
    built = ws.store(spark).where(F.col("snapshot_date").between(as_date(min(days)), as_date(max(days))))
    report = tables.build_report(built.join(F.broadcast(wanted), list(tables.SLICE), "left_semi"))
    tables.write_slices(report, ws.path("reports/builds"), ("snapshot_date",), "milestone_day")


def build_label_complete(spark: SparkSession, ws: Workspace, events, run_date,
                         milestones=c.MILESTONES, *, force: bool = False) -> int:
    """Build the slices whose label window closed on the run day."""
    wanted = anchors.label_complete_slices(run_date, milestones)
    return _build_slices(spark, ws, events, wanted, force, run_date, narrow=True)


def build_snapshots(spark: SparkSession, ws: Workspace, events, dates, *,
                    force: bool = False, by_content: bool = False, **options) -> int:
    """Build the missing calendar slices; returns how many were due."""
    slices = [(0, anchors._day(x)) for x in dates]
    slices = due_slices(spark, ws, events, slices, force=force, by_content=by_content)
    if slices:
        built = features.calendar_range(events, [day for _, day in slices], **options)
        tables.write_features(built, ws.path("features"), slices)
        _record_build(spark, ws, events, slices, by_content)
    return len(slices)


# --- state of users --------------------------------------------------------


def advance_state(spark: SparkSession, ws: Workspace, day) -> sliding.State:
    """The state through a day: the one of the day before moved on, or else built from day tables."""
    day, path = anchors._day(day), ws.path("state")
    days, spec = day_tables(spark, ws), features.CHURN_ROLLUP

    def known(through) -> bool:
        return all(ws.complete(spark, f"state/{through}/{name}") for name in ("measures", "facets", "seen"))

    if known(day):
        return sliding.read_state(spark, path, day, spec)
    before = day - timedelta(days=1)
    if known(before):
        return sliding.write_state(sliding.advance(sliding.read_state(spark, path, before, spec), days), path)
    return sliding.write_state(sliding.start(days, day), path)


# --- target encoding -------------------------------------------------------


def build_risk(spark: SparkSession, ws: Workspace, cutoff, *, min_n: int = c.MIN_RISK_SAMPLE,
               first_date=None, kind: str = "milestone") -> None:
    """Merge new rates into the baseline and write them to the recent slices.

    Rates come from milestone rows with closed labels; scoring snapshots would
    count the same users again.
    """
    with scratch(spark):
        new = encoding.risk_baseline(
            ws.store(spark), cutoff, min_n, label_closed=True, kind=kind
        ).withColumn("updated_at", F.current_timestamp())
        if ws.exists(spark, "risk_baseline"):
            new = encoding.merge_baseline(ws.baseline(spark), new)
        tables.write_risk_baseline(new, ws.path("risk_baseline"))
        recent = ws.store(spark).where(F.col("snapshot_date") >= as_date(first_date or cutoff))
        tables.write_slices(encoding.apply_risk(recent, ws.baseline(spark)), ws.path("features"))


# --- training --------------------------------------------------------------


def train_models(spark: SparkSession, ws: Workspace, as_of, *, kind: str = "milestone",
                 names=c.MODEL_NAMES, embargo_days: int = 0, importance: bool = False,
                 ratio: float = c.TRAIN_RATIO, run_id: str | None = None,
                 **overrides) -> DataFrame:
    """Train, compare and save; returns the metrics, best model first.

    All that a run makes lies below ``runs/<run_id>``: models, the dictionary
    and inputs they were trained with, held-out scores and reports.  Only when
    it is complete do the names in ``production`` point at it; earlier runs stay.
    """
    run_id = run_id or str(as_of)
    at = f"runs/{run_id}"
    inputs = features.MODEL_INPUTS
    with scratch(spark):
        rows = dataset.training_set(ws.store(spark), as_of, kind)
        rows = dataset.require_rows(rows, "the training set")
        dataset.dataset_summary(rows).write.mode("overwrite").parquet(ws.path(f"{at}/summary"))
        train_rows, valid_rows = dataset.time_split(rows, ratio, embargo_days)
        encoding.fit_ordinal(train_rows).write.mode("overwrite").parquet(ws.path(f"{at}/dictionary"))
        spark.createDataFrame(list(enumerate(inputs)), "position int, feature string").write.mode(
            "overwrite").parquet(ws.path(f"{at}/inputs"))
        dictionary = spark.read.parquet(ws.path(f"{at}/dictionary"))
        sizes = models.dictionary_sizes(dictionary)
        # Encoded once; boosting reads it many times.
        for part, frame in (("train", train_rows), ("valid", valid_rows)):
            encoding.apply_ordinal(frame, dictionary).write.mode("overwrite").parquet(
                ws.path(f"{at}/encoded/{part}")
            )
        train_rows = spark.read.parquet(ws.path(f"{at}/encoded/train"))
        valid_rows = spark.read.parquet(ws.path(f"{at}/encoded/valid"))
        n_train, n_valid = train_rows.count(), valid_rows.count()

        scored, facts = None, []
        for name in names:
            spec, start = models.MODELS[name], time.time()
            model = models.train(spec, train_rows, valid_rows, inputs, sizes, **overrides)
            params = json.dumps({**spec.params, **overrides}, sort_keys=True, default=str)
            facts.append((name, params, n_train, n_valid, len(inputs), round(time.time() - start, 3)))
            models.save_model(model, ws.path(f"{at}/models/{name}"))
            held_out = models.probability(
                model, valid_rows, inputs, sizes, spec.nominal, "score"
            ).select(
                F.lit(name).alias("model"), "score", F.col(c.LABEL).alias("label"),
                *[F.col(x).alias(x) for x in c.SEGMENT_BINS],
            )
            scored = held_out if scored is None else scored.unionByName(held_out)
            if importance:
                tables.write_importance(
                    models.feature_importance(model, valid_rows, inputs, sizes, spec.nominal),
                    ws.path(f"{at}/importance/{name}"),
                )
        scored.write.mode("overwrite").parquet(ws.path(f"{at}/held_out"))
        scored = spark.read.parquet(ws.path(f"{at}/held_out"))
        about = spark.createDataFrame(
            facts, "model string, params string, train_rows long, valid_rows long, n_inputs int, train_seconds double")
        compared = metrics.model_selection(metrics.model_metrics(scored)).join(
            F.broadcast(about), "model"  # one row per model
        ).withColumn("run_id", F.lit(run_id))
        tables.write_metrics(compared, ws.path("metrics"))
        report = metrics.segment_analysis(scored.where(F.col("model") == names[0]))
        report.write.mode("overwrite").parquet(ws.path(f"{at}/segments"))
    tables.write_production(spark, {name: run_id for name in names}, ws.path("production"))
    return ws.metrics(spark).where(F.col("run_id") == run_id)


def trained_models(spark: SparkSession, ws: Workspace, runs: dict[str, str]) -> dict[str, scoring.Trained]:
    """Models of the given runs, each with its own dictionary and inputs."""
    found, dictionaries = {}, {}
    for name, run_id in runs.items():
        at = f"runs/{run_id}"
        if not ws.complete(spark, f"{at}/models/{name}/metadata"):
            continue
        if run_id not in dictionaries:
            inputs = spark.read.parquet(ws.path(f"{at}/inputs")).orderBy("position").collect()
            dictionaries[run_id] = (
                spark.read.parquet(ws.path(f"{at}/dictionary")), [r.feature for r in inputs])
        found[name] = scoring.Trained(
            models.load_model(ws.path(f"{at}/models/{name}"), models.MODELS[name].nominal), *dictionaries[run_id])
    return found


# --- scoring ---------------------------------------------------------------


def score_day(spark: SparkSession, ws: Workspace, events, day, runs: dict[str, str] | None = None) -> DataFrame:
    """Score the calendar snapshot of a day, building it when absent.

    Its label is unknown on that day and stays null.  ``runs`` names other runs
    than those in production.
    """
    if not ws.exists(spark, "features") or not tables.slice_exists(
        ws.store(spark), milestone_day=0, snapshot_date=day
    ):
        build_snapshots(spark, ws, events, [day], force=True, as_of=day)
    snapshot = dataset.require_rows(
        ws.store(spark).where(
            (F.col("milestone_day") == 0) & (F.col("snapshot_date") == as_date(day))
        ),
        f"the snapshot of {day}",
    )
    if ws.exists(spark, "risk_baseline"):
        snapshot = encoding.apply_risk(snapshot, ws.baseline(spark))
    runs = runs or ws.production(spark)
    trained = trained_models(spark, ws, runs)
    known = ws.metrics(spark) if ws.exists(spark, "metrics") else None
    primary = scoring.choose_model(known, trained)
    tables.write_predictions(scoring.score(snapshot, trained, primary), ws.path("predictions"))
    predictions = ws.predictions(spark).where(F.col("prediction_date") == as_date(day))
    for name, report in (("segments", scoring.segment_distribution(predictions)),
                         ("means", scoring.mean_probability(predictions))):
        report.write.mode("overwrite").parquet(ws.path(f"reports/scores/{day}/{name}"))
    return predictions


# --- schedules -------------------------------------------------------------


def daily(spark: SparkSession, ws: Workspace, events, run_date) -> DataFrame:
    """Label-complete milestone slices, today's snapshot, today's scores."""
    build_label_complete(spark, ws, events, run_date)
    build_snapshots(spark, ws, events, [run_date], force=True, as_of=run_date)
    return score_day(spark, ws, events, run_date)


def weekly(spark: SparkSession, ws: Workspace, events, run_date, *,
           min_n: int = c.MIN_RISK_SAMPLE, **training) -> DataFrame:
    """Four weeks of milestones, new rates, new models, new scores."""
    first, last = anchors.rolling_install_range(run_date)
    build_milestones(spark, ws, events, first, last, as_of=run_date)
    build_risk(spark, ws, first, min_n=min_n)
    train_models(spark, ws, run_date, importance=True, **training)
    return score_day(spark, ws, events, run_date)

