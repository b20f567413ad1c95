"""SQL per query key."""

from __future__ import annotations

from oracles import features as o
from stayline import config as c

FROM, TO = "2024-01-01", "2024-01-14"
SNAPSHOT = "2024-01-15"
SNAPSHOTS = ("2024-01-08", "2024-01-15", "2024-01-22")
KEYS = "snapshot_date, user_pseudo_id, install_date, milestone_day"

SCORES = {
    "gbt_a": "cast(least(hours_since_last_session, 720) AS double)"
             " / cast(720 + 24 * active_days_7d AS double)",
    "gbt_b": "cast(1 AS double) / cast(1 + session_cnt_7d AS double)",
    "gbt_c": "cast(5 - funnel_depth AS double) / cast(5 AS double)",
}
SCORE_INPUTS = ["hours_since_last_session", "active_days_7d", "session_cnt_7d", "funnel_depth",
                "days_since_install"]
DIMENSIONS = ["country", "campaign", "media_source", "app_version"]
CATEGORIES = ["media_source", "campaign", "country", "language", "app_version", "first_screen",
              "last_screen", "first_button", "last_button", "notif_permission_status"]


def store(names) -> str:
    """The feature store of the test workspace with some of its columns."""
    milestone = ",".join(o.milestone_events(FROM, TO))
    calendar = ",".join(o.calendar_events(SNAPSHOTS))
    names = list(dict.fromkeys([*names, c.LABEL]))
    return f"""
milestone_store AS (WITH {milestone} {o.milestone_select(names)}),
calendar_store AS (WITH {calendar} {o.calendar_select(names)}),
store AS (SELECT * FROM milestone_store UNION ALL SELECT * FROM calendar_store)"""


TRAINING = """
training AS (SELECT * FROM store WHERE milestone_day > 0
  AND snapshot_date <= date '2024-01-26' - 8)"""

SPLIT = """
days AS (SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) - 1 AS i,
    count(*) OVER () AS n FROM (SELECT DISTINCT snapshot_date FROM training)),
split AS (SELECT snapshot_date AS first_day FROM days
  WHERE i = least(greatest(1, cast(floor(n * 0.8) AS bigint)), n - 1)),
train AS (SELECT * FROM training WHERE snapshot_date < (SELECT first_day FROM split)),
valid AS (SELECT * FROM training WHERE snapshot_date >= (SELECT first_day FROM split))"""


def scored() -> list[str]:
    parts = " UNION ALL ".join(
        f"SELECT {KEYS}, {c.LABEL} AS label, days_since_install, session_cnt_7d, funnel_depth,"
        f" '{k}' AS model, {x} AS score FROM training" for k, x in SCORES.items()
    )
    return [store(SCORE_INPUTS), TRAINING, f"scored AS ({parts})"]


CONFUSION = """
confusion AS (
  SELECT model, CASE WHEN hits > 0 THEN round(tp / hits, 4) ELSE 0.0::double END AS precision,
    CASE WHEN p > 0 THEN round(tp / p, 4) ELSE 0.0::double END AS recall,
    CASE WHEN hits + p > 0 THEN round(2 * tp / (hits + p), 4) ELSE 0.0::double END AS f1
  FROM (SELECT model, cast(count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS double) AS tp,
          count(*) FILTER (WHERE score >= 0.5) AS hits,
          count(*) FILTER (WHERE label = 1) AS p
        FROM scored GROUP BY model) t)"""

# Every positive against every negative; and precision at every positive's score.
RANKING = """
auc AS (
  SELECT a.model, round(avg(CASE WHEN a.score > b.score THEN 1.0::double
      WHEN a.score = b.score THEN 0.5::double ELSE 0.0::double END), 4) AS auc_roc
  FROM scored a JOIN scored b ON a.model = b.model WHERE a.label = 1 AND b.label = 0
  GROUP BY a.model),
ap AS (
  SELECT model, round(avg(at_or_above_pos / at_or_above), 4) AS auc_pr
  FROM (SELECT model, label,
      cast(sum(label) OVER w AS double) AS at_or_above_pos,
      cast(count(*) OVER w AS double) AS at_or_above
    FROM scored
    WINDOW w AS (PARTITION BY model ORDER BY score DESC
                 RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) t
  WHERE label = 1 GROUP BY model)"""

SELECTION = """
compared AS (SELECT auc.model, auc_roc, auc_pr, precision, recall, f1
  FROM auc JOIN ap ON auc.model = ap.model JOIN confusion ON auc.model = confusion.model),
ranked AS (SELECT *, cast(row_number() OVER (ORDER BY auc_pr DESC, model) AS integer) AS rank
  FROM compared)"""


def milestone(names, churned: bool = False) -> str:
    return o.with_flat(
        o.milestone_select(names, exclude_churned=churned), *o.milestone_events(FROM, TO)
    )


def calendar(names, dates) -> str:
    return o.with_flat(o.calendar_select(names), *o.calendar_events(dates))


def on_store(body: str, names, *ctes: str) -> str:
    return o.with_flat(body, store(names), *ctes)


def baseline(name: str, cutoff: str, min_n: int) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d} AS value, round(avg({c.LABEL}), 4) AS uninstall_rate,"
        f" count(*) AS sample_size FROM store"
        f" WHERE snapshot_date < date '{cutoff}' AND {d} <> '' GROUP BY {d}"
        f" HAVING count(*) >= {min_n}" for d in DIMENSIONS
    )
    return f"{name} AS ({parts})"


def rates(when: str = "true") -> str:
    return ", ".join(
        f"CASE WHEN {when} AND EXISTS (SELECT 1 FROM rates WHERE dimension = '{d}')"
        f" THEN coalesce((SELECT uninstall_rate FROM rates r"
        f" WHERE r.dimension = '{d}' AND r.value = s.{d}), -1.0::double)"
        f" ELSE -1.0::double END AS {d}_uninstall_rate" for d in DIMENSIONS
    )


def dictionary(source: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT DISTINCT '{x}' AS feature, coalesce({x}, '__NA__') AS value FROM {source}"
        for x in CATEGORIES
    )
    return (
        "dictionary AS (SELECT feature, value, cast(row_number() OVER"
        f" (PARTITION BY feature ORDER BY value) - 1 AS integer) AS code FROM ({parts}) v)"
    )


def by_input(source: str, inputs) -> str:
    """Encoded rows as ``(feature, v, y)``."""
    columns = ", ".join(
        f"(SELECT code FROM dictionary d WHERE d.feature = '{x}' AND d.value = coalesce(s.{x}, '__NA__'))::double AS {x}"
        if x in CATEGORIES else f"{x}::double AS {x}" for x in inputs)
    return (f"by_input AS (SELECT feature, v, y FROM (SELECT {c.LABEL} AS y, {columns} FROM {source} s)"
            f" UNPIVOT INCLUDE NULLS (v FOR feature IN ({', '.join(inputs)})))")


def strength(g: str, h: str) -> str:
    return f"power(greatest(abs({g}) - 0.1, 0), 2) / ({h} + 0.1)"


#: Gradients and Hessians in steps of 2**-24 at the label rate; borders are values but the last.
SPLIT_GAINS = f"""
SELECT feature, cast(n AS integer) AS distinct_values, border, gain, CASE WHEN gain IS NOT NULL THEN cast(below AS bigint) END AS rows_below FROM (
  SELECT feature, n, CASE WHEN gain IS NOT NULL THEN v END AS border, gain, nl AS below,
    row_number() OVER (PARTITION BY feature ORDER BY gain DESC NULLS LAST, v) AS k
  FROM (SELECT *, CASE WHEN nl >= 5 AND nr >= 5 AND hl >= 0.001 AND hr >= 0.001 AND v < top THEN
      round({strength("gl", "hl")} + {strength("gr", "hr")} - {strength("gl + gr", "hl + hr")}, 9) END AS gain
    FROM (SELECT feature, v, n, top, nl, total - nl AS nr, gl / 16777216 AS gl, (gs - gl) / 16777216 AS gr,
        hl / 16777216 AS hl, (hs - hl) / 16777216 AS hr
      FROM (SELECT feature, v, max(n) OVER all_ AS n, max(v) OVER all_ AS top, sum(rows) OVER up AS nl, sum(rows) OVER all_ AS total,
          sum(g) OVER up AS gl, sum(g) OVER all_ AS gs, sum(h) OVER up AS hl, sum(h) OVER all_ AS hs
        FROM (SELECT feature, v, count(*) AS rows, sum(round((p - y) * 16777216)) AS g, sum(round(p * (1 - p) * 16777216)) AS h,
            count(v) OVER (PARTITION BY feature) AS n
          FROM by_input, (SELECT avg({c.LABEL}) AS p FROM train) GROUP BY feature, v, p)
        WINDOW up AS (PARTITION BY feature ORDER BY v NULLS FIRST), all_ AS (PARTITION BY feature)))
    WHERE v IS NOT NULL)) WHERE k = 1 AND n <= 64
"""

#: What three given stumps add to the margin.
KNOWN_INPUTS = ["session_cnt_7d", "days_since_install", *c.CATEGORICAL_FEATURES]
KNOWN = """
known AS (SELECT *, CASE WHEN session_cnt_7d <= 2 THEN 0.5 ELSE -0.4 END AS a, CASE WHEN days_since_install <= 7 THEN -0.2 ELSE 0.3 END AS b,
    CASE WHEN coalesce((SELECT code FROM dictionary d WHERE d.feature = 'country' AND d.value = coalesce(s.country, '__NA__')), -1) <= 3
      THEN 0.25 ELSE -0.125 END AS d
  FROM store s WHERE milestone_day = 0 AND snapshot_date = date '2024-01-22')"""

AGE = """CASE WHEN days_since_install = 0 THEN 'D0' WHEN days_since_install <= 3 THEN 'D1-D3'
  WHEN days_since_install <= 7 THEN 'D4-D7' WHEN days_since_install <= 14 THEN 'D8-D14'
  WHEN days_since_install <= 30 THEN 'D15-D30' WHEN days_since_install <= 60 THEN 'D31-D60'
  ELSE 'D61+' END"""

OLD_REMOVERS = """
old AS (
  SELECT user_pseudo_id, min(install_date) AS idate, min(event_date) AS remove_date FROM flat
  WHERE event_name = 'app_remove' AND event_date BETWEEN date '2024-01-10' AND date '2024-01-30'
  GROUP BY user_pseudo_id HAVING min(install_date) < date '2024-01-08')"""


def segment(column: str, bins) -> str:
    cases = " ".join(
        f"WHEN {column} > {lo} AND {column} <= {hi} THEN '{name}'" for lo, hi, name in bins
    )
    return (
        f"SELECT '{column}' AS feature, CASE {cases} END AS segment, count(*) AS n,"
        " round(avg(label), 3) AS actual, round(avg(score), 3) AS pred"
        f" FROM scored WHERE model = 'gbt_a' AND (CASE {cases} END) IS NOT NULL GROUP BY 2"
    )


def predicted(columns: str) -> str:
    probs = ", ".join(f"{x} AS uninstall_prob_{k}" for k, x in SCORES.items())
    cte = f"""
predicted AS (
  SELECT *, CASE WHEN uninstall_prob >= 0.7 THEN 'very_high' WHEN uninstall_prob >= 0.5
      THEN 'high' WHEN uninstall_prob >= 0.3 THEN 'medium' ELSE 'low' END AS risk_segment
  FROM (SELECT snapshot_date AS prediction_date, user_pseudo_id, {probs},
          {SCORES['gbt_a']} AS uninstall_prob
        FROM store WHERE milestone_day = 0) t)"""
    return o.with_flat(columns, store(SCORE_INPUTS), cte)


def oracle_sql() -> dict[str, str]:
    flat = o.with_flat
    feature = o.feature_sql()
    milestones = ", ".join(f"({m})" for m in c.MILESTONES)
    cohort = o.cohort(FROM, TO)
    numeric = [x for part in feature.values() for x in part
               if x not in CATEGORIES and x not in ("has_attribution", "platform", c.LABEL)]
    inputs = numeric + CATEGORIES
    label = c.LABEL

    def anchored_on(first, last):
        return flat(
            f"""SELECT user_pseudo_id, install_date, milestone_day,
              install_date + milestone_day AS snapshot_date
            FROM cohort, (VALUES {milestones}) m(milestone_day)""", o.cohort(first, last))

    versions = """
versions AS (SELECT * EXCLUDE (label_uninstall_7d), 0 AS label_uninstall_7d, 1 AS version
    FROM store UNION ALL
  SELECT * EXCLUDE (label_uninstall_7d), label_uninstall_7d, 2 FROM store
    WHERE days_since_install >= 7),
newest AS (SELECT * FROM versions QUALIFY row_number() OVER (
  PARTITION BY snapshot_date, user_pseudo_id, milestone_day ORDER BY version DESC) = 1)"""

    out = {
        "flat_events": flat("SELECT * FROM flat"),
        "event_scan_window": flat(
            f"""SELECT user_pseudo_id, event_id, event_date, event_name FROM flat
            WHERE event_date >= date '{SNAPSHOT}' - 30 AND event_date < date '{SNAPSHOT}' + 7"""),
        "store_scan_latest": on_store(
            f"SELECT {KEYS}, version, {label}, session_cnt_7d, last_screen FROM newest",
            ["session_cnt_7d", "last_screen", "days_since_install"], versions),
        "store_project": on_store(f"SELECT {KEYS}, {', '.join(inputs)}, {label} FROM store",
                                  inputs),
        "write_features": on_store(
            f"SELECT {KEYS}, session_cnt_7d, country, {label} FROM store",
            ["session_cnt_7d", "country"]),
        "write_risk_baseline": on_store(
            "SELECT * FROM rates", DIMENSIONS, baseline("rates", "2024-01-22", 10)),
        "write_predictions": predicted("SELECT * FROM predicted"),
        "write_metrics": o.with_flat(
            "SELECT model, auc_roc, auc_pr, rank FROM ranked",
            *scored(), CONFUSION, RANKING, SELECTION),
        "table_schema": on_store(
            f"""SELECT {KEYS},
              CASE WHEN milestone_day > 0 THEN 0 ELSE minutes_since_install END
                AS minutes_since_install,
              CASE WHEN milestone_day > 0 THEN 0 ELSE seconds_since_install END
                AS seconds_since_install FROM store""",
            ["minutes_since_install", "seconds_since_install"]),

        "user_install_date": flat(
            "SELECT user_pseudo_id, min(install_date) AS install_date FROM flat GROUP BY 1"),
        "install_cohort": flat("SELECT * FROM cohort", o.cohort("2024-01-03", "2024-01-10")),
        "milestone_anchor": anchored_on(FROM, TO),
        "calendar_cohort": flat(
            f"""SELECT user_pseudo_id, min(install_date) AS install_date,
              date '{SNAPSHOT}' AS snapshot_date FROM flat
            WHERE event_date >= date '{SNAPSHOT}' - 30 AND event_date < date '{SNAPSHOT}' + 7
            GROUP BY 1 HAVING min(install_date) BETWEEN date '{SNAPSHOT}' - 30
              AND date '{SNAPSHOT}'"""),
        "exclude_already_churned": flat(
            """SELECT snapshot_date, user_pseudo_id, min(idate) AS install_date, milestone_day
            FROM anchored GROUP BY snapshot_date, user_pseudo_id, milestone_day
            HAVING count(*) FILTER (WHERE event_name = 'app_remove' AND d >= 1) = 0""",
            *o.milestone_events(FROM, TO)),
        "snapshot_dates": flat(
            """SELECT cast(unnest(generate_series(min(event_date), max(event_date),
              interval 7 days)) AS date) AS snapshot_date FROM flat"""),
        "label_complete_cohort": flat(
            f"""SELECT install_date, user_pseudo_id, milestone_day
            FROM cohort JOIN (VALUES {milestones}) m(milestone_day)
              ON install_date = date '2024-01-20' - milestone_day - 7""",
            o.cohort("2023-12-16", "2024-01-12")),
        "rolling_cohort": anchored_on("2023-12-23", "2024-01-20"),
        "default_cohort": anchored_on("2024-01-08", "2024-01-08"),

        "latest_value": milestone(
            ["media_source", "language", "notif_permission_status", "last_screen"]),
        "first_value": milestone(["first_screen", "first_button"]),
        "count_where_window": milestone(["iap_cnt_30d", "show_ad_cnt_7d"]),
        "distinct_days": milestone(["active_days_7d", "active_days_30d", "search_days_7d"]),
        "sum_where_window": milestone(
            ["engagement_time_ms_7d", "engagement_time_ms_30d", "ad_revenue_7d"]),
        "max_before": milestone(["days_since_install", "hours_since_install"]),
        "recency_hours": milestone(
            ["hours_since_last_session", "hours_since_last_click", "hours_since_last_ad"]),
        "ever_flag": milestone(["payer_flag", "visited_home"]),
        "both_flag": milestone(["home_to_search_flag", "lyrics_to_exit_flag"]),
        "funnel_depth": milestone(["funnel_depth"]),
        "safe_ratio": milestone(["ads_per_session_7d", "avg_sessions_per_day_7d"]),
        "trend_ratio": milestone(["session_trend_7d", "engagement_trend_7d"]),
        "vocab_counts": milestone(
            [*list(feature["h"])[:len(c.SCREENS)], *list(feature["i"])[:len(c.BUTTONS)]]),
        "label_within": milestone([label]),
        "unique_values": milestone(["unique_screen_cnt_7d", "unique_button_cnt_7d"]),
        "milestone_features": milestone(None, churned=True),
        "milestone_features_from_days": milestone(None, churned=True),
        "calendar_features": calendar(None, [SNAPSHOT]),
        "calendar_range": calendar(None, SNAPSHOTS),

        "sliding_features": calendar(None, [SNAPSHOT]),
        "stale_slices": """
            WITH wanted AS (
              SELECT m AS milestone_day, cast(install + m AS date) AS snapshot_date
              FROM (VALUES (1), (7), (14), (21), (28)) t(m), (SELECT unnest(range(date '2024-01-03', date '2024-01-11', INTERVAL 1 DAY))::date AS install)
              UNION ALL SELECT 0, unnest([date '2024-01-08', date '2024-01-15', date '2024-01-22'])
            ) SELECT cast(milestone_day AS integer) AS milestone_day, snapshot_date FROM wanted
            WHERE date '2024-01-14' BETWEEN snapshot_date - milestone_day - 30 AND snapshot_date + 6""",

        "slice_exists": on_store(
            """SELECT m.milestone_day, d.snapshot_date, s.n IS NOT NULL AS found,
              coalesce(s.unknown = 0, false) AS finished
            FROM (VALUES (0), (7), (28)) m(milestone_day)
            CROSS JOIN (VALUES (date '2024-01-05'), (date '2024-01-06'), (date '2024-01-07'),
              (date '2024-01-08'), (date '2024-02-11'), (date '2024-02-12')) d(snapshot_date)
            LEFT JOIN (SELECT milestone_day, snapshot_date, count(*) AS n,
                count(*) FILTER (WHERE label_uninstall_7d IS NULL) AS unknown
              FROM store GROUP BY ALL) s
              ON s.milestone_day = m.milestone_day AND s.snapshot_date = d.snapshot_date""", []),
        "slice_rows": on_store(
            "SELECT milestone_day, snapshot_date, count(*) AS n_rows FROM store GROUP BY ALL", []),
        "latest_version": on_store(
            f"""SELECT milestone_day, version, count(*) AS n_rows,
              cast(sum({label}) AS bigint) AS positive
            FROM newest GROUP BY ALL""", ["days_since_install"], versions),
        "replace_slice": on_store(
            f"""SELECT {KEYS}, {label}, session_cnt_30d FROM store
              WHERE NOT (milestone_day = 7 AND snapshot_date = date '2024-01-12')
                AND NOT (milestone_day = 1 AND snapshot_date = date '2024-01-09')
            UNION ALL SELECT {KEYS}, 1, session_cnt_30d FROM store
              WHERE milestone_day = 7 AND snapshot_date = date '2024-01-12'
                AND session_cnt_30d > 0""", ["session_cnt_30d"]),
        "build_report": on_store(
            f"""SELECT milestone_day, snapshot_date, count(*) AS n_rows,
              round(avg({label}), 6) AS label_rate FROM store GROUP BY ALL""", []),
        "store_update_from": on_store(
            f"SELECT {KEYS}, {rates(f'snapshot_date >= date {SNAPSHOT!r}')} FROM store s",
            DIMENSIONS, baseline("rates", "2024-01-22", 10)),

        "risk_baseline": on_store(
            "SELECT * FROM rates", DIMENSIONS, baseline("rates", "2024-01-22", 10)),
        "risk_baseline_closed": on_store(
            "SELECT * FROM rates", DIMENSIONS,
            "closed AS (SELECT * FROM store WHERE milestone_day > 0"
            " AND snapshot_date <= date '2024-01-22' - 7)",
            baseline("rates", "2024-01-22", 10).replace("FROM store", "FROM closed")),
        "apply_risk": on_store(
            f"SELECT {KEYS}, {', '.join(DIMENSIONS)}, {rates()} FROM store s",
            DIMENSIONS, baseline("rates", "2024-01-22", 10)),
        "known_risk": on_store(
            f"SELECT {KEYS}, {', '.join(DIMENSIONS)}, " + ", ".join(
                f"""coalesce((SELECT CASE WHEN count(*) >= 10 THEN round(avg({c.LABEL}), 4) END FROM store t
                  WHERE t.milestone_day > 0 AND t.{d} <> '' AND t.{d} = s.{d} AND t.snapshot_date + 7 <= s.snapshot_date), -1.0)
                  AS {d}_uninstall_rate""" for d in DIMENSIONS) + " FROM store s", DIMENSIONS),
        "merge_baseline": on_store(
            """SELECT * FROM (SELECT *, 1 AS updated_at FROM old_rates UNION ALL
              SELECT *, 2 FROM new_rates) t
            QUALIFY row_number() OVER (PARTITION BY dimension, value
              ORDER BY updated_at DESC) = 1""",
            DIMENSIONS, baseline("old_rates", "2024-01-22", 10),
            baseline("new_rates", "2024-01-12", 30)),

        "training_set": on_store(
            f"SELECT {KEYS}, session_cnt_7d, last_button, {label} FROM training",
            ["session_cnt_7d", "last_button"], TRAINING),
        "dataset_summary": on_store(
            f"""SELECT count(*) AS n_rows, count(DISTINCT snapshot_date) AS n_snapshots,
              round(avg({label}), 6) AS label_rate FROM training""", [], TRAINING),
        "last_snapshot_per_user": on_store(
            f"""SELECT {KEYS}, days_since_install, {label} FROM training
            QUALIFY row_number() OVER (PARTITION BY user_pseudo_id ORDER BY
              days_since_install DESC, snapshot_date DESC, milestone_day DESC) = 1""",
            ["days_since_install"], TRAINING),
        "time_split": on_store(
            f"""SELECT {KEYS}, 'train' AS part, {label} FROM train UNION ALL
            SELECT {KEYS}, 'valid', {label} FROM valid""", [], TRAINING, SPLIT),
        "fit_ordinal": on_store(
            "SELECT * FROM dictionary", CATEGORIES, TRAINING, SPLIT, dictionary("train")),
        "apply_ordinal": on_store(
            f"SELECT {KEYS}, " + ", ".join(
                f"coalesce((SELECT code FROM dictionary d WHERE d.feature = '{x}'"
                f" AND d.value = coalesce(v.{x}, '__NA__')), -1) AS {x}" for x in CATEGORIES
            ) + " FROM valid v", CATEGORIES, TRAINING, SPLIT, dictionary("train")),
        "stable_dictionary": on_store(
            """SELECT *, 0 AS version FROM dictionary UNION ALL
            SELECT n.feature, n.value, cast(coalesce(m.next, 0) + row_number() OVER (PARTITION BY n.feature ORDER BY n.value) - 1 AS integer), 1
            FROM later n LEFT JOIN (SELECT feature, max(code) + 1 AS next FROM dictionary GROUP BY 1) m USING (feature)
            WHERE NOT EXISTS (SELECT 1 FROM dictionary d WHERE d.feature = n.feature AND d.value = n.value)""",
            CATEGORIES, TRAINING, SPLIT, dictionary("train"), dictionary("valid").replace("dictionary AS", "later AS", 1)),
        "history_dictionary": on_store(
            "SELECT * FROM dictionary", CATEGORIES,
            f"history AS (SELECT * FROM store WHERE snapshot_date < date '{SNAPSHOT}')",
            dictionary("history")),
        "assemble": on_store(
            f"""SELECT {KEYS}, {len(inputs)} AS n_inputs,
              cast({inputs[0]} AS double) AS first_input,
              cast((SELECT code FROM dictionary d WHERE d.feature = '{inputs[-1]}'
                AND d.value = t.{inputs[-1]}) AS double) AS last_input FROM training t""",
            [inputs[0], *CATEGORIES], TRAINING, dictionary("training")),

        # A model with a possible split beats the label rate on its own train rows; the first
        # one needs two leaves of 200 drawn rows, the second one a Hessian of 50 in both.
        **{f"train_{m}": on_store(
            f"SELECT {KEYS}, {label}, true AS is_probability, (SELECT {able} FROM train) AS learns FROM valid", [], TRAINING, SPLIT)
           for m, able in (("gbt_a", "0.8 * count(*) >= 400"),
                           ("gbt_b", f"0.8 * count(*) * avg({label}) * (1 - avg({label})) >= 100"), ("gbt_c", "count(*) > 0"))},
        **{name: on_store(
            f"SELECT feature, CASE WHEN n <= 64 THEN n END AS distinct_values, true AS is_importance FROM counts",
            inputs, TRAINING, SPLIT, dictionary("train"), by_input("train", inputs),
            "counts AS (SELECT feature, cast(count(DISTINCT v) AS integer) AS n FROM by_input GROUP BY 1)")
           for name in ("feature_importance", "write_importance")},
        "split_gains": on_store(SPLIT_GAINS, inputs, TRAINING, SPLIT, dictionary("train"), by_input("train", inputs)),
        "ordered_statistics": on_store(
            f"SELECT {KEYS}, " + ", ".join(
                f"round((coalesce(sum({label}) OVER (PARTITION BY {x} ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 0.5)"
                f" / (count(*) OVER (PARTITION BY {x} ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1), 9) AS {x}"
                for x in CATEGORIES)
            + f" FROM (SELECT *, md5(concat_ws('|', '{c.SEED}', snapshot_date, user_pseudo_id, milestone_day)) AS place FROM train)",
            CATEGORIES, TRAINING, SPLIT),
        "category_statistics": on_store(
            f"SELECT {KEYS}, " + ", ".join(
                f"(SELECT round((coalesce(sum({label}), 0) + 0.5) / (count(*) + 1), 9) FROM train t"
                f" WHERE coalesce(t.{x}, '__NA__') = coalesce(v.{x}, '__NA__')) AS {x}" for x in CATEGORIES)
            + " FROM valid v", CATEGORIES, TRAINING, SPLIT),
        "model_rounds": on_store(
            f"""SELECT unnest({list(SCORES)}) AS model, count(*) AS n_valid, true AS stopped_in_time, true AS is_cut,
              true AS is_recorded FROM valid""", [], TRAINING, SPLIT),
        "score_known": on_store(
            """SELECT *, -1.0::double AS uninstall_prob_gbt_b,
              CASE WHEN uninstall_prob < 0.3 THEN 'low' WHEN uninstall_prob < 0.5 THEN 'medium'
                WHEN uninstall_prob < 0.7 THEN 'high' ELSE 'very_high' END AS risk_segment
            FROM (SELECT snapshot_date AS prediction_date, user_pseudo_id,
              round(1 / (1 + exp(1.0 - a - b - d)), 9)::double AS uninstall_prob FROM known)""",
            KNOWN_INPUTS, TRAINING, SPLIT, dictionary("train"), KNOWN),
        "contributions_known": on_store(
            f"""SELECT {KEYS}, round(-1.0 - 0.13 + 0.0 + 0.0625, 9)::double AS base, round(a + 0.13, 9)::double AS by_session_cnt_7d,
              round(b, 9)::double AS by_days_since_install, round(d - 0.0625, 9)::double AS by_country FROM known""",
            KNOWN_INPUTS, TRAINING, SPLIT, dictionary("train"), KNOWN),
        "importance_known": on_store(
            """SELECT unnest(['session_cnt_7d', 'days_since_install', 'country']) AS feature,
              unnest([round(avg(abs(a + 0.13)), 9), round(avg(abs(b)), 9), round(avg(abs(d - 0.0625)), 9)])::double AS importance FROM known""",
            KNOWN_INPUTS, TRAINING, SPLIT, dictionary("train"), KNOWN),
        "score": on_store(
            """SELECT snapshot_date AS prediction_date, user_pseudo_id, true AS are_probabilities,
              true AS is_primary, true AS is_segment FROM store
            WHERE milestone_day = 0 AND snapshot_date = date '2024-01-22'""", []),

        "choose_model": o.with_flat(
            "SELECT model, auc_pr FROM ranked WHERE rank = 1",
            *scored(), CONFUSION, RANKING, SELECTION),
        "risk_segment": predicted(
            "SELECT prediction_date, user_pseudo_id, uninstall_prob, risk_segment FROM predicted"),
        "segment_distribution": predicted(
            """SELECT coalesce(risk_segment, 'all') AS risk_segment, count(*) AS users,
              round(avg(CASE WHEN uninstall_prob >= 0.5 THEN 1.0::double ELSE 0.0::double END), 6)
                AS share_at_risk
            FROM predicted GROUP BY ROLLUP (risk_segment)"""),
        "mean_probability": predicted(
            "SELECT " + ", ".join(
                f"round(avg({x}), 6) AS mean_{x}" for x in
                [*(f"uninstall_prob_{k}" for k in SCORES), "uninstall_prob"]) + " FROM predicted"),

        "confusion_metrics": o.with_flat("SELECT * FROM confusion", *scored(), CONFUSION),
        "roc_auc": o.with_flat("SELECT * FROM auc", *scored(), RANKING),
        "average_precision": o.with_flat("SELECT * FROM ap", *scored(), RANKING),
        "model_selection": o.with_flat(
            "SELECT *, cast(rank = 1 AS integer) AS is_best FROM ranked",
            *scored(), CONFUSION, RANKING, SELECTION),
        "segment_analysis": o.with_flat(
            " UNION ALL ".join(segment(k, v) for k, v in c.SEGMENT_BINS.items()), *scored()),

        "event_name_search": flat(
            """SELECT event_name, count(*) AS n_events FROM flat
            WHERE lower(event_name) LIKE '%remove%' OR lower(event_name) LIKE '%uninstall%'
              OR lower(event_name) LIKE '%delete%' GROUP BY 1"""),
        "removal_totals": flat(
            """SELECT count(*) AS total_events, count(DISTINCT user_pseudo_id) AS unique_users
            FROM flat WHERE event_name = 'app_remove'"""),
        "rate_by_age_bucket": on_store(
            f"""SELECT {AGE} AS age_bucket, count(*) AS users,
              cast(sum({label}) AS bigint) AS uninstalled,
              round(avg({label}) * 100, 2) AS rate_pct, min(days_since_install) AS min_age
            FROM store WHERE snapshot_date < date '2024-01-26' GROUP BY 1""",
            ["days_since_install"]),
        "removal_offset_histogram": flat(
            f"""SELECT cast(event_date - date '{SNAPSHOT}' AS integer) AS days_from_snapshot,
              count(*) AS n_events,
              CASE WHEN event_date < date '{SNAPSHOT}' THEN 'before'
                WHEN event_date < date '{SNAPSHOT}' + 7 THEN 'label window'
                ELSE 'outside' END AS part
            FROM flat WHERE event_name = 'app_remove' AND event_date >= date '{SNAPSHOT}' - 30
              AND event_date < date '{SNAPSHOT}' + 14 GROUP BY ALL"""),
        "lifetime_churn": flat(
            """SELECT total_users, removed_users,
              round(removed_users * 100.0::double / total_users, 1) AS churn_pct
            FROM (SELECT count(DISTINCT user_pseudo_id) AS total_users,
                count(DISTINCT user_pseudo_id) FILTER (WHERE event_name = 'app_remove')
                  AS removed_users FROM flat) t"""),
        "rate_per_snapshot": on_store(
            f"""SELECT snapshot_date, count(*) AS users, cast(sum({label}) AS bigint)
              AS uninstalled, round(avg({label}) * 100, 2) AS rate_pct,
              round(avg(days_since_install)) AS avg_age FROM store GROUP BY 1""",
            ["days_since_install"]),
        "age_distribution_pct": on_store(
            f"""SELECT coalesce(bucket, 'TOTAL') AS bucket, count(*) AS n_rows,
              round(count(*) * 100.0::double / (SELECT count(*) FROM dated), 1) AS pct,
              cast(sum({label}) AS bigint) AS uninstalled,
              round(avg({label}) * 100, 2) AS rate_pct
            FROM dated GROUP BY ROLLUP (bucket)""", ["days_since_install"],
            f"dated AS (SELECT *, {AGE} AS bucket FROM store"
            " WHERE snapshot_date < date '2024-01-26')"),
        "install_date_distribution": flat(
            """SELECT install_date AS idate, count(*) AS n_events,
              count(DISTINCT user_pseudo_id) AS unique_users
            FROM flat WHERE install_date > date '2023-12-31' GROUP BY 1 ORDER BY 1 LIMIT 60"""),
        "snapshot_age_split": on_store(
            f"""SELECT snapshot_date, count(*) AS total,
              count(*) FILTER (WHERE days_since_install <= 7) AS d0_d7,
              count(*) FILTER (WHERE days_since_install <= 30) AS d0_d30,
              round(avg({label}) * 100, 2) AS overall_rate,
              round(avg({label}) FILTER (WHERE days_since_install <= 7) * 100, 2) AS d0_d7_rate,
              round(avg({label}) FILTER (WHERE days_since_install > 7) * 100, 2) AS d8plus_rate
            FROM store WHERE snapshot_date < date '2024-01-26' GROUP BY 1""",
            ["days_since_install"]),
        "weekly_removals": flat(
            """SELECT cast(date_trunc('week', event_date) AS date) AS week,
              count(*) AS remove_events, count(DISTINCT user_pseudo_id) AS unique_removers
            FROM flat WHERE event_name = 'app_remove' AND event_date >= date '2024-01-01'
            GROUP BY 1"""),
        "manual_label_rate": flat(
            f"""SELECT total_users, uninstallers,
              round(uninstallers * 100.0::double / total_users, 2) AS rate_pct
            FROM (SELECT count(DISTINCT user_pseudo_id) AS total_users,
                count(DISTINCT user_pseudo_id) FILTER (WHERE event_name = 'app_remove'
                  AND event_date >= date '{SNAPSHOT}' AND event_date < date '{SNAPSHOT}' + 7)
                  AS uninstallers
              FROM flat WHERE event_date >= date '{SNAPSHOT}' - 30
                AND event_date < date '{SNAPSHOT}' + 7
                AND install_date BETWEEN date '{SNAPSHOT}' - 30 AND date '{SNAPSHOT}') t"""),
        "old_user_age_at_start": flat(
            """SELECT CASE WHEN age < 90 THEN 'D0-D89' WHEN age < 180 THEN 'D90-D179'
                WHEN age < 365 THEN 'D180-D364' ELSE 'D365+' END AS age_bucket,
              count(*) AS users, min(idate) AS oldest_install, max(idate) AS newest_install,
              cast(min(age) AS integer) AS min_age
            FROM (SELECT *, date_diff('day', idate, date '2024-01-08') AS age FROM old) t
            GROUP BY 1""", OLD_REMOVERS),
        "old_user_recent_activity": flat(
            """SELECT count(*) AS total_users, count(*) FILTER (WHERE recent)
              AS with_recent_session,
              round(count(*) FILTER (WHERE recent) * 100.0::double / count(*), 1) AS pct
            FROM (SELECT EXISTS (SELECT 1 FROM flat f WHERE f.user_pseudo_id = old.user_pseudo_id
                AND f.event_name = 'session_start' AND f.event_date >= old.remove_date - 30
                AND f.event_date < old.remove_date) AS recent FROM old) t""", OLD_REMOVERS),
    }
    start = "event_name = 'session_start'"
    out["distinct_where_window"] = flat(
        f"""SELECT {o.KEYS}, {", ".join(
            f"{feature['e'][f'session_cnt_{w}d']} AS session_cnt_{w}d" for w in (1, 3, 7, 14, 30))},
          {o.distinct('unique_session_id', start, 14, 8)} AS session_cnt_prev
        FROM anchored GROUP BY snapshot_date, user_pseudo_id, milestone_day""",
        *o.milestone_events(FROM, TO))
    for name in c.SECTIONS:
        out[f"features_milestone_{name}"] = milestone(list(feature[name]), churned=True)
        out[f"features_calendar_{name}"] = calendar(list(feature[name]), SNAPSHOTS)
    return out
