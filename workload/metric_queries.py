"""Evaluation, risk bands, rules and sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from gearwatch.functions.columns import fixed, once
from gearwatch.operators import insights, metrics, scoring
from workload.registry import query
from workload.views import LOG_SQL, REQUESTS_SQL, SCORED_SQL, events_log, r6, requests, rounded, scored_events, table

CELLS_SQL = """cells AS (SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM scored)"""
RATES = """coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS prec"""
RATES_SQL = f"""rates AS (SELECT *, {RATES} FROM cells)"""
F1 = "coalesce(2 * prec * recall / nullif(prec + recall, 0), 0)"


def _auc_sql(source: str) -> str:
    """Mann-Whitney by average ranks."""
    return f"""(SELECT coalesce((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1)
      * (count(*) FILTER (label = 1) + 1) / 2.0::DOUBLE)
      / nullif(count(*) FILTER (label = 1) * count(*) FILTER (label = 0), 0)::DOUBLE, 0)
      FROM (SELECT label, rank() OVER (ORDER BY probability)
        + (count(*) OVER (PARTITION BY probability) - 1) / 2.0::DOUBLE AS r FROM {source}))"""


@query("agg_confusion", f"WITH {SCORED_SQL}, {CELLS_SQL} SELECT * FROM cells")
def _(spark, d):
    return metrics.confusion_matrix(scored_events(spark, d))


@query(
    "agg_rates",
    f"""WITH {SCORED_SQL}, {CELLS_SQL}, {RATES_SQL} SELECT tn, fp, fn, tp, {r6('recall')} AS recall,
      {r6('prec')} AS precision, {r6(F1)} AS f1 FROM rates""",
)
def _(spark, d):
    rates = metrics.classification_metrics(metrics.confusion_matrix(scored_events(spark, d)))
    return rounded(rates, ["tn", "fp", "fn", "tp"], ["recall", "precision", "f1"])


@query("agg_auc", f"WITH {SCORED_SQL} SELECT {r6(_auc_sql('scored'))} AS roc_auc")
def _(spark, d):
    return rounded(metrics.roc_auc(scored_events(spark, d)), [], ["roc_auc"])


@query(
    "agg_auc_ties",
    f"""WITH scored AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_quantity / 50 AS probability
      FROM lineitem) SELECT {r6(_auc_sql('scored'))} AS roc_auc""",
)
def _(spark, d):
    scored = table(spark, d, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        (F.col("l_quantity") / 50).alias("probability"),
    )
    return rounded(metrics.roc_auc(scored), [], ["roc_auc"])


@query(
    "agg_auc_missing",
    f"""WITH {SCORED_SQL} SELECT CASE WHEN count(*) FILTER (probability IS NULL) > 0 THEN 0::DOUBLE END AS roc_auc
    FROM (SELECT CASE WHEN row_id % 10 <> 3 THEN probability END AS probability FROM scored)""",
)
def _(spark, d):
    """An area cannot be had while scores are missing: 0, as with one class only."""
    scored = scored_events(spark, d).withColumn("probability", F.when(F.col("row_id") % 10 != 3, F.col("probability")))
    return rounded(metrics.roc_auc(scored), [], ["roc_auc"])


@query(
    "agg_confusion_missing",
    f"""WITH {SCORED_SQL}, known AS (SELECT CASE WHEN row_id % 7 <> 2 THEN label END AS label,
      coalesce(CASE WHEN row_id % 5 <> 1 THEN prediction END, 0) AS prediction FROM scored)
    SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
      count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM known""",
)
def _(spark, d):
    """Rows without a label are left out; a missing prediction claims no failure."""
    some = scored_events(spark, d).select(
        F.when(F.col("row_id") % 7 != 2, F.col("label")).alias("label"),
        F.when(F.col("row_id") % 5 != 1, F.col("prediction")).alias("prediction"),
    )
    return metrics.confusion_matrix(some)


@query(
    "agg_auc_labels",
    f"""WITH scored AS (SELECT quality AS label, n_chars / 20000.0::DOUBLE AS probability
      FROM labels JOIN documents USING (doc_id)) SELECT {r6(_auc_sql('scored'))} AS roc_auc""",
)
def _(spark, d):
    scored = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    scored = scored.select(F.col("quality").alias("label"), (F.col("n_chars") / F.lit(20000.0)).alias("probability"))
    return rounded(metrics.roc_auc(scored), [], ["roc_auc"])


@query(
    "agg_class_report",
    f"""WITH {SCORED_SQL}, {CELLS_SQL}, two AS (
      SELECT '0' AS class, coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) AS p, coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS r,
        tn + fp AS support FROM cells
      UNION ALL SELECT '1', coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), tp + fn FROM cells),
    scores AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM two),
    acc AS (SELECT (tn + tp) / (tn + fp + fn + tp)::DOUBLE AS a, tn + fp + fn + tp AS n FROM cells)
    SELECT class, {r6('p')} AS precision, {r6('r')} AS recall, {r6('f')} AS f1, support FROM scores
    UNION ALL SELECT 'accuracy', {r6('a')}, {r6('a')}, {r6('a')}, n FROM acc
    UNION ALL SELECT 'macro avg', {r6('avg(p)')}, {r6('avg(r)')}, {r6('avg(f)')}, CAST(sum(support) AS BIGINT) FROM scores
    UNION ALL SELECT 'weighted avg', {r6('sum(p * support) / sum(support)')}, {r6('sum(r * support) / sum(support)')},
      {r6('sum(f * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM scores""",
)
def _(spark, d):
    report = metrics.per_class_report(scored_events(spark, d))
    return rounded(report, ["class", "support"], ["precision", "recall", "f1"])


@query(
    "agg_risk_hist",
    f"""WITH {SCORED_SQL}, b AS (SELECT unnest(['HIGH', 'MEDIUM', 'LOW']) AS risk_level),
    c AS (SELECT CASE WHEN probability > 0.7 THEN 'HIGH' WHEN probability > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
      count(*) AS n FROM scored GROUP BY 1)
    SELECT risk_level, coalesce(n, 0) AS row_count,
      {r6('coalesce(n, 0) * 100.0::DOUBLE / (SELECT count(*) FROM scored)')} AS percent FROM b LEFT JOIN c USING (risk_level)""",
)
def _(spark, d):
    return rounded(metrics.risk_histogram(scored_events(spark, d)), ["risk_level", "row_count"], ["percent"])


@query(
    "agg_threshold_counts",
    f"""WITH {SCORED_SQL} SELECT count(*) FILTER (probability > 0.5 AND label = 1) AS true_positives,
      count(*) FILTER (probability > 0.5 AND label = 0) AS false_positives,
      count(*) FILTER (probability <= 0.5 AND label = 1) AS false_negatives FROM scored""",
)
def _(spark, d):
    return metrics.threshold_counts(scored_events(spark, d))


# Simple predictors to compare: three cut-offs on the same score.
CUTOFFS = {"cautious": 0.1, "even": 0.3, "bold": 0.6}


def _cut_sql(name: str, cutoff: float) -> str:
    cells = " ".join(
        f"count(*) FILTER (label = {y} AND (probability > {cutoff}) = {p}) AS {c},"
        for c, y, p in (("tn", 0, "false"), ("fp", 0, "true"), ("fn", 1, "false"), ("tp", 1, "true"))
    )
    return f"SELECT '{name}' AS model, {cells[:-1]} FROM scored"


_CELLS_PER_MODEL = " UNION ALL ".join(_cut_sql(n, c) for n, c in CUTOFFS.items())


def compared(spark, d):
    scored = scored_events(spark, d)
    results = [
        metrics.evaluate(scored.withColumn("prediction", F.when(F.col("probability") > c, 1).otherwise(0)), name)
        for name, c in CUTOFFS.items()
    ]
    return metrics.compare_models(results, "recall")


@query(
    "srt_compare_models",
    f"""WITH {SCORED_SQL}, cells AS ({_CELLS_PER_MODEL}), {RATES_SQL}
    SELECT model, {r6('recall')} AS recall, {r6('prec')} AS precision, {r6(F1)} AS f1,
      {r6(_auc_sql('scored'))} AS roc_auc FROM rates ORDER BY recall DESC, model""",
)
def _(spark, d):
    return rounded(compared(spark, d), ["model"], ["recall", "precision", "f1", "roc_auc"])


@query(
    "srt_top_risks",
    f"""WITH {SCORED_SQL} SELECT row_id, probability, row_number() OVER (ORDER BY probability DESC, row_id) AS place
    FROM scored ORDER BY probability DESC, row_id LIMIT 5""",
)
def _(spark, d):
    top = insights.high_risk_rows(scored_events(spark, d).select("row_id", "probability"), ["row_id"], 5)
    return top.withColumn("place", F.col("place").cast("long"))


@query(
    "prj_risk_band",
    f"""WITH {SCORED_SQL} SELECT row_id,
      CASE WHEN probability > 0.7 THEN 'HIGH' WHEN probability > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS report_band,
      CASE WHEN probability >= 0.7 THEN 'HIGH' WHEN probability >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS scorer_band
    FROM scored""",
)
def _(spark, d):
    p = F.col("probability")
    return scored_events(spark, d).select(
        "row_id", metrics.risk_band(p).alias("report_band"), metrics.risk_band(p, True).alias("scorer_band")
    )


# --- requests -----------------------------------------------------------------------------------


@query(
    "prj_request_validation",
    f"""WITH {REQUESTS_SQL} SELECT request_id, machine_id, temperature, pressure, vibration, reason FROM requests
      WHERE reason IS NULL
    UNION ALL SELECT request_id, NULL, NULL, NULL, NULL, reason FROM requests WHERE reason IS NOT NULL""",
)
def _(spark, d):
    parsed = scoring.parse_requests(requests(spark, d), "body")
    good = F.col("reason").isNull()
    return parsed.select(
        "request_id", *[F.when(good, F.col(c)).alias(c) for c in ("machine_id", *scoring.READINGS)], "reason"
    )


@query(
    "prj_request_numbers",
    """SELECT event_id AS request_id, CASE WHEN event_id % 4 IN (0, 3) THEN value END AS temperature,
      CASE event_id % 4 WHEN 1 THEN 'temperature is not numeric' WHEN 2 THEN 'pressure is not numeric' END AS reason
    FROM events""",
)
def _(spark, d):
    """Numbers in texts count, numbers with a letter behind them do not."""
    kind = F.col("event_id") % 4
    body = F.concat(
        F.lit('{"machine_id": "m", "temperature": "'), F.col("value").cast("string"), F.when(kind == 1, "d").otherwise(""),
        F.lit('", "pressure": "1'), F.when(kind == 2, "f").when(kind == 3, ".5e0 ").otherwise(""),
        F.lit('", "vibration": 0}'),
    )
    parsed = scoring.parse_requests(table(spark, d, "events").select(F.col("event_id").alias("request_id"), body.alias("body")), "body")
    good = F.col("reason").isNull()
    return parsed.select("request_id", F.when(good, F.col("temperature")).alias("temperature"), "reason")


class _Proxy:
    """Stands in for a fitted model: the probability comes from the temperature."""

    kind, features = "boosted", ["temperature"]

    @staticmethod
    def predict(df):
        return df.withColumn("probability", F.least(F.col("temperature") / F.lit(100.0), F.lit(1.0)))


@query(
    "sco_no_explainer",
    f"""WITH {REQUESTS_SQL}, p AS (SELECT *, least(temperature / 100.0::DOUBLE, 1.0::DOUBLE) AS p,
      [CASE WHEN temperature > 80 THEN 'High temperature' ELSE 'Temperature within range' END,
        CASE WHEN abs(pressure - 1.0::DOUBLE) > 0.5 THEN 'Pressure instability' ELSE 'Pressure stable' END,
        CASE WHEN vibration > 0.015 THEN 'Vibration trend' ELSE 'Vibration normal' END] AS states
      FROM requests WHERE reason IS NULL)
    SELECT request_id, {r6('p')} AS failure_probability,
      CASE WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
      array_to_string(CASE WHEN p > 0.5 THEN states ELSE [] END, '; ') AS factors FROM p""",
)
def _(spark, d):
    """Scores without explanations: state labels of likely failures only."""
    valid = scoring.valid_requests(scoring.parse_requests(requests(spark, d), "body"))
    scored = scoring.score_requests(valid, _Proxy(), explain=False)
    return scored.select(
        "request_id", fixed(F.col("failure_probability")).alias("failure_probability"), "risk_level",
        F.array_join("top_risk_factors", "; ").alias("factors"),
    )


REQUEST_FEATURES = [
    "temperature", "pressure", "vibration", "temperature_lag_1", "pressure_rolling_mean_1h", "vibration_ema_0.3",
    "rpm_lag_1", "mean_temperature",
]


@query(
    "prj_request_features",
    f"""WITH {REQUESTS_SQL} SELECT request_id, temperature, pressure, vibration, temperature AS temperature_lag_1,
      pressure AS pressure_rolling_mean_1h, vibration AS "vibration_ema_0.3", 0::DOUBLE AS rpm_lag_1,
      0::DOUBLE AS mean_temperature FROM requests WHERE reason IS NULL""",
)
def _(spark, d):
    valid = scoring.valid_requests(scoring.parse_requests(requests(spark, d), "body"))
    return scoring.request_features(valid.select("request_id", *scoring.READINGS), REQUEST_FEATURES)


@query(
    "sco_rules",
    f"""WITH {REQUESTS_SQL}, p AS (SELECT *, least(temperature / 100.0::DOUBLE, 1.0::DOUBLE) AS p,
      list_filter([CASE WHEN temperature > 80 THEN 'High temperature' END,
        CASE WHEN pressure > 1.5 THEN 'Elevated pressure' END,
        CASE WHEN vibration > 0.015 THEN 'High vibration' END], lambda x: x IS NOT NULL) AS fired,
      [CASE WHEN temperature > 80 THEN 'High temperature' ELSE 'Temperature within range' END,
        CASE WHEN abs(pressure - 1.0::DOUBLE) > 0.5 THEN 'Pressure instability' ELSE 'Pressure stable' END,
        CASE WHEN vibration > 0.015 THEN 'Vibration trend' ELSE 'Vibration normal' END] AS states
      FROM requests WHERE reason IS NULL)
    SELECT request_id, CASE WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
      array_to_string(CASE WHEN len(fired) > 0 THEN fired WHEN p > 0.5 THEN states ELSE [] END, '; ') AS factors FROM p""",
)
def _(spark, d):
    valid = scoring.valid_requests(scoring.parse_requests(requests(spark, d), "body"))
    p = F.least(F.col("temperature") / F.lit(100.0), F.lit(1.0))
    return valid.select(
        "request_id",
        metrics.risk_band(p, inclusive=True).alias("risk_level"),
        F.array_join(scoring.rule_factors(p), "; ").alias("factors"),
    )


# --- sentences ------------------------------------------------------------------------------------

# Feature names as event types have them: every kind of name occurs.
FEATURE_OF = {
    "error": "temperature_lag_2",
    "click": "Pressure_rolling_mean_4h",
    "view": "vibration_rolling_std_8h",
    "signup": "rpm_ema_0.3",
    "purchase": "torque",
}
PARSED = {
    "error": ("temperature", "lag", "2 time step(s) ago", "Temperature from 2 time step(s) ago", "value"),
    "click": ("pressure", "rolling_mean", "4h", "Pressure average over 4h", "mean"),
    "view": ("vibration", "rolling_std", "8h", "Vibration variability over 8h", "std"),
    "signup": ("rpm", "ema", "EMA (alpha=0.3)", "Rpm trend (EMA (alpha=0.3))", "value"),
    "purchase": ("unknown", "raw", "current", "Unknown", "value"),
}


def _case(pick) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{pick(e)}'" for e in PARSED) + " END"


@query(
    "exp_sentences",
    f"""WITH t AS (SELECT event_id AS row_id, value, value - 50 AS a, {_case(lambda e: FEATURE_OF[e])} AS feature,
      {_case(lambda e: PARSED[e][0])} AS sensor, {_case(lambda e: PARSED[e][1])} AS operation,
      {_case(lambda e: PARSED[e][2])} AS time_window, {_case(lambda e: PARSED[e][3])} AS lead_in,
      {_case(lambda e: PARSED[e][4])} AS number FROM events)
    SELECT row_id, feature, sensor, operation, time_window, lead_in || ' '
      || CASE WHEN a > 0 THEN 'increased' ELSE 'decreased' END || ' failure risk (' || number || ': '
      || printf('%.2f', value) || CASE WHEN feature <> 'rpm_ema_0.3' THEN '' WHEN value < 10 THEN
        ' (below safe minimum of 10.0)' WHEN value > 80 THEN ' (exceeding safe maximum of 80.0)' ELSE '' END || ')'
      AS explanation FROM t""",
)
def _(spark, d):
    feature = F.lit(None).cast("string")
    for event, name in FEATURE_OF.items():
        feature = F.when(F.col("event_type") == event, name).otherwise(feature)
    rows = table(spark, d, "events").select(
        F.col("event_id").alias("row_id"), feature.alias("feature"), "value", (F.col("value") - 50).alias("attribution")
    )
    texts = insights.feature_sentences(rows, {"rpm_ema_0.3": {"min": 10.0, "max": 80.0}})
    return texts.select("row_id", "feature", "sensor", "operation", "time_window", "explanation")


PROXY = ["temperature", "pressure_lag_1", "vibration_rolling_mean_1h", "rpm_ema_0.5"]


def _attributed(spark, d):
    """Stand-in attributions from the readings themselves, so that SQL can follow."""
    v, k = F.col("value"), F.col("k")
    rows = events_log(spark, d).select(
        F.col("seq").alias("row_id"),
        F.least(v / F.lit(200.0), F.lit(1.0)).alias("probability"),
        F.col("failure").cast("int").alias("label"),
        F.array(v, k, v + k, v - k).alias("values"),
        F.array(v - 50, (k - 50) * 0.5, (v - k) * 0.25, F.lit(20.0) - v).alias("attributions"),
        F.lit(0.0).alias("base"),
    )
    return once(rows, "attributions", F.col("attributions"))


_ATTRIBUTED_SQL = f"""{LOG_SQL}, wide AS (SELECT seq AS row_id, value, k, failure, least(value / 200.0::DOUBLE, 1.0::DOUBLE) AS p FROM log),
  items AS (
    SELECT row_id, p, 0 AS i, 'temperature' AS feature, value AS v, value - 50 AS a, 'Temperature' AS lead_in, 'value' AS number FROM wide
    UNION ALL SELECT row_id, p, 1, 'pressure_lag_1', k, (k - 50) * 0.5::DOUBLE, 'Pressure from 1 time step(s) ago', 'value' FROM wide
    UNION ALL SELECT row_id, p, 2, 'vibration_rolling_mean_1h', value + k, (value - k) * 0.25::DOUBLE, 'Vibration average over 1h', 'mean' FROM wide
    UNION ALL SELECT row_id, p, 3, 'rpm_ema_0.5', value - k, 20.0::DOUBLE - value, 'Rpm trend (EMA (alpha=0.5))', 'value' FROM wide),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY abs(a) DESC, i DESC) AS place FROM items)"""


@query(
    "exp_top_features",
    f"WITH {_ATTRIBUTED_SQL} SELECT row_id, place, feature, {r6('v')} AS value, {r6('a')} AS attribution FROM ranked WHERE place <= 3",
)
def _(spark, d):
    from gearwatch.operators.insights import with_explanations

    made = with_explanations(_attributed(spark, d), PROXY, top_n=3)
    top = made.select("row_id", F.posexplode("top_features").alias("place", "f"))
    return top.select(
        "row_id", (F.col("place") + 1).cast("long").alias("place"), F.col("f.feature").alias("feature"),
        fixed(F.col("f.value")).alias("value"), fixed(F.col("f.shap_value")).alias("attribution"),
    )


@query(
    "exp_explanations",
    f"""WITH {_ATTRIBUTED_SQL}
    SELECT row_id, CASE WHEN p > 0.7 THEN 'HIGH' WHEN p > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
      count(*) FILTER (a > 0) AS positive_count, count(*) FILTER (a <= 0) AS negative_count,
      coalesce(string_agg(feature, ',' ORDER BY place) FILTER (a > 0), '') AS positive_features,
      coalesce(string_agg(feature, ',' ORDER BY place) FILTER (a <= 0), '') AS negative_features
    FROM ranked WHERE place <= 3 GROUP BY row_id, p""",
)
def _(spark, d):
    made = insights.with_explanations(_attributed(spark, d), PROXY, top_n=3)
    names = lambda c: F.array_join(F.transform(c, lambda f: f["feature"]), ",")
    return made.select(
        "row_id",
        "risk_level",
        F.size("positive_factors").cast("long").alias("positive_count"),
        F.size("negative_factors").cast("long").alias("negative_count"),
        names("positive_factors").alias("positive_features"),
        names("negative_factors").alias("negative_features"),
    )


@query(
    "exp_importance",
    f"WITH {_ATTRIBUTED_SQL} SELECT feature, {r6('avg(abs(a))')} AS importance FROM items GROUP BY 1 ORDER BY 2 DESC",
)
def _(spark, d):
    from gearwatch.operators.attribution import attribution_importance

    return rounded(attribution_importance(_attributed(spark, d), PROXY), ["feature"], ["importance"])


@query(
    "exp_summary_proxy",
    f"""WITH {_ATTRIBUTED_SQL}, top AS (SELECT feature, avg(abs(a)) AS importance FROM items GROUP BY 1 ORDER BY 2 DESC LIMIT 2)
    SELECT row_id, feature, {r6('v')} AS value, {r6('a')} AS attribution, {r6('importance')} AS importance
    FROM items JOIN top USING (feature)""",
)
def _(spark, d):
    """Points of the two most important features."""
    from gearwatch.operators.attribution import summary_points

    points = summary_points(_attributed(spark, d), PROXY, ["row_id"], 2)
    return rounded(points, ["row_id", "feature"], ["value", "attribution", "importance"])


@query(
    "set_absent_features",
    f"""WITH {LOG_SQL} SELECT unnest(['k_ema_0.3', 'pressure', 'value_lag_1']) AS feature, count(*) AS rows_filled FROM log""",
)
def _(spark, d):
    """Features a model wants and the log lacks, with the rows that get 0 for them."""
    from gearwatch.operators.models import missing_features

    log = events_log(spark, d)
    absent = missing_features(log, ["value", "k", "pressure", "value_lag_1", "k_ema_0.3"])
    return log.agg(F.count("*").alias("rows_filled")).select(F.explode(F.array(*map(F.lit, absent))).alias("feature"), "rows_filled")


@query(
    "exp_long_attributions",
    f"WITH {_ATTRIBUTED_SQL} SELECT row_id, feature, {r6('v')} AS value, {r6('a')} AS attribution FROM items",
)
def _(spark, d):
    from gearwatch.operators.attribution import long_attributions

    return rounded(long_attributions(_attributed(spark, d), PROXY, ["row_id"]), ["row_id", "feature"], ["value", "attribution"])


@query(
    "exp_waterfall",
    f"""WITH {_ATTRIBUTED_SQL} SELECT row_id, place - 1 AS position, feature, {r6('a')} AS attribution,
      {r6('sum(a) OVER (PARTITION BY row_id ORDER BY place)')} AS score_after FROM ranked""",
)
def _(spark, d):
    from gearwatch.operators.attribution import waterfall_points

    points = waterfall_points(_attributed(spark, d), PROXY, ["row_id"]).withColumn("position", F.col("position").cast("long"))
    return rounded(points, ["row_id", "position", "feature"], ["attribution", "score_after"])


@query(
    "exp_dependence",
    f"WITH {_ATTRIBUTED_SQL} SELECT row_id, feature, {r6('v')} AS value, {r6('a')} AS attribution FROM items WHERE i = 2",
)
def _(spark, d):
    from gearwatch.operators.attribution import dependence_points

    points = dependence_points(_attributed(spark, d), PROXY, PROXY[2], ["row_id"])
    return rounded(points, ["row_id", "feature"], ["value", "attribution"])
