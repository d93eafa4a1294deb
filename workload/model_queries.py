"""Training, attributions, explanations and scoring with fitted models.

SQL cannot fit these models, so most queries have no SQL twin; the tests prove them.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gearwatch.functions.columns import fixed
from gearwatch.operators import attribution, insights, model_tables, models, scoring
from gearwatch.operators.features import feature_pipeline
from gearwatch.operators.metrics import compare_models, evaluate, per_class_report
from gearwatch.operators.models import FailureModel
from gearwatch.operators.search import search
from gearwatch.operators.split import time_based_split
from gearwatch.plans.explanation_job import explain
from gearwatch.plans.training_job import prepare_features, train_all_models
from gearwatch.session import fresh_path, written
from gearwatch.sources import artifacts
from gearwatch.streaming.scorer import score_stream
from gearwatch.options import SEED
from workload.log_queries import (
    _RANK,
    EMA_COLUMNS,
    EMA_NAMES,
    EMA_SQL,
    LAG_COLUMNS,
    LAG_NAMES,
    ROLL_COLUMNS,
    ROLL_NAMES,
    TARGET_SQL,
    WINDOWS,
)
from workload.metric_queries import CELLS_SQL, F1, RATES_SQL, _auc_sql
from workload.registry import query
from workload.views import EVENTS, LOG_SQL, REQUESTS_SQL, SENSORS, events_log, r6, requests, rounded, table

# Small ensembles, openly: the default ones (100 trees of depth 30, 100 rounds of depth 6) did not
# fit within 15 minutes at sf0.01 on 8 shared cores. The jobs and the library's defaults are whole.
FOREST = {"numTrees": 10, "maxDepth": 5}
BOOSTED = {"maxIter": 10, "maxDepth": 4}
KEYS = ["machine_id", "timestamp", "seq"]

_sets: dict[tuple[str, str], tuple] = {}
_fitted: dict[tuple[str, str, str], FailureModel] = {}


def prepared(spark, d):
    """Training set and held-out rows of the whole log, made once per session and scale."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _sets:
        # The table feeds the threshold and both sets: written once.
        made = written(feature_pipeline(events_log(spark, d), EVENTS), "features")
        train, test = time_based_split(made, EVENTS)
        _sets[key] = (train, test, *prepare_features(train, test, EVENTS))
    return _sets[key]


def fitted(spark, d, kind: str) -> FailureModel:
    key = (spark.sparkContext.applicationId, d, kind)
    if key not in _fitted:
        data = prepared(spark, d)[2]
        fit = {
            "baseline": lambda: models.train_baseline(data),
            "random_forest": lambda: models.train_random_forest(data, **FOREST),
            "boosted": lambda: models.train_boosted(data, **BOOSTED),
        }
        _fitted[key] = fit[kind]()
    return _fitted[key]


MODEL_NAMES = SENSORS + LAG_NAMES + ROLL_NAMES + EMA_NAMES
MODEL_SQL = f"""WITH RECURSIVE {LOG_SQL}, edge AS ({_RANK}), {EMA_SQL}, {TARGET_SQL},
  made AS (SELECT us, seq, machine_id, failure_within_24h, value, k, {LAG_COLUMNS}, {ROLL_COLUMNS}
    FROM labelled WINDOW {WINDOWS}),
  whole AS (SELECT made.*, {EMA_COLUMNS} FROM made JOIN ema USING (seq, machine_id))
  SELECT seq, machine_id, CAST(failure_within_24h AS DOUBLE) AS label,
    {", ".join(f"coalesce({n.replace('.', '_')}, 0) AS {n.replace('.', '_')}" for n in MODEL_NAMES)}
  FROM whole WHERE us < (SELECT us FROM edge)"""


@query("prj_model_features", MODEL_SQL)
def _(spark, d):
    """What the models learn from: the training side, nulls as 0."""
    return rounded(prepared(spark, d)[2].df, ["seq", "machine_id", "label"], MODEL_NAMES)


def _model_queries(kind):
    @query(f"mlm_predict_{kind}")
    def _(spark, d):
        return fitted(spark, d, kind).predict(prepared(spark, d)[3]).select(*KEYS, "label", "prediction", "probability")

    @query(f"mlm_evaluate_{kind}")
    def _(spark, d):
        scored = fitted(spark, d, kind).predict(prepared(spark, d)[3])
        return evaluate(scored.select("label", "prediction", "probability"), kind)


for _kind in models.KINDS:
    _model_queries(_kind)


@query("mlm_class_report")
def _(spark, d):
    return per_class_report(fitted(spark, d, "boosted").predict(prepared(spark, d)[3]))


@query("mlm_gain_importance")
def _(spark, d):
    return models.feature_importance(spark, fitted(spark, d, "boosted"))


@query("srt_top_importance")
def _(spark, d):
    return models.feature_importance(spark, fitted(spark, d, "boosted")).limit(20)


SEARCHED = {"random_forest": {"numTrees": [5, 10], "maxDepth": [3, 5], "positive_weight": ["balanced", 10.0]},
            "boosted": {"maxIter": [3, 5], "stepSize": [0.1, 0.2], "positive_weight": [0.5, 1.0]}}


def _search_query(kind):
    @query(f"mlm_search_{kind}")
    def _(spark, d):
        """Two settings, two folds: the score of each setting on the whole training set.

        The default grids with 20 and 50 draws and 5 folds fit 100 forests and 250 boosted models,
        hours in one local session; ``training_job`` runs them.
        """
        _, scores = search(kind, prepared(spark, d)[2], KEYS, SEARCHED[kind], draws=2, folds=2)
        rows = [(str(sorted(s.items())), f1) for s, f1 in scores]
        return spark.createDataFrame(rows, "setting string, f1 double")


for _kind in SEARCHED:
    _search_query(_kind)


@query("mlm_train_all")
def _(spark, d):
    train, test = prepared(spark, d)[:2]
    """All models, the tree models by search over the settings of ``SEARCHED``, saved and read back."""
    base = fresh_path(spark, "trained")
    settings = {kind: {"grid": grid, "draws": 2, "folds": 2} for kind, grid in SEARCHED.items()}
    result = train_all_models(train, test, EVENTS, base, search_args=settings)
    found = [
        models.load_model(spark, kind, base=base)[0].predict(prepared(spark, d)[3]).select("label", "prediction", "probability")
        for kind in models.KINDS
    ]
    again = [evaluate(written(df, "scored"), kind) for df, kind in zip(found, models.KINDS)]
    return compare_models(again).join(result.comparison, ["model", "recall", "precision", "f1", "roc_auc"])


@query("src_model_roundtrip")
def _(spark, d):
    """Predictions of a model that was saved and found again as the newest."""
    base = fresh_path(spark, "models")
    fitted(spark, d, "boosted").save(f"{base}/models_20240101_000000/boosted")
    model, _ = models.load_model(spark, "boosted", base=base)
    return model.predict(prepared(spark, d)[3]).select(*KEYS, "probability")


def attributed(spark, d, kind="boosted"):
    model = fitted(spark, d, kind)
    return attribution.with_attributions(model.predict(prepared(spark, d)[3]), model)


def _attribution_queries(kind):
    @query(f"exp_attributions_{kind}")
    def _(spark, d):
        return attribution.long_attributions(attributed(spark, d, kind), fitted(spark, d, kind).features, KEYS)

    @query(f"exp_additivity_{kind}")
    def _(spark, d):
        return attribution.additivity(attributed(spark, d, kind), fitted(spark, d, kind))


for _kind in ("boosted", "random_forest"):
    _attribution_queries(_kind)


@query("exp_global_sample")
def _(spark, d):
    """Importance on a seeded sample of 100 rows, as a cached result."""
    model = fitted(spark, d, "boosted")
    sample = attribution.background_sample(prepared(spark, d)[3], KEYS, 100)
    found = artifacts.cached(
        spark, fresh_path(spark, "attributions"), "v1", "background",
        lambda: attribution.with_attributions(sample, model).select(*KEYS, "values", "attributions", "base"),
    )
    return attribution.attribution_importance(found, model.features)


@query(
    "srt_background_sample",
    f"""WITH {LOG_SQL} SELECT machine_id, us AS timestamp, seq, value, k, failure FROM log
    ORDER BY md5(concat_ws('|', machine_id, CAST(seq AS VARCHAR), '{SEED}')), machine_id, seq LIMIT 100""",
)
def _(spark, d):
    sample = attribution.background_sample(events_log(spark, d), ["machine_id", "seq"], 100)
    return sample.withColumn("timestamp", F.unix_micros("timestamp"))


# Two small trees by hand, as a boosted model and as a forest:
# (tree, node, prediction, gain, rows, rows per class, left, right, feature, threshold).
STUMPS = [
    (0, 0, 0.0, 3.0, 100, [38.0, 62.0], 1, 2, 0, 50.0), (0, 1, -1.0, 0.0, 30, [24.0, 6.0], -1, -1, -1, 0.0),
    (0, 2, 2.0, 0.0, 70, [14.0, 56.0], -1, -1, -1, 0.0), (1, 0, 0.0, 2.0, 100, [41.0, 59.0], 1, 4, 0, 80.0),
    (1, 1, 0.0, 1.0, 50, [36.0, 14.0], 2, 3, 1, 40.0), (1, 2, 0.5, 0.0, 20, [15.0, 5.0], -1, -1, -1, 0.0),
    (1, 3, -0.5, 0.0, 30, [21.0, 9.0], -1, -1, -1, 0.0), (1, 4, 1.5, 0.0, 50, [5.0, 45.0], -1, -1, -1, 0.0),
]
STEP = 0.5
GIVEN_FEATURES = ["value", "k"]


def given(spark, kind: str) -> FailureModel:
    """The trees above as a model, saved and found again as the newest."""
    rows = [r[:5] + ([float(r[4]), 0.0, 0.0] if kind == "boosted" else r[5],) + r[6:] for r in STUMPS]
    model = model_tables.model_from_nodes(spark, spark.createDataFrame(rows, model_tables.NODES), kind, GIVEN_FEATURES, STEP)
    base = fresh_path(spark, "models")
    for version in ("20240101_000000", "20250101_000000"):
        model.save(f"{base}/models_{version}/{kind}")
    return models.load_model(spark, kind, base=base)[0]


_BOOSTED_MARGIN = f"""(CASE WHEN value <= 50 THEN -1.0 ELSE 2.0 END + {STEP} * CASE WHEN value > 80 THEN 1.5
  WHEN k <= 40 THEN 0.5 ELSE -0.5 END)"""
_FOREST_SHARE = """((CASE WHEN value <= 50 THEN 0.2 ELSE 0.8 END + CASE WHEN value > 80 THEN 0.9
  WHEN k <= 40 THEN 0.25 ELSE 0.3 END) / 2)"""
_PROBABILITY = {
    "boosted": f"(1 / (1 + exp(-2 * CAST({_BOOSTED_MARGIN} AS DOUBLE))))", "random_forest": f"CAST({_FOREST_SHARE} AS DOUBLE)",
}


def _given_sql(kind: str) -> str:
    """Scored rows of the log under a model by hand."""
    return f"""{LOG_SQL}, scored AS (SELECT seq, machine_id, value, k, CAST(failure AS INT) AS label,
      {_PROBABILITY[kind]} AS probability, CASE WHEN {_PROBABILITY[kind]} > 0.5 THEN 1 ELSE 0 END AS prediction FROM log)"""


def given_scores(spark, d, kind):
    log = events_log(spark, d).withColumn("label", F.col("failure").cast("int"))
    return given(spark, kind).predict(log)


def _given_queries(kind, short):
    @query(f"mlm_given_{short}", f"WITH {_given_sql(kind)} SELECT seq, label, prediction, {r6('probability')} AS probability FROM scored")
    def _(spark, d):
        return rounded(given_scores(spark, d, kind), ["seq", "label", "prediction"], ["probability"])

    @query(
        f"mlm_given_{short}_evaluate",
        f"""WITH {_given_sql(kind)}, {CELLS_SQL}, {RATES_SQL} SELECT '{kind}' AS model, tn, fp, fn, tp, {r6('recall')} AS recall,
          {r6('prec')} AS precision, {r6(F1)} AS f1, {r6(_auc_sql('scored'))} AS roc_auc FROM rates""",
    )
    def _(spark, d):
        found = evaluate(given_scores(spark, d, kind).select("label", "prediction", "probability"), kind)
        return rounded(found, ["model", "tn", "fp", "fn", "tp"], ["recall", "precision", "f1", "roc_auc"])

    @query(
        f"exp_given_{short}_high_risk",
        f"""WITH {_given_sql(kind)} SELECT row_number() OVER (ORDER BY probability DESC, seq) AS place, seq,
          {r6('probability')} AS probability FROM scored ORDER BY probability DESC, seq LIMIT 5""",
    )
    def _(spark, d):
        top = insights.high_risk_rows(given_scores(spark, d, kind), ["seq"], 5)
        return rounded(top.withColumn("place", F.col("place").cast("long")), ["place", "seq"], ["probability"])

    @query(
        f"exp_given_{short}_additivity",
        f"""WITH {_given_sql(kind)} SELECT 0::DOUBLE AS max_error, 0::DOUBLE AS mean_error, {r6(_BASES[kind])} AS expected_value,
          count(*) > 0 AS is_valid, count(*) > 0 AS some_importance FROM scored""",
    )
    def _(spark, d):
        """Base and attributions sum up to the score of every row of the log."""
        model = given(spark, kind)
        log = events_log(spark, d)
        checked = attribution.additivity(attribution.with_attributions(model.predict(log), model), model)
        errors = [F.round(c, 6).alias(c) for c in ("max_error", "mean_error")]
        return checked.select(*errors, fixed(F.col("expected_value")).alias("expected_value"), "is_valid", "some_importance")


_BASES = {"boosted": "1.45::DOUBLE", "random_forest": "((0.3 * 0.2 + 0.7 * 0.8 + 0.2 * 0.25 + 0.3 * 0.3 + 0.5 * 0.9) / 2)::DOUBLE"}
for _kind, _short in (("boosted", "boosted"), ("random_forest", "forest")):
    _given_queries(_kind, _short)


@query(
    "mlm_given_gain",
    f"""WITH {LOG_SQL}, n(feature, gain, held) AS (VALUES ('value', 3.0, 100), ('value', 2.0, 100), ('k', 1.0, 50))
    SELECT feature, {r6('CAST(sum(gain * held) / (SELECT sum(gain * held) FROM n) AS DOUBLE)')} AS importance,
      (SELECT count(*) FROM log WHERE CASE feature WHEN 'value' THEN value ELSE k END IS NOT NULL) AS known
    FROM n GROUP BY feature""",
)
def _(spark, d):
    """Gain importance of the boosted model by hand, with the readings each feature has."""
    counts = events_log(spark, d).agg(*[F.count(c).alias(c) for c in GIVEN_FEATURES])
    known = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("known")) for c in GIVEN_FEATURES])))
    ranked = models.feature_importance(spark, given(spark, "boosted")).join(known, "feature")
    return rounded(ranked, ["feature", "known"], ["importance"])


_STUMP_SQL = f"""{LOG_SQL}, t AS (SELECT seq, machine_id, CASE WHEN value <= 50 THEN -1.0 ELSE 2.0 END AS tree0,
      CASE WHEN value > 80 THEN 1.5 WHEN k <= 40 THEN 0.5 ELSE -0.5 END AS f01,
      CASE WHEN value <= 80 THEN -0.1 ELSE 1.5 END AS f0,
      0.5 * CASE WHEN k <= 40 THEN 0.5 ELSE -0.5 END + 0.75 AS f1 FROM log),
    phi AS (SELECT seq, machine_id, CAST(tree0 - 1.1 + 0.25 * (f0 - 0.7 + f01 - f1) AS DOUBLE) AS value_part,
      CAST(0.25 * (f1 - 0.7 + f01 - f0) AS DOUBLE) AS k_part, CAST(tree0 + 0.5 * f01 AS DOUBLE) AS score FROM t)"""


def given_attributions(spark, rows):
    model = given(spark, "boosted")
    return attribution.with_attributions(model.predict(rows), model)


@query(
    "exp_stump_attributions",
    f"""WITH {_STUMP_SQL} SELECT seq, {r6('1.45::DOUBLE')} AS base, {r6('value_part')} AS value_attribution,
      {r6('k_part')} AS k_attribution, {r6('score')} AS score FROM phi""",
)
def _(spark, d):
    """Hand-made trees through the code that explains fitted ones."""
    found = given_attributions(spark, events_log(spark, d))
    total = F.aggregate("attributions", F.col("base"), lambda acc, x: acc + x)
    return found.select(
        "seq", fixed(F.col("base")).alias("base"), fixed(F.col("attributions")[0]).alias("value_attribution"),
        fixed(F.col("attributions")[1]).alias("k_attribution"), fixed(total).alias("score"),
    )


@query(
    "exp_given_instance",
    f"""WITH {_STUMP_SQL}, last AS (SELECT machine_id, max(seq) AS seq FROM log GROUP BY 1)
    SELECT machine_id, seq, unnest(['value', 'k']) AS feature, unnest([{r6('value_part')}, {r6('k_part')}]) AS attribution
    FROM phi JOIN last USING (machine_id, seq)""",
)
def _(spark, d):
    """Attributions of the last row of every machine, one line per feature."""
    rows = events_log(spark, d)
    last = rows.groupBy("machine_id").agg(F.max("seq").alias("seq"))
    chosen = given_attributions(spark, rows.join(last, ["machine_id", "seq"], "left_semi"))
    long = attribution.long_attributions(chosen, GIVEN_FEATURES, ["machine_id", "seq"])
    return rounded(long, ["machine_id", "seq", "feature"], ["attribution"])


@query(
    "exp_given_importance",
    f"""WITH {_STUMP_SQL} SELECT unnest(['value', 'k']) AS feature,
      unnest([{r6('avg(abs(value_part))')}, {r6('avg(abs(k_part))')}]) AS importance FROM phi""",
)
def _(spark, d):
    found = given_attributions(spark, events_log(spark, d))
    return rounded(attribution.attribution_importance(found, GIVEN_FEATURES), ["feature"], ["importance"])


HELD_OUT_SQL = f"WITH {LOG_SQL}, edge AS ({_RANK}) SELECT seq, machine_id, true AS agrees FROM log WHERE us >= (SELECT us FROM edge)"


def _join_query(kind, short):
    @query(f"mlm_{short}_by_join", HELD_OUT_SQL)
    def _(spark, d):
        """Every held-out prediction of the fitted model is what its table of leaf intervals says."""
        model, rows = fitted(spark, d, kind), prepared(spark, d)[3]
        intervals = written(model_tables.leaf_intervals(model), "intervals")
        again = model_tables.scores_by_join(rows, model, intervals, ["seq", "machine_id"])
        scored = model.predict(rows).select("seq", "machine_id", "margin", "probability")
        raw = F.col("margin") if kind == "boosted" else F.col("probability")
        agrees = F.coalesce(F.abs(raw - F.col("score")) < 1e-9, F.lit(False))
        return scored.join(again, ["seq", "machine_id"], "left").select("seq", "machine_id", agrees.alias("agrees"))


for _kind, _short in (("boosted", "boosted"), ("random_forest", "forest")):
    _join_query(_kind, _short)


@query(
    "mlm_baseline_optimum",
    f"WITH {LOG_SQL} SELECT unnest({[n.replace('.', '_') for n in MODEL_NAMES]}) AS feature, true AS flat WHERE (SELECT count(*) FROM log) > 0",
)
def _(spark, d):
    """Slope of the weighted, penalised log loss along each coefficient of the fitted baseline: none."""
    model, data = fitted(spark, d, "baseline"), prepared(spark, d)[2]
    negative, positive = data.balanced
    lr = model.classifier
    scored = model.pipeline.transform(models.with_vector(data.df, data.features))
    p, x = vector_to_array("probability")[1], vector_to_array("scaled")
    wrong = models.weight_column(negative, positive) * (p - F.col("label"))
    rows = scored.select(wrong.alias("wrong"), x.alias("x"))
    sums = rows.agg(*[F.sum(F.col("wrong") * F.col("x")[i]).alias(f"s{i}") for i in range(len(data.features))])
    each = [
        F.struct(F.lit(name.replace(".", "_")).alias("feature"), F.abs(F.col(f"s{i}") + float(c)).alias("slope"))
        for i, (name, c) in enumerate(zip(data.features, lr.coefficients))
    ]
    # The penalty is |c|^2 / 2 beside a sum over rows, so a slope is in rows.
    return sums.select(F.inline(F.array(*each))).select("feature", (F.col("slope") < 1e-3 * data.rows).alias("flat"))


@query("exp_instance")
def _(spark, d):
    """Attributions of the last row of every machine."""
    model = fitted(spark, d, "boosted")
    rows = prepared(spark, d)[3]
    last = rows.groupBy("machine_id").agg(F.max("seq").alias("seq"))
    chosen = rows.join(last, ["machine_id", "seq"], "left_semi")
    return attribution.long_attributions(attribution.with_attributions(chosen, model), model.features, KEYS)


@query("exp_summary_points")
def _(spark, d):
    rows = written(attributed(spark, d).select(*KEYS, "values", "attributions"), "attributed")
    return attribution.summary_points(rows, fitted(spark, d, "boosted").features, KEYS, 20)


@query("exp_high_risk")
def _(spark, d):
    model = fitted(spark, d, "boosted")
    # Ranked first: only the rows shown are explained.
    top = insights.high_risk_rows(model.predict(prepared(spark, d)[3]), KEYS, 5)
    return insights.with_explanations(attribution.with_attributions(top, model), model.features).select(
        "place", *KEYS, "probability", "risk_level", "summary", "positive_factors", "negative_factors"
    )


@query("exp_explanation_checks")
def _(spark, d):
    model = fitted(spark, d, "boosted")
    explained = insights.with_explanations(attributed(spark, d), model.features)
    return insights.explanation_checks(explained, 5)


@query("exp_report")
def _(spark, d):
    return explain(prepared(spark, d)[1], fitted(spark, d, "boosted"), EVENTS).report


def request_model(spark, d) -> FailureModel:
    """Boosted model on features named as the request fields are."""
    key = (spark.sparkContext.applicationId, d, "request")
    if key not in _fitted:
        e = table(spark, d, "events")
        k = F.get_json_object("props", "$.k").cast("double")
        rows = e.select(
            F.col("value").alias("temperature"), (k / 40).alias("pressure"), (k / 4000).alias("vibration"),
            F.col("value").alias("temperature_lag_1"), (k / 40).alias("pressure_rolling_mean_1h"),
            (F.col("event_type") == "error").cast("int").alias("label"),
        )
        names = [c for c in rows.columns if c != "label"]
        _fitted[key] = models.train_boosted(models.prepare_training(rows, names, "label"), **BOOSTED)
    return _fitted[key]


@query("sco_batch")
def _(spark, d):
    valid = scoring.valid_requests(scoring.parse_requests(requests(spark, d), "body"))
    return scoring.score_requests(valid, request_model(spark, d)).drop("body")


@query("sco_stream")
def _(spark, d):
    """All requests as a stream of JSON lines: written, scored to the end, read back."""
    folder = fresh_path(spark, "stream")
    requests(spark, d).select(F.col("body").alias("value")).write.text(f"{folder}/in")
    stream = spark.readStream.text(f"{folder}/in")
    scored, _ = score_stream(stream, request_model(spark, d), f"{folder}/out", f"{folder}/state")
    return scored.drop("value")


@query(
    "sco_stream_rejects",
    f"WITH {REQUESTS_SQL} SELECT reason, count(*) AS row_count FROM requests WHERE reason IS NOT NULL GROUP BY 1",
)
def _(spark, d):
    """Rejects of the stream by reason."""
    folder = fresh_path(spark, "stream")
    requests(spark, d).select(F.col("body").alias("value")).write.text(f"{folder}/in")
    stream = spark.readStream.text(f"{folder}/in")
    _, rejected = score_stream(stream, request_model(spark, d), f"{folder}/out", f"{folder}/state", explain=False)
    return rejected.groupBy("reason").agg(F.count("*").alias("row_count"))


@query("sco_history")
def _(spark, d):
    """The scorer on real features of the whole log instead of the current reading."""
    model = fitted(spark, d, "boosted")
    scored = scoring.score_requests(prepared(spark, d)[3], model)
    return scored.select(*KEYS, fixed(F.col("failure_probability")).alias("failure_probability"), "risk_level", "top_risk_factors")
