"""Cleaning, features, target, split and checks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from gearwatch.functions.columns import add_hours, fixed, instant, named, sanitised_text, version_text
from gearwatch.operators import clean, features, profile, split, target, validate
from gearwatch.operators.models import aligned
from gearwatch.operators.schema import detected_columns, sensor_columns
from gearwatch.operators.timeline import Timeline
from gearwatch.sources.sensor_log import sort_by_time
from workload.registry import query
from workload.views import EVENTS, LINES, LINES_SQL, LOG_SQL, SENSORS, events_log, lines_log, r6, rounded, table

# Bounds that make gaps in the readings.
GAPPY = replace(EVENTS, sensor_min=1.0, sensor_max=200.0)
# Settings that force the ways taken for crowded logs and hot machines.
CUT = replace(EVENTS, group_rows=20)
PANES = replace(EVENTS, dense_rows=0, group_rows=20)

CHECKED_SQL = """checked AS (
  SELECT machine_id, us, seq, failure, CASE WHEN value BETWEEN 1 AND 200 THEN value END AS value,
         CASE WHEN k BETWEEN 1 AND 200 THEN k END AS k FROM log)"""


# --- range check and gaps ------------------------------------------------------------------


@query(
    "prj_detected_columns",
    f"""WITH {LOG_SQL}, c AS (SELECT count(value) AS v, count(k) AS k, count(failure) AS f FROM log)
    SELECT part, column_name, CASE column_name WHEN 'value' THEN v WHEN 'k' THEN k ELSE f END AS known
    FROM c, (VALUES ('range_check', 'value'), ('range_check', 'k'), ('gap_fill', 'value'), ('gap_fill', 'k'),
      ('feature', 'value'), ('feature', 'k')) AS p(part, column_name)""",
)
def _(spark, d):
    """The part each column plays, with the readings it holds."""
    log = events_log(spark, d)
    parts = detected_columns(log, EVENTS)
    names = [c for c in log.columns if c != "timestamp"]
    counts = log.agg(*[F.count(c).alias(c) for c in names])
    known = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("known")) for c in names])))
    return parts.join(known, "column_name").select("part", "column_name", "known")


@query("prj_outlier_null", f"WITH {LOG_SQL}, {CHECKED_SQL} SELECT seq, machine_id, value, k FROM checked")
def _(spark, d):
    return clean.remove_impossible_values(events_log(spark, d), GAPPY).select("seq", "machine_id", "value", "k")


@query(
    "prj_outlier_counts",
    f"""WITH {LOG_SQL}, c AS (SELECT count(*) FILTER (value < 1 OR value > 200) AS v,
      count(*) FILTER (k < 1 OR k > 200) AS k FROM log)
    SELECT 'value' AS column_name, v AS outliers FROM c UNION ALL SELECT 'k', k FROM c
    UNION ALL SELECT '(total)', v + k FROM c""",
)
def _(spark, d):
    return clean.outlier_counts(events_log(spark, d), GAPPY)


@query(
    "prj_missing_profile",
    f"""WITH {LOG_SQL}, {CHECKED_SQL}, good AS (
      SELECT machine_id, count(value) AS nv, count(k) AS nk FROM checked GROUP BY 1),
    c AS (SELECT count(*) FILTER (c.value IS NULL) AS v0, count(*) FILTER (c.value IS NULL AND nv = 0) AS v1,
      count(*) FILTER (c.k IS NULL) AS k0, count(*) FILTER (c.k IS NULL AND nk = 0) AS k1
      FROM checked c JOIN good USING (machine_id))
    SELECT 'value' AS column_name, v0 AS missing_before, v1 AS missing_after, v0 - v1 AS filled FROM c
    UNION ALL SELECT 'k', k0, k1, k0 - k1 FROM c
    UNION ALL SELECT '(total)', v0 + k0, v1 + k1, v0 + k0 - v1 - k1 FROM c""",
)
def _(spark, d):
    log = events_log(spark, d)
    sensors = sensor_columns(log, GAPPY)
    before = clean.remove_impossible_values(log, GAPPY)
    return clean.missing_profile(before, clean.interpolate_missing_values(before, GAPPY, sensors), sensors)


def _filled_sql(position: str) -> str:
    def one(c: str) -> str:
        known = f"CASE WHEN {c} IS NOT NULL THEN {position} END"
        before = "OVER (PARTITION BY machine_id ORDER BY us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        after = "OVER (PARTITION BY machine_id ORDER BY us, seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        return f"""last_value({known} IGNORE NULLS) {before} AS {c}_pa, last_value({c} IGNORE NULLS) {before} AS {c}_px,
          first_value({known} IGNORE NULLS) {after} AS {c}_qa, first_value({c} IGNORE NULLS) {after} AS {c}_qx"""

    def value(c: str) -> str:
        return f"""coalesce({c}, CASE WHEN {c}_pa IS NULL THEN {c}_qx WHEN {c}_qa IS NULL THEN {c}_px
          ELSE {c}_px + ({c}_qx - {c}_px) * ({position} - {c}_pa) / ({c}_qa - {c}_pa) END)"""

    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY us, seq) AS rn FROM checked),
    sides AS (SELECT *, {one('value')}, {one('k')} FROM numbered),
    filled AS (SELECT machine_id, us, seq, failure, {value('value')} AS value, {value('k')} AS k FROM sides)"""


def _fill_query(name, method, options):
    sql = f"""WITH {LOG_SQL}, {CHECKED_SQL}, {_filled_sql('us' if method == 'time' else 'rn')}
    SELECT seq, machine_id, {r6('value')} AS value, {r6('k')} AS k FROM filled"""

    @query(name, sql)
    def _(spark, d):
        gappy = clean.remove_impossible_values(events_log(spark, d), options)
        return rounded(clean.interpolate_missing_values(gappy, options, SENSORS, method), ["seq", "machine_id"], SENSORS)


_fill_query("cln_interpolate_time", "time", GAPPY)
_fill_query("cln_interpolate_time_cut", "time", replace(GAPPY, group_rows=20))
_fill_query("cln_interpolate_linear", "linear", GAPPY)
_fill_query("cln_interpolate_linear_cut", "linear", replace(GAPPY, group_rows=20))


@query(
    "cln_fill_forward",
    f"""WITH {LOG_SQL}, {CHECKED_SQL}
    SELECT seq, machine_id,
      {r6('last_value(value IGNORE NULLS) OVER w')} AS value, {r6('last_value(k IGNORE NULLS) OVER w')} AS k
    FROM checked WINDOW w AS (PARTITION BY machine_id ORDER BY us, seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def _(spark, d):
    cleaned = clean.clean_pipeline(events_log(spark, d), GAPPY, SENSORS, method="forward")
    return rounded(cleaned, ["seq", "machine_id"], SENSORS)


@query(
    "cln_clean",
    f"""WITH {LOG_SQL}, {CHECKED_SQL}, {_filled_sql('us')}
    SELECT machine_id, count(*) AS row_count, count(value) AS values_known, {r6('avg(value)')} AS mean_value,
      {r6('avg(k)')} AS mean_k FROM filled GROUP BY 1""",
)
def _(spark, d):
    cleaned = clean.clean_pipeline(events_log(spark, d), GAPPY)
    return cleaned.groupBy("machine_id").agg(
        F.count("*").alias("row_count"),
        F.count("value").alias("values_known"),
        fixed(F.avg("value")).alias("mean_value"),
        fixed(F.avg("k")).alias("mean_k"),
    )


# --- rows without a time --------------------------------------------------------------------

UNTIMED_SQL = f"""{LOG_SQL}, untimed AS (SELECT machine_id, CASE WHEN seq % 9 <> 4 THEN us END AS us, seq, value, k FROM log)"""


def untimed_log(spark, d):
    return events_log(spark, d).withColumn("timestamp", F.when(F.col("seq") % 9 != 4, F.col("timestamp")))


def _untimed_query(name, options):
    @query(
        name,
        f"""WITH {UNTIMED_SQL} SELECT seq, machine_id, lag(value) OVER w AS lag_1, lag(k, 2) OVER w AS lag_2
        FROM untimed WINDOW w AS (PARTITION BY machine_id ORDER BY us NULLS LAST, seq)""",
    )
    def _(spark, d):
        """Rows without a time come last, on cut machines as on others."""
        made = features.create_lag_features(untimed_log(spark, d), options, SENSORS)
        return made.select("seq", "machine_id", F.col("value_lag_1").alias("lag_1"), F.col("k_lag_2").alias("lag_2"))


_untimed_query("fea_lag_untimed", EVENTS)
_untimed_query("fea_lag_untimed_cut", CUT)


@query(
    "spl_untimed",
    f"""WITH {UNTIMED_SQL}, edge AS (SELECT us FROM (SELECT us, row_number() OVER (ORDER BY us NULLS LAST) - 1 AS r,
      count(*) OVER () AS n FROM untimed) WHERE r = CAST(floor(n * (1 - {EVENTS.test_size})) AS BIGINT))
    SELECT side, count(*) AS row_count FROM (SELECT CASE WHEN us < (SELECT us FROM edge) THEN 'train'
      WHEN us >= (SELECT us FROM edge) THEN 'test' END AS side FROM untimed) WHERE side IS NOT NULL GROUP BY 1""",
)
def _(spark, d):
    """Rows without a time belong to neither side."""
    sides = zip(("train", "test"), split.time_based_split(untimed_log(spark, d), EVENTS))
    train, test = [df.select(F.lit(side).alias("side")) for side, df in sides]
    return train.unionByName(test).groupBy("side").agg(F.count("*").alias("row_count"))


# --- features -----------------------------------------------------------------------------

LAG_NAMES = [f"{c}_lag_{n}" for c in SENSORS for n in EVENTS.lags]
ROLL_NAMES = [f"{c}_rolling_{f}_{w}" for c in SENSORS for w, _ in EVENTS.windows for f in ("mean", "std")]
EMA_NAMES = [f"{c}_ema_{a}" for c in SENSORS for a in EVENTS.alphas]

LAG_COLUMNS = ", ".join(
    f"{r6(f'lag({c}, {n}) OVER o')} AS {c}_lag_{n}" for c in SENSORS for n in EVENTS.lags
)
ROLL_COLUMNS = ", ".join(
    f"{r6(f'{fn}({c}) OVER w{w}')} AS {c}_rolling_{f}_{w}"
    for c in SENSORS
    for w, _ in EVENTS.windows
    for f, fn in (("mean", "avg"), ("std", "stddev_samp"))
)
WINDOWS = "o AS (PARTITION BY machine_id ORDER BY us, seq), " + ", ".join(
    f"w{w} AS (PARTITION BY machine_id ORDER BY us RANGE BETWEEN {us - 1} PRECEDING AND CURRENT ROW)"
    for w, us in EVENTS.windows_us
)
_STEPS = [(c, a, f"e_{c}_{str(a).replace('.', '_')}") for c in SENSORS for a in EVENTS.alphas]
EMA_SQL = f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY us, seq) AS rn FROM log),
ema AS (
  SELECT machine_id, seq, rn, {", ".join(f"{c} AS {e}" for c, _, e in _STEPS)} FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.machine_id, n.seq, n.rn, {", ".join(f"{a}::DOUBLE * n.{c} + {1 - a}::DOUBLE * e.{e}" for c, a, e in _STEPS)}
  FROM ema e JOIN numbered n ON n.machine_id = e.machine_id AND n.rn = e.rn + 1)"""
EMA_COLUMNS = ", ".join(f"{r6(e)} AS {c}_ema_{str(a).replace('.', '_')}" for c, a, e in _STEPS)
TARGET_SQL = """labelled AS (
  SELECT *, CASE WHEN count(*) OVER (PARTITION BY machine_id) = 1 THEN CAST(failure AS INT)
    ELSE coalesce(max(CAST(failure AS INT)) OVER (PARTITION BY machine_id ORDER BY us
      RANGE BETWEEN 1 FOLLOWING AND 86400000000 FOLLOWING), 0) END AS failure_within_24h FROM log)"""

LAG_SQL = f"WITH {LOG_SQL} SELECT seq, machine_id, {LAG_COLUMNS} FROM log WINDOW {WINDOWS}"
ROLL_SQL = f"WITH {LOG_SQL} SELECT seq, machine_id, {ROLL_COLUMNS} FROM log WINDOW {WINDOWS}"


def _feature_queries(suffix, options):
    """The feature operators under one setting; the result does not depend on it."""

    @query(f"fea_lag{suffix}", LAG_SQL)
    def _(spark, d):
        return rounded(features.create_lag_features(events_log(spark, d), options), ["seq", "machine_id"], LAG_NAMES)

    @query(f"fea_ema{suffix}", f"WITH RECURSIVE {LOG_SQL}, {EMA_SQL} SELECT seq, machine_id, {EMA_COLUMNS} FROM ema")
    def _(spark, d):
        return rounded(features.create_ema_features(events_log(spark, d), options), ["seq", "machine_id"], EMA_NAMES)

    @query(f"fea_target{suffix}", f"WITH {LOG_SQL}, {TARGET_SQL} SELECT seq, machine_id, failure_within_24h FROM labelled")
    def _(spark, d):
        labelled = target.create_target(events_log(spark, d), options)
        return labelled.select("seq", "machine_id", "failure_within_24h")


_feature_queries("", EVENTS)
_feature_queries("_cut", CUT)

# Some readings are far larger than the rest, so they show until their weight is below 1e-30; some are missing.
SPIKE = "CASE WHEN seq % 50 = 7 THEN value * 1e25::DOUBLE ELSE value END"
SPIKED_SQL = f"""spiked AS (SELECT machine_id, us, seq, {SPIKE} AS value FROM log)"""
GAPS_SQL = f"""spiked AS (SELECT machine_id, us, seq, {SPIKE} AS value FROM checked)"""
_AVERAGES = [(a, f"e_{str(a).replace('.', '_')}") for a in EVENTS.alphas]


def _over_gap(a, e):
    old = f"pow({1 - a}::DOUBLE, f.gap + 1)"
    return f"""CASE WHEN n.value IS NULL THEN f.{e} WHEN f.{e} IS NULL THEN n.value
      ELSE ({old} * f.{e} + {a}::DOUBLE * n.value) / ({old} + {a}::DOUBLE) END"""


FOLD_SQL = f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY us, seq) AS rn FROM spiked),
fold AS (
  SELECT machine_id, seq, rn, CAST(0 AS BIGINT) AS gap, {", ".join(f"value AS {e}" for _, e in _AVERAGES)}
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.machine_id, n.seq, n.rn, CASE WHEN n.value IS NULL THEN f.gap + 1 ELSE 0 END,
    {", ".join(_over_gap(a, e) for a, e in _AVERAGES)}
  FROM fold f JOIN numbered n ON n.machine_id = f.machine_id AND n.rn = f.rn + 1)
SELECT seq, machine_id, {", ".join(f"round(log10({e}), 6) AS value_ema_{str(a).replace('.', '_')}" for a, e in _AVERAGES)} FROM fold"""


def _spike_query(name, sql, options, bounds):
    @query(name, f"WITH RECURSIVE {LOG_SQL}, {sql}, {FOLD_SQL}")
    def _(spark, d):
        """The logarithm of averages, which shows all sizes alike."""
        log = events_log(spark, d)
        if bounds:
            log = clean.remove_impossible_values(log, GAPPY)
        log = log.withColumn("value", F.when(F.col("seq") % 50 == 7, F.col("value") * 1e25).otherwise(F.col("value")))
        made = features.create_ema_features(log, options, ["value"])
        logs = [F.round(F.log10(named(f"value_ema_{a}")), 6).alias(f"value_ema_{str(a).replace('.', '_')}") for a in options.alphas]
        return made.select("seq", "machine_id", *logs)


_spike_query("fea_ema_spike", SPIKED_SQL, EVENTS, False)
_spike_query("fea_ema_spike_cut", SPIKED_SQL, CUT, False)
_spike_query("fea_ema_gaps", f"{CHECKED_SQL}, {GAPS_SQL}", EVENTS, True)
_spike_query("fea_ema_gaps_cut", f"{CHECKED_SQL}, {GAPS_SQL}", CUT, True)


@query("fea_rolling", ROLL_SQL)
def _(spark, d):
    return rounded(features.create_rolling_features(events_log(spark, d), EVENTS), ["seq", "machine_id"], ROLL_NAMES)


@query("fea_rolling_panes", ROLL_SQL)
def _(spark, d):
    return rounded(features.create_rolling_features(events_log(spark, d), PANES), ["seq", "machine_id"], ROLL_NAMES)


# Windows of which one is no multiple of anything: panes are cut where it starts.
ODD = replace(PANES, windows=(("1h", 3600), ("1h1s", 3601), ("8h", 8 * 3600)))


@query(
    "fea_rolling_odd_panes",
    f"""WITH {LOG_SQL} SELECT seq, machine_id, {", ".join(
        f"{r6(f'{fn}({c}) OVER w{w}')} AS {c}_rolling_{f}_{w}"
        for c in SENSORS for w, _ in ODD.windows for f, fn in (("mean", "avg"), ("std", "stddev_samp")))}
    FROM log WINDOW {", ".join(
        f"w{w} AS (PARTITION BY machine_id ORDER BY us RANGE BETWEEN {us - 1} PRECEDING AND CURRENT ROW)"
        for w, us in ODD.windows_us)}""",
)
def _(spark, d):
    names = [f"{c}_rolling_{f}_{w}" for c in SENSORS for w, _ in ODD.windows for f in ("mean", "std")]
    return rounded(features.create_rolling_features(events_log(spark, d), ODD), ["seq", "machine_id"], names)


_TIED = ", ".join(
    f"""{r6(f"avg(b.quantity) FILTER (b.us > a.us - {us})")} AS quantity_rolling_mean_{w},
    {r6(f"stddev_samp(b.quantity) FILTER (b.us > a.us - {us})")} AS quantity_rolling_std_{w}"""
    for w, us in LINES.windows_us
)
TIES_SQL = f"""WITH {LINES_SQL} SELECT a.machine_id, a.us, a.quantity, {_TIED}
  FROM lines a JOIN lines b ON a.machine_id = b.machine_id AND b.rn <= a.rn
    AND b.us > a.us - {max(us for _, us in LINES.windows_us)}
  GROUP BY a.machine_id, a.rn, a.us, a.quantity"""
TIE_NAMES = [f"quantity_rolling_{f}_{w}" for w, _ in LINES.windows for f in ("mean", "std")]


def _tie_query(name, options):
    @query(name, TIES_SQL)
    def _(spark, d):
        made = features.create_rolling_features(lines_log(spark, d), options, ["quantity"])
        made = made.withColumn("us", instant(made, "timestamp"))
        return rounded(made, ["machine_id", "us", "quantity"], TIE_NAMES)


_tie_query("fea_rolling_ties", LINES)
_tie_query("fea_rolling_ties_panes", replace(LINES, dense_rows=0))


@query(
    "fea_lag_ties",
    f"""WITH {LINES_SQL} SELECT machine_id, us, quantity, lag(quantity) OVER w AS quantity_lag_1,
      lag(quantity, 2) OVER w AS quantity_lag_2 FROM lines WINDOW w AS (PARTITION BY machine_id ORDER BY rn)""",
)
def _(spark, d):
    made = features.create_lag_features(lines_log(spark, d), LINES, ["quantity"])
    return made.select(
        "machine_id", instant(made, "timestamp").alias("us"), "quantity", "quantity_lag_1", "quantity_lag_2"
    )


@query(
    "fea_target_ties",
    f"""WITH {LINES_SQL} SELECT machine_id, count(*) AS row_count,
      CAST(sum(y) AS BIGINT) AS positives FROM (
        SELECT machine_id, coalesce(max(CAST(failure AS INT)) OVER (PARTITION BY machine_id ORDER BY us
          RANGE BETWEEN 1 FOLLOWING AND {30 * 86400 * 10**6} FOLLOWING), 0) AS y FROM lines) GROUP BY 1""",
)
def _(spark, d):
    labelled = target.create_target(lines_log(spark, d), LINES)
    return labelled.groupBy("machine_id").agg(
        F.count("*").alias("row_count"), F.sum("failure_within_24h").cast("long").alias("positives")
    )


ALL_SQL = f"""WITH RECURSIVE {LOG_SQL}, {EMA_SQL}, {TARGET_SQL},
  made AS (SELECT seq, machine_id, failure_within_24h, value, k, {LAG_COLUMNS}, {ROLL_COLUMNS}
    FROM labelled WINDOW {WINDOWS})
  SELECT made.*, {EMA_COLUMNS} FROM made JOIN ema USING (seq, machine_id)"""


def _all_query(name, options):
    @query(name, ALL_SQL)
    def _(spark, d):
        made = features.feature_pipeline(events_log(spark, d), options)
        return rounded(
            made, ["seq", "machine_id", "failure_within_24h", "value", "k"], LAG_NAMES + ROLL_NAMES + EMA_NAMES
        )


_all_query("fea_all", EVENTS)
_all_query("fea_all_cut", PANES)

POSITIVES_SQL = f"""WITH {LOG_SQL}, {TARGET_SQL},
  made AS (SELECT *, lag(value) OVER o AS before, avg(value) OVER w8h AS mean_8h, stddev_samp(value) OVER w8h AS std_8h
    FROM labelled WINDOW {WINDOWS})
  SELECT machine_id, count(*) AS row_count, CAST(sum(failure_within_24h) AS BIGINT) AS positives,
    {r6('avg(before)')} AS mean_lag_1, {r6('avg(mean_8h)')} AS mean_rolling_8h, {r6('avg(std_8h)')} AS mean_std_8h
  FROM made GROUP BY machine_id"""


@query("fea_positives_per_machine", POSITIVES_SQL)
def positives_per_machine(spark, d):
    """Features and label of the whole log, summed up per machine."""
    log = events_log(spark, d)
    timeline = Timeline.measure(log, EVENTS)
    made = features.create_lag_features(log, EVENTS, ["value"], timeline)
    made = features.create_rolling_features(made, EVENTS, ["value"], timeline)
    made = target.create_target(made, EVENTS, timeline)
    return made.groupBy("machine_id").agg(
        F.count("*").alias("row_count"),
        F.sum("failure_within_24h").cast("long").alias("positives"),
        fixed(F.avg("value_lag_1")).alias("mean_lag_1"),
        fixed(F.avg("value_rolling_mean_8h")).alias("mean_rolling_8h"),
        fixed(F.avg("value_rolling_std_8h")).alias("mean_std_8h"),
    )


@query(
    "fea_label_observed",
    f"""WITH {LOG_SQL}, {TARGET_SQL} SELECT seq, failure_within_24h,
      failure_within_24h = 1 OR us + 86400000000 <= max(us) OVER (PARTITION BY machine_id) AS label_observed
    FROM labelled""",
)
def _(spark, d):
    labelled = target.create_target(events_log(spark, d), EVENTS, observed="label_observed")
    return labelled.select("seq", "failure_within_24h", "label_observed")


# --- failure flag -------------------------------------------------------------------------


def _flag_words(spark, d):
    kind = F.col("event_type")
    words = F.when(kind == "error", "Yes").when(kind == "click", "n").when(kind == "view", "FALSE").otherwise("0")
    return table(spark, d, "events").select(
        F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("machine_id"),
        F.col("ts").cast("timestamp").alias("timestamp"), words.alias("Machine failure"),
    )


@query(
    "prj_failure_words",
    "SELECT event_id AS seq, event_type = 'error' AS failed FROM events",
)
def _(spark, d):
    return target.normalise_failure(_flag_words(spark, d), EVENTS).select(
        "seq", named("Machine failure").alias("failed")
    )


@query(
    "prj_failure_numbers",
    """SELECT event_id AS seq, CASE WHEN event_type = 'error' THEN value <> 0
      WHEN event_type = 'click' THEN true ELSE false END AS failed FROM events""",
)
def _(spark, d):
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.col("value").cast("string")).when(kind == "click", "2").when(kind == "view", "0")
        .when(kind == "signup", "broken")
    )
    log = table(spark, d, "events").select(F.col("event_id").alias("seq"), text.alias("label"))
    return target.normalise_failure(log, EVENTS).select("seq", F.col("label").alias("failed"))


@query(
    "agg_target_summary",
    f"""WITH {LOG_SQL}, {TARGET_SQL} SELECT count(*) AS row_count,
      CAST(sum(failure_within_24h) AS BIGINT) AS positives, {r6('avg(failure_within_24h)')} AS positive_rate,
      count(*) FILTER (failure) AS failures,
      count(*) FILTER (failure) > 0 AND sum(failure_within_24h) = 0 AS failures_without_labels FROM labelled""",
)
def _(spark, d):
    s = target.target_summary(target.create_target(events_log(spark, d), EVENTS), EVENTS)
    return s.withColumn("positive_rate", fixed(F.col("positive_rate")))


@query(
    "joi_future_failure",
    f"""WITH {LOG_SQL} SELECT seq, machine_id FROM log a WHERE EXISTS (SELECT 1 FROM log b
      WHERE b.machine_id = a.machine_id AND b.failure AND b.us > a.us AND b.us <= a.us + 86400000000)""",
)
def _(spark, d):
    return target.target_by_join(events_log(spark, d), EVENTS).select("seq", "machine_id")


# --- profiles -----------------------------------------------------------------------------


@query(
    "agg_rows_per_machine",
    f"WITH {LOG_SQL} SELECT machine_id, count(*) AS row_count, count(*) = 1 AS single_row FROM log GROUP BY 1",
)
def _(spark, d):
    return profile.rows_per_machine(events_log(spark, d), EVENTS)


@query(
    "agg_ingest_profile",
    f"""WITH {LOG_SQL} SELECT count(*) AS row_count, CAST(6 AS BIGINT) AS column_count, min(us) AS first_us,
      max(us) AS last_us, count(DISTINCT machine_id) AS machines FROM log""",
)
def _(spark, d):
    return profile.ingest_profile(events_log(spark, d), EVENTS)


@query("agg_distinct_machines", f"WITH {LOG_SQL} SELECT DISTINCT machine_id FROM log")
def _(spark, d):
    return profile.distinct_machines(events_log(spark, d), EVENTS)


@query(
    "agg_class_distribution",
    f"""WITH {LOG_SQL}, {TARGET_SQL} SELECT CAST(failure_within_24h AS BIGINT) AS label, count(*) AS row_count
    FROM labelled GROUP BY 1""",
)
def _(spark, d):
    return profile.class_distribution(target.create_target(events_log(spark, d), EVENTS), EVENTS.target)


@query(
    "agg_class_weights",
    f"""WITH {LOG_SQL}, {TARGET_SQL}, c AS (SELECT count(*) FILTER (failure_within_24h = 0) AS n0,
      count(*) FILTER (failure_within_24h = 1) AS n1 FROM labelled)
    SELECT n0 AS negatives, n1 AS positives, {r6('(n0 + n1) / (2.0::DOUBLE * n0)')} AS weight_negative,
      {r6('(n0 + n1) / (2.0::DOUBLE * n1)')} AS weight_positive,
      {r6('CAST(n0 AS DOUBLE) / n1')} AS negative_positive_ratio FROM c""",
)
def _(spark, d):
    w = profile.class_weights(target.create_target(events_log(spark, d), EVENTS), EVENTS.target)
    return rounded(w, ["negatives", "positives"], ["weight_negative", "weight_positive", "negative_positive_ratio"])


# --- order, split, checks -------------------------------------------------------------------


@query(
    "srt_time_order",
    f"""WITH {LOG_SQL} SELECT machine_id, us, seq, value FROM log ORDER BY machine_id, us, seq""",
)
def _(spark, d):
    log = sort_by_time(events_log(spark, d), EVENTS)
    return log.select("machine_id", instant(log, "timestamp").alias("us"), "seq", "value")


_RANK = f"SELECT us FROM log ORDER BY us LIMIT 1 OFFSET (SELECT CAST(floor(count(*) * (1 - 0.2::DOUBLE)) AS BIGINT) FROM log)"
_SIDES = f"sides AS (SELECT *, CASE WHEN us < (SELECT us FROM edge) THEN 'train' ELSE 'test' END AS split FROM log)"


@query("spl_time_split", f"WITH {LOG_SQL}, edge AS ({_RANK}), {_SIDES} SELECT seq, split FROM sides")
def _(spark, d):
    return split.with_split(events_log(spark, d), EVENTS).select("seq", "split")


def _report_sql(source: str) -> str:
    return f"""SELECT count(*) FILTER (split = 'train') AS train_row_count,
      min(us) FILTER (split = 'train') AS train_first_us, max(us) FILTER (split = 'train') AS train_last_us,
      count(*) FILTER (split = 'test') AS test_row_count, min(us) FILTER (split = 'test') AS test_first_us,
      max(us) FILTER (split = 'test') AS test_last_us,
      max(us) FILTER (split = 'train') >= min(us) FILTER (split = 'test') AS overlap FROM {source}"""


@query("spl_report", f"WITH {LOG_SQL}, edge AS ({_RANK}), {_SIDES} {_report_sql('sides')}")
def _(spark, d):
    return split.split_report(split.with_split(events_log(spark, d), EVENTS), EVENTS)


@query(
    "spl_report_ties",
    f"WITH log AS (SELECT epoch_us(l_shipdate) AS us FROM lineitem), edge AS ({_RANK}), {_SIDES} {_report_sql('sides')}",
)
def _(spark, d):
    return split.split_report(split.with_split(lines_log(spark, d), LINES), LINES)


def _overlapping(spark, d):
    """Two sets that overlap in time: errors and all other events."""
    log = events_log(spark, d)
    return log.filter("failure"), log.filter("NOT failure")


_PAIR = """train AS (SELECT * FROM log WHERE failure), test AS (SELECT * FROM log WHERE NOT failure)"""


@query(
    "joi_train_test_overlap",
    f"""WITH {LOG_SQL}, {_PAIR}, a AS (SELECT machine_id, max(us) AS last_train_us FROM train GROUP BY 1),
    b AS (SELECT machine_id, min(us) AS first_test_us FROM test GROUP BY 1)
    SELECT machine_id, last_train_us, first_test_us, last_train_us >= first_test_us AS leaks
    FROM a JOIN b USING (machine_id)""",
)
def _(spark, d):
    return validate.train_test_overlap(*_overlapping(spark, d), EVENTS)


@query(
    "set_common_machines",
    f"WITH {LOG_SQL}, {_PAIR} SELECT machine_id FROM train INTERSECT SELECT machine_id FROM test",
)
def _(spark, d):
    return validate.common_machines(*_overlapping(spark, d), EVENTS)


@query(
    "set_bag_union",
    f"""WITH {LOG_SQL}, {_PAIR}, pooled AS (SELECT * FROM train UNION ALL SELECT * FROM log)
    SELECT machine_id, count(*) AS row_count, {r6('sum(value)')} AS total FROM pooled GROUP BY 1""",
)
def _(spark, d):
    log = events_log(spark, d)
    both = validate.bag_union(log.filter("failure"), log)
    return both.groupBy("machine_id").agg(F.count("*").alias("row_count"), fixed(F.sum("value")).alias("total"))


def _arrivals(spark, d):
    """The log in scrambled row order; the factor makes a permutation of the ids."""
    return events_log(spark, d).withColumn("seq", F.col("seq") * 1103515245 % 2147483647)


_ORDER_SQL = f"""WITH {LOG_SQL}, steps AS (SELECT machine_id, us, lag(us) OVER (PARTITION BY machine_id
      ORDER BY seq * 1103515245 % 2147483647) AS before FROM log)
    SELECT machine_id, count(*) AS violations FROM steps WHERE before > us GROUP BY 1"""


@query("val_time_order", _ORDER_SQL)
def _(spark, d):
    return validate.time_order_violations(_arrivals(spark, d), EVENTS)


@query("val_time_order_cut", _ORDER_SQL)
def _(spark, d):
    return validate.time_order_violations(_arrivals(spark, d), CUT)


_LEAKY_SQL = f"""WITH {LOG_SQL}, later AS (SELECT *, first_value(CASE WHEN failure THEN us END IGNORE NULLS)
      OVER (PARTITION BY machine_id ORDER BY us, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM log)
    SELECT seq, machine_id FROM later WHERE failure AND (nxt IS NULL OR nxt > us + 86400000000)"""


def _leak_query(name, options):
    @query(name, _LEAKY_SQL)
    def _(spark, d):
        leaky = events_log(spark, d).withColumn(options.target, F.col("failure").cast("int"))
        return validate.unexplained_labels(leaky, options).select("seq", "machine_id")


_leak_query("val_unexplained_labels", EVENTS)
_leak_query("val_unexplained_labels_cut", CUT)


@query(
    "val_report",
    f"""WITH {LOG_SQL}, {_PAIR}, pairs AS (SELECT machine_id FROM (SELECT machine_id, max(us) AS a FROM train GROUP BY 1)
      JOIN (SELECT machine_id, min(us) AS b FROM test GROUP BY 1) USING (machine_id) WHERE a >= b)
    SELECT 'time_order_train' AS check_name, NULL AS machine_id, true AS passed, 'ok' AS severity, '' AS detail
    UNION ALL SELECT 'time_order_test', NULL, true, 'ok', ''
    UNION ALL SELECT 'train_before_test', NULL, false, 'error', 'sets overlap in time'
      WHERE (SELECT max(us) FROM train) >= (SELECT min(us) FROM test)
    UNION ALL SELECT 'train_before_test', NULL, true, 'ok', ''
      WHERE (SELECT max(us) FROM train) < (SELECT min(us) FROM test)
    UNION ALL SELECT 'train_before_test_per_machine', machine_id, false, 'error', 'sets overlap in time' FROM pairs
    UNION ALL SELECT 'train_before_test_per_machine', NULL, true, 'ok', '' WHERE NOT EXISTS (SELECT 1 FROM pairs)
    UNION ALL SELECT 'feature_names', NULL, true, 'warn', 'value_next contains next'""",
)
def _(spark, d):
    train, test = _overlapping(spark, d)
    return validate.validate_pipeline(train, test, EVENTS, ["value", "k", "value_next"])


# --- names and scalars ------------------------------------------------------------------------


@query(
    "prj_align_features",
    f"WITH {LOG_SQL}, {CHECKED_SQL} SELECT seq, coalesce(k, 0) AS k, 0::DOUBLE AS rpm, coalesce(value, 0) AS value_raw_ FROM checked",
)
def _(spark, d):
    log = clean.remove_impossible_values(events_log(spark, d), GAPPY).withColumnRenamed("value", "value[raw]")
    wanted = ["k", "rpm", "value_raw_"]
    return log.select("seq", *[c.alias(f) for c, f in zip(aligned(log, wanted), wanted)])


@query(
    "sca_functions",
    """SELECT event_id AS seq, lower(upper(event_type)) IN ('error', 'view') AS is_member,
      coalesce(TRY_CAST(CASE WHEN value > 50 THEN CAST(value AS VARCHAR) ELSE event_type END AS DOUBLE), 0) AS parsed,
      contains(event_type, 'r') AS has_r,
      translate('s[' || event_type || ']<x>', '[]<>', '____') AS clean_name,
      epoch_us(ts) + 86400000000 AS next_day_us, strftime(ts, '%Y%m%d_%H%M%S') AS version,
      round(1 / (1 + exp(-greatest(least((value - 50) * 10, 250), -250))) + 3e-9, 6) AS squashed,
      concat_ws('|', event_type, CAST(user_id AS VARCHAR)) AS joined,
      upper(event_type[1]) || event_type[2:] AS capitalised
    FROM events""",
)
def _(spark, d):
    from gearwatch.functions.columns import logistic, parse_number

    kind, value = F.col("event_type"), F.col("value")
    stamp = F.col("ts").cast("timestamp")
    text = F.when(value > 50, value.cast("string")).otherwise(kind)
    return table(spark, d, "events").select(
        F.col("event_id").alias("seq"),
        F.lower(F.upper(kind)).isin("error", "view").alias("is_member"),
        F.coalesce(parse_number(text), F.lit(0.0)).alias("parsed"),
        F.contains(kind, F.lit("r")).alias("has_r"),
        sanitised_text(F.concat(F.lit("s["), kind, F.lit("]<x>"))).alias("clean_name"),
        F.unix_micros(add_hours(stamp, 24)).alias("next_day_us"),
        version_text(stamp).alias("version"),
        fixed(logistic((value - 50) * 10)).alias("squashed"),
        F.array_join(F.slice(F.array(kind, F.col("user_id").cast("string"), F.lit("x")), 1, 2), "|").alias("joined"),
        F.initcap(kind).alias("capitalised"),
    )
