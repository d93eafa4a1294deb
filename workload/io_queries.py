"""Scans and sinks: what is written comes back."""

from __future__ import annotations

from pyspark.sql import functions as F

from gearwatch.functions.columns import fixed, instant, named
from gearwatch.operators import clean, metrics, split
from gearwatch.operators.profile import ingest_profile
from gearwatch.operators.target import normalise_failure
from gearwatch.plans.data_job import ingest_pipeline, run_pipeline
from gearwatch.session import fresh_path
from gearwatch.sources import artifacts
from gearwatch.sources.sensor_log import read_csv_log
from workload.log_queries import CHECKED_SQL, GAPPY, _filled_sql, _report_sql, _RANK, _SIDES
from workload.metric_queries import CELLS_SQL, F1, RATES_SQL
from workload.registry import query
from workload.views import EVENTS, LOG_SQL, SCORED_SQL, SENSORS, events_log, r6, rounded, scored_events, table


def _raw_csv(spark, d, clock: bool = True) -> str:
    """The events as a raw CSV log in event order, with missing and bad cells."""
    kind, value = F.col("event_type"), F.col("value")
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    time = F.when((kind == "view") & (value < 5), "no time").otherwise(stamp)
    e = table(spark, d, "events").orderBy("event_id")
    raw = e.select(
        *([time.alias("timestamp")] if clock else []),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("Product ID"),
        F.when(kind == "click", F.lit("NA")).otherwise(value.cast("string")).alias("value"),
        F.get_json_object("props", "$.k").alias("k"),
        F.when(kind == "error", "yes").otherwise("no").alias("Machine failure"),
    )
    path = fresh_path(spark, "raw-csv")
    raw.write.option("header", True).csv(path)
    return path


@query(
    "src_csv_quoted",
    """SELECT event_id AS seq, 'M' || CAST(user_id AS VARCHAR) AS machine_id, 'say "' || event_type || '", ok' AS note, value
    FROM events""",
)
def _(spark, d):
    """Cells with quotes and commas, in the standard dialect."""
    note = F.concat(F.lit('say "'), "event_type", F.lit('", ok'))
    raw = table(spark, d, "events").select(
        F.col("event_id").alias("seq"), F.col("ts").cast("string").alias("timestamp"),
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("machine_id"), note.alias("note"), "value",
    )
    path = fresh_path(spark, "quoted-csv")
    raw.write.options(header=True, escape='"').csv(path)
    return read_csv_log(spark, path, EVENTS).select("seq", "machine_id", "note", "value")


@query(
    "src_csv_multiline",
    """SELECT row_number() OVER (ORDER BY event_id) - 1 AS seq, event_id, 'M' || CAST(user_id AS VARCHAR) AS machine_id,
      CASE WHEN event_type IN ('click', 'error') THEN event_type || chr(10) || 'said "so", ' || chr(10) || chr(10) || 'twice'
        ELSE event_type END AS note, value FROM events""",
)
def _(spark, d):
    """Cells that span several lines, with blank lines, quotes and commas inside."""
    kind = F.col("event_type")
    note = F.when(kind.isin("click", "error"), F.concat(kind, F.lit('\nsaid "so", \n\ntwice'))).otherwise(kind)
    raw = table(spark, d, "events").orderBy("event_id").select(
        "event_id", F.col("ts").cast("string").alias("timestamp"),
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("machine_id"), note.alias("note"), "value",
    )
    path = fresh_path(spark, "multiline-csv")
    raw.write.options(header=True, escape='"').csv(path)
    return read_csv_log(spark, path, EVENTS).select("seq", "event_id", "machine_id", "note", "value")


@query(
    "src_csv_log",
    """SELECT row_number() OVER (ORDER BY event_id) - 1 AS seq, 'U' || CAST(user_id AS VARCHAR) AS machine_id,
      CASE WHEN event_type = 'view' AND value < 5 THEN NULL ELSE epoch_us(ts) END AS us,
      CASE WHEN event_type <> 'click' THEN value END AS value,
      CAST(regexp_extract(props, '"k": *(-?[0-9.]+)', 1) AS BIGINT) AS k, event_type = 'error' AS failed FROM events""",
)
def _(spark, d):
    log = normalise_failure(read_csv_log(spark, _raw_csv(spark, d), EVENTS), EVENTS)
    return log.select(
        "seq", "machine_id", instant(log, "timestamp").alias("us"), "value", "k", named("Machine failure").alias("failed")
    )


@query(
    "src_synthetic_clock",
    """SELECT 'U' || CAST(user_id AS VARCHAR) AS machine_id,
      epoch_us(TIMESTAMP '2024-01-01 00:00:00') + (row_number() OVER (ORDER BY event_id) - 1) * 3600000000 AS us,
      CASE WHEN event_type <> 'click' THEN value END AS value FROM events""",
)
def _(spark, d):
    log = read_csv_log(spark, _raw_csv(spark, d, clock=False), EVENTS)
    return log.select("machine_id", instant(log, "timestamp").alias("us"), "value")


@query(
    "src_untimed_rejects",
    """SELECT row_number AS seq, 'no valid timestamp' AS reason FROM (SELECT event_type, value,
      row_number() OVER (ORDER BY event_id) - 1 AS row_number FROM events) WHERE event_type = 'view' AND value < 5""",
)
def _(spark, d):
    return ingest_pipeline(spark, _raw_csv(spark, d), EVENTS)[1].select("seq", "reason")


@query(
    "src_ingest",
    """WITH log AS (SELECT 'U' || CAST(user_id AS VARCHAR) AS machine_id, epoch_us(ts) AS us FROM events
      WHERE NOT (event_type = 'view' AND value < 5))
    SELECT count(*) AS row_count, CAST(7 AS BIGINT) AS column_count, min(us) AS first_us, max(us) AS last_us,
      count(DISTINCT machine_id) AS machines FROM log""",
)
def _(spark, d):
    return ingest_profile(ingest_pipeline(spark, _raw_csv(spark, d), EVENTS)[0], EVENTS)


@query(
    "src_parquet_scan",
    """SELECT CAST(user_id AS VARCHAR) AS machine_id, count(*) AS row_count, round(sum(value) + 3e-9, 6) AS total
    FROM events WHERE event_type = 'error' GROUP BY 1""",
)
def _(spark, d):
    errors = table(spark, d, "events").filter(F.col("event_type") == "error")
    return errors.groupBy(F.col("user_id").cast("string").alias("machine_id")).agg(
        F.count("*").alias("row_count"), fixed(F.sum("value")).alias("total")
    )


def _latest_query(name, format):
    @query(name, f"WITH {LOG_SQL}, edge AS ({_RANK}), {_SIDES} SELECT seq, machine_id, us, value FROM sides WHERE split = 'test'")
    def _(spark, d):
        """Two versions are saved; the newest test set is read back."""
        base = fresh_path(spark, "datasets")
        log = events_log(spark, d)
        train, test = split.time_based_split(log, EVENTS)
        artifacts.save_datasets(test, train, base, "20240101_000000", format)
        artifacts.save_datasets(train, test, base, "20240102_000000", format)
        if format == "csv":
            path = f"{base}/csv/version={artifacts.latest_version(spark, base, 'csv')}/split=test"
            newest = artifacts.load_csv(spark, path, log.schema)
        else:
            newest = artifacts.load_dataset(spark, base, "test")
        return newest.select("seq", "machine_id", instant(newest, "timestamp").alias("us"), "value")


_latest_query("src_latest_version", "both")
_latest_query("snk_versioned_csv", "csv")


@query(
    "snk_clean_csv",
    f"""WITH {LOG_SQL}, {CHECKED_SQL}, {_filled_sql('us')}
    SELECT seq, machine_id, {r6('value')} AS value, {r6('k')} AS k FROM filled""",
)
def _(spark, d):
    log = events_log(spark, d)
    path = fresh_path(spark, "cleaned")
    artifacts.save_csv(clean.clean_pipeline(log, GAPPY, SENSORS), path)
    back = artifacts.load_csv(spark, path, log.schema)
    return rounded(back, ["seq", "machine_id"], SENSORS)


@query(
    "snk_metrics_json",
    f"""WITH {SCORED_SQL}, {CELLS_SQL}, {RATES_SQL} SELECT 'score' AS model, tn, fp, fn, tp, {r6('recall')} AS recall,
      {r6('prec')} AS precision, {r6(F1)} AS f1 FROM rates""",
)
def _(spark, d):
    path = fresh_path(spark, "metrics")
    artifacts.save_json(metrics.evaluate(scored_events(spark, d), "score", probability=None), path)
    back = artifacts.load_json(spark, path)
    return rounded(back, ["model", "tn", "fp", "fn", "tp"], ["recall", "precision", "f1"])


@query(
    "snk_ranking_csv",
    "SELECT event_type, count(*) AS row_count, round(avg(value) + 3e-9, 6) AS mean_value FROM events GROUP BY 1",
)
def _(spark, d):
    path = fresh_path(spark, "ranking")
    ranked = table(spark, d, "events").groupBy("event_type").agg(
        F.count("*").alias("row_count"), fixed(F.avg("value")).alias("mean_value")
    )
    artifacts.save_ranking(ranked, path, "mean_value", "event_type")
    return artifacts.load_csv(spark, path, ranked.schema)


@query(
    "snk_cached_result",
    "SELECT CAST(user_id AS VARCHAR) AS machine_id, round(max(value) + 3e-9, 6) AS top FROM events GROUP BY 1",
)
def _(spark, d):
    """The second call finds the stored result of the first."""
    base = fresh_path(spark, "cache")
    tops = table(spark, d, "events").groupBy(F.col("user_id").cast("string").alias("machine_id")).agg(
        fixed(F.max("value")).alias("top")
    )
    artifacts.cached(spark, base, "v1", "tops", lambda: tops)
    return artifacts.cached(spark, base, "v1", "tops", lambda: tops.limit(0))


@query(
    "job_data",
    f"""WITH log AS (SELECT epoch_us(ts) AS us FROM events WHERE NOT (event_type = 'view' AND value < 5)),
    edge AS ({_RANK}), {_SIDES} {_report_sql('sides')}""",
)
def _(spark, d):
    """CSV to saved train and test sets, then the report on what was saved."""
    out = fresh_path(spark, "data-job")
    log, rejects = ingest_pipeline(spark, _raw_csv(spark, d), EVENTS)
    run_pipeline(log, EVENTS, out, version="20240101_000000", rejects=rejects)
    sides = [
        artifacts.load_dataset(spark, f"{out}/datasets", side).withColumn("split", F.lit(side))
        for side in ("train", "test")
    ]
    return split.split_report(sides[0].unionByName(sides[1]), EVENTS)
