"""The given tables seen as sensor logs, scored rows and requests; Spark and SQL side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.functions.columns import fixed, named
from gearwatch.options import LogOptions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- events: one reading of two sensors per row -------------------------------------

EVENTS = LogOptions()
SENSORS = ["value", "k"]


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("machine_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("seq"),
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        (F.col("event_type") == "error").alias("failure"),
    )


LOG_SQL = """log AS (
  SELECT CAST(user_id AS VARCHAR) AS machine_id, epoch_us(ts) AS us, event_id AS seq, value,
         CAST(regexp_extract(props, '"k": *(-?[0-9.]+)', 1) AS DOUBLE) AS k,
         event_type = 'error' AS failure
  FROM events)"""

# --- lineitem: many readings of one machine at one instant ---------------------------

LINES_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)
DAY = 86_400
LINES = LogOptions(order=LINES_ORDER, windows=(("7d", 7 * DAY), ("30d", 30 * DAY)), horizon_hours=24 * 30)


def lines_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("machine_id"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        *LINES_ORDER,
        F.col("l_quantity").alias("quantity"),
        (F.col("l_returnflag") == "R").alias("failure"),
    )


LINES_SQL = f"""lines AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS machine_id, epoch_us(l_shipdate) AS us, l_quantity AS quantity,
         l_returnflag = 'R' AS failure, {", ".join(LINES_ORDER)},
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, {", ".join(LINES_ORDER)}) AS rn
  FROM lineitem)"""

# --- events as rows with a label and a probability ------------------------------------


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.least(F.col("value") / F.lit(200.0), F.lit(1.0))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("label"),
        p.alias("probability"),
        F.when(p > 0.5, 1).otherwise(0).alias("prediction"),
    )


SCORED_SQL = """scored AS (
  SELECT event_id AS row_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
         least(value / 200.0::DOUBLE, 1.0::DOUBLE) AS probability,
         CASE WHEN least(value / 200.0::DOUBLE, 1.0::DOUBLE) > 0.5 THEN 1 ELSE 0 END AS prediction
  FROM events)"""

# --- events as scoring requests ---------------------------------------------------------


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records; some event types lack a field, hold a text for a number or are no JSON."""
    e = table(spark, sf_dir, "events")
    number = lambda c: c.cast("decimal(18,6)").cast("string")
    k = F.get_json_object("props", "$.k").cast("double")
    body = F.concat(
        F.lit('{"machine_id": "M_'), F.col("user_id").cast("string"),
        F.lit('", "temperature": '), number(F.col("value")),
        F.lit(', "pressure": '), number(k / 40.0),
        F.when((F.col("event_type") == "signup") & (F.col("value") > 100), "")
        .when((F.col("event_type") == "view") & (F.col("value") > 100), ', "vibration": "shaky"')
        .when((F.col("event_type") == "click") & (F.col("value") > 100), ', "vibration": -200000.5')
        .otherwise(F.concat(F.lit(', "vibration": '), number(k / 4000.0))),
        F.when((F.col("event_type") == "purchase") & (F.col("value") > 100), "").otherwise("}"),
    )
    return e.select(F.col("event_id").alias("request_id"), body.alias("body"))


REQUESTS_SQL = """base AS (
  SELECT event_id AS request_id, 'M_' || CAST(user_id AS VARCHAR) AS machine_id, event_type, value,
         CAST(regexp_extract(props, '"k": *(-?[0-9.]+)', 1) AS DOUBLE) AS k FROM events),
requests AS (
  SELECT request_id, machine_id,
         CAST(CAST(value AS DECIMAL(18,6)) AS DOUBLE) AS temperature,
         CAST(CAST(k / 40.0::DOUBLE AS DECIMAL(18,6)) AS DOUBLE) AS pressure,
         CAST(CAST(k / 4000.0::DOUBLE AS DECIMAL(18,6)) AS DOUBLE) AS vibration,
         CASE WHEN value > 100 THEN CASE event_type
                WHEN 'purchase' THEN 'not a JSON object'
                WHEN 'signup' THEN 'vibration is missing'
                WHEN 'view' THEN 'vibration is not numeric'
                WHEN 'click' THEN 'vibration is out of range' END END AS reason
  FROM base)"""

# --- output helpers -----------------------------------------------------------------------


def rounded(df: DataFrame, keys: list[str], numbers: list[str], rename: dict[str, str] | None = None) -> DataFrame:
    """Keys and rounded numbers; dots in names become underscores."""
    names = rename or {}
    return df.select(
        *[named(k) for k in keys],
        *[fixed(named(c)).alias(names.get(c, c.replace(".", "_"))) for c in numbers],
    )


def r6(expression: str) -> str:
    """SQL twin of ``fixed``."""
    return f"round(({expression}) + 3e-9, 6)"
