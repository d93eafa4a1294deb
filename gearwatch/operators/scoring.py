"""Scoring of requests: validation, features, prediction, band, reasons.

Every step is a lazy column transformation, so one function serves batch and stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearwatch.functions.columns import named, once, parse_number
from gearwatch.operators.attribution import with_attributions
from gearwatch.operators.insights import with_explanations
from gearwatch.operators.metrics import risk_band
from gearwatch.operators.models import FailureModel

READINGS = ("temperature", "pressure", "vibration")
READING_LIMIT = 100_000.0

# Text fields, so that a bad number does not hide which field was bad.
REQUEST = T.StructType([T.StructField(c, T.StringType()) for c in ("machine_id", *READINGS, "_broken")])

# Bounds and labels of the simple reasons.
HOT, TIGHT, SHAKY = 80.0, 1.5, 0.015


def parse_requests(df: DataFrame, body: str = "value") -> DataFrame:
    """JSON records to typed fields plus ``reason``, null for a valid record.

    All fields must be there, the id a text, readings numbers or numeric texts of at most
    100000 in size.
    """
    raw = F.from_json(named(body), REQUEST, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    df = once(df, "_raw", raw)
    is_object = F.col("_raw").isNotNull() & F.col("_raw._broken").isNull() & F.ltrim(named(body)).startswith("{")
    number = {c: parse_number(F.col("_raw")[c]) for c in READINGS}
    problems = [
        F.when(~F.coalesce(is_object, F.lit(False)), "not a JSON object"),
        *[F.when(F.col("_raw")[c].isNull(), F.lit(f"{c} is missing")) for c in ("machine_id", *READINGS)],
        *[F.when(number[c].isNull(), F.lit(f"{c} is not numeric")) for c in READINGS],
        *[F.when(F.isnan(number[c]) | (F.abs(number[c]) > READING_LIMIT), F.lit(f"{c} is out of range")) for c in READINGS],
    ]
    return df.select(
        "*",
        F.col("_raw.machine_id").alias("machine_id"),
        *[number[c].alias(c) for c in READINGS],
        F.coalesce(*problems).alias("reason"),
    ).drop("_raw")


def valid_requests(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason")


def rejected_requests(parsed: DataFrame, body: str = "value") -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select(body, "reason")


def reading_for(feature: str) -> Column:
    """Current reading that stands in for a model feature, 0 where none fits.

    A plain name must start with the sensor; names of lags, rolling windows and averages
    may hold it anywhere.
    """
    lower = feature.lower()
    derived = any(word in lower for word in ("lag", "rolling", "ema"))
    for sensor in READINGS:
        if (derived and sensor in lower) or (not derived and lower.startswith(sensor)):
            return F.col(sensor)
    return F.lit(0.0)


def request_features(df: DataFrame, features: list[str]) -> DataFrame:
    """All model features made from the current readings; existing columns stay."""
    absent = [f for f in features if f not in df.columns]
    return df.select("*", *[reading_for(f).alias(f) for f in absent])


def fired_rules() -> Column:
    """Labels of the bounds the readings exceed."""
    return F.array_compact(
        F.array(
            F.when(F.col("temperature") > HOT, "High temperature"),
            F.when(F.col("pressure") > TIGHT, "Elevated pressure"),
            F.when(F.col("vibration") > SHAKY, "High vibration"),
        )
    )


def state_labels() -> Column:
    """One label per sensor, good or bad."""
    return F.array(
        F.when(F.col("temperature") > HOT, "High temperature").otherwise("Temperature within range"),
        F.when(F.abs(F.col("pressure") - 1.0) > 0.5, "Pressure instability").otherwise("Pressure stable"),
        F.when(F.col("vibration") > SHAKY, "Vibration trend").otherwise("Vibration normal"),
    )


def rule_factors(probability: Column) -> Column:
    """Reasons when an explanation failed: fired rules, else state labels when failure is likely."""
    fired = fired_rules()
    return F.slice(F.when(F.size(fired) > 0, fired).otherwise(likely_states(probability)), 1, 3)


def likely_states(probability: Column) -> Column:
    """State labels of a likely failure, else nothing."""
    return F.when(probability > 0.5, state_labels()).otherwise(F.array().cast("array<string>"))


def score_requests(
    valid: DataFrame, model: FailureModel, explain: bool = True, top_n: int = 5, trees: list | None = None
) -> DataFrame:
    """Adds failure_probability, risk_level, top_risk_factors and shap_explanations.

    Model features the frame lacks are made from the current readings; a frame that brings
    features from its history is scored on those. Without explanations, asked not to make them or
    unable to, the reasons are the state labels of a likely failure and nothing else. ``trees`` are
    those of ``model_trees``, where a model scores batch after batch.
    """
    kept = valid.columns
    scored = model.predict(request_features(valid, model.features))
    scored = scored.withColumn("failure_probability", F.col("probability"))
    if explain and model.kind != "baseline":
        explained = with_explanations(
            with_attributions(scored, model, trees), model.features, top_n=top_n, inclusive_bands=True
        )
        reasons = F.slice(F.transform("positive_factors", lambda f: f["explanation"]), 1, 3)
        if set(READINGS) <= set(kept):
            reasons = F.when(F.size(reasons) > 0, reasons).otherwise(likely_states(F.col("probability")))
        return explained.select(
            *[named(c) for c in kept],
            "failure_probability",
            "risk_level",
            reasons.alias("top_risk_factors"),
            F.slice("top_features", 1, 5).alias("shap_explanations"),
        )
    return scored.select(
        *[named(c) for c in kept],
        "failure_probability",
        risk_band(F.col("probability"), inclusive=True).alias("risk_level"),
        likely_states(F.col("probability")).alias("top_risk_factors"),
    )
