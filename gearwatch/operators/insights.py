"""Readable explanations: feature names, sentences, summaries, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gearwatch.functions.columns import named, once
from gearwatch.operators.metrics import risk_band

# Sensors and operations a feature name may hold, first hit wins.
SENSORS = ("temperature", "pressure", "vibration", "rpm", "voltage", "current")
OPERATIONS = ("lag", "rolling_mean", "rolling_std", "ema")
# Lead-in, with sensor and window filled in, and the label of the number.
SENTENCES = {
    "lag": ("%s from %s", "value"),
    "rolling_mean": ("%s average over %s", "mean"),
    "rolling_std": ("%s variability over %s", "std"),
    "ema": ("%s trend (%s)", "value"),
    "raw": ("%s", "value"),
}

_FLOAT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _first_part(name: Column, keep) -> Column:
    """First piece of a name split at underscores that ``keep`` accepts, else null."""
    return F.get(F.filter(F.split(name, "_"), keep), F.lit(0))


def parsed_feature_names(df: DataFrame, column: str = "feature") -> DataFrame:
    """Adds ``sensor``, ``operation`` and ``time_window`` of a feature name."""
    name = named(column)
    lower = F.lower(name)

    def first_of(words: tuple[str, ...], default: str) -> Column:
        hits = [F.when(F.contains(lower, F.lit(w)), F.lit(w)) for w in words]
        return F.coalesce(*hits, F.lit(default))

    steps = _first_part(name, lambda p: p.rlike(r"^\d+$"))
    span = _first_part(name, lambda p: F.contains(F.lower(p), F.lit("h")))
    alpha = _first_part(name, lambda p: p.rlike(_FLOAT)).cast("double").cast("string")
    window = (
        F.when(F.contains(lower, F.lit("lag")), F.concat(steps, F.lit(" time step(s) ago")))
        .when(F.contains(lower, F.lit("rolling")), span)
        .when(F.contains(lower, F.lit("ema")), F.concat(F.lit("EMA (alpha="), alpha, F.lit(")")))
    )
    return df.select(
        "*",
        first_of(SENSORS, "unknown").alias("sensor"),
        first_of(OPERATIONS, "raw").alias("operation"),
        F.coalesce(window, F.lit("current")).alias("time_window"),
    )


def feature_phrases(spark: SparkSession, features: list[str]) -> list[tuple[str, str]]:
    """(lead-in, number label) per feature; one row per feature of a model."""
    names = spark.createDataFrame(list(enumerate(features)), "place int, feature string")
    phrases = []
    for r in sorted(parsed_feature_names(names).collect(), key=lambda r: r["place"]):
        pattern, label = SENTENCES[r["operation"]]
        words = (r["sensor"].capitalize(), r["time_window"])[: pattern.count("%s")]
        phrases.append((pattern % words, label))
    return phrases


def sentence(lead: Column, label: Column, value: Column, attribution: Column, note: Column) -> Column:
    """One sentence on one feature; ``note`` is the threshold remark or empty."""
    direction = F.when(attribution > 0, "increased").otherwise("decreased")
    return F.concat(
        lead, F.lit(" "), direction, F.lit(" failure risk ("), label, F.lit(": "),
        F.format_string("%.2f", value), note, F.lit(")"),
    )


def feature_sentences(
    df: DataFrame, thresholds: dict[str, dict[str, float]] | None = None
) -> DataFrame:
    """Adds ``explanation`` to (feature, value, attribution) rows."""
    parsed = parsed_feature_names(df)
    operation, sensor, window = F.col("operation"), F.initcap("sensor"), F.col("time_window")
    lead, label = sensor, F.lit("value")
    for name, (pattern, number) in SENTENCES.items():
        if name == "raw":
            continue
        lead = F.when(operation == name, F.format_string(pattern, sensor, window)).otherwise(lead)
        label = F.when(operation == name, F.lit(number)).otherwise(label)
    note = F.lit("")
    for feature, bounds in (thresholds or {}).items():
        note = F.when(named("feature") == feature, _note(named("value"), bounds)).otherwise(note)
    text = sentence(lead, label, named("value"), named("attribution"), note)
    return parsed.withColumn("explanation", text)


def _note(value: Column, bounds: dict[str, float]) -> Column:
    note = F.lit("")
    if "max" in bounds:
        note = F.when(value > bounds["max"], F.lit(f" (exceeding safe maximum of {bounds['max']})")).otherwise(note)
    if "min" in bounds:
        note = F.when(value < bounds["min"], F.lit(f" (below safe minimum of {bounds['min']})")).otherwise(note)
    return note


def with_explanations(
    df: DataFrame,
    features: list[str],
    thresholds: dict[str, dict[str, float]] | None = None,
    top_n: int = 5,
    probability: str = "probability",
    inclusive_bands: bool = False,
) -> DataFrame:
    """Adds risk_level, top_features, positive_factors, negative_factors and summary.

    Needs ``values`` and ``attributions`` in feature order. The top features are those of
    largest absolute attribution; among equals the later feature comes first.
    """
    phrases = feature_phrases(df.sparkSession, features)
    texts = lambda parts: F.array(*map(F.lit, parts))
    names, leads, labels = texts(features), texts([p[0] for p in phrases]), texts([p[1] for p in phrases])
    notes = F.array(
        *[_note(F.col("values")[i], (thresholds or {}).get(f, {})) for i, f in enumerate(features)]
    )
    sized = F.transform(
        F.sequence(F.lit(0), F.lit(len(features) - 1)),
        lambda i: F.struct(F.abs(F.col("attributions")[i]).alias("size"), i.alias("i")),
    )
    top = F.slice(F.sort_array(sized, asc=False), 1, top_n)

    def factor(s: Column) -> Column:
        i = s["i"]
        value, attribution = F.get("values", i), F.get("attributions", i)
        return F.struct(
            F.get(names, i).alias("feature"),
            value.alias("value"),
            attribution.alias("shap_value"),
            sentence(F.get(leads, i), F.get(labels, i), value, attribution, F.get(notes, i)).alias("explanation"),
        )

    p = named(probability)
    df = once(df, "top_features", F.transform(top, factor))
    df = df.withColumn("risk_level", risk_band(p, inclusive_bands))
    df = df.withColumn("positive_factors", F.filter("top_features", lambda f: f["shap_value"] > 0))
    df = df.withColumn("negative_factors", F.filter("top_features", lambda f: f["shap_value"] <= 0))
    return df.withColumn("summary", _summary(p))


def _summary(p: Column) -> Column:
    def listed(column: str, title: str) -> Column:
        lines = F.transform(
            F.col(column),
            lambda f, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), f["explanation"], F.lit("\n")),
        )
        return F.when(F.size(column) > 0, F.concat(F.lit(title), F.array_join(lines, ""))).otherwise("")

    head = F.concat(
        F.lit("Failure risk is "), F.col("risk_level"), F.lit(" (probability: "),
        F.format_string("%.1f%%", p * 100), F.lit(").\n\n"),
    )
    return F.concat(
        head,
        listed("positive_factors", "Failure risk increased due to:\n"),
        listed("negative_factors", "\nFailure risk decreased due to:\n"),
    )


def broken_rules(top_n: int, probability: str = "probability") -> Column:
    """Rules of explanations a row breaks; empty when all is well."""
    sizes = F.transform("top_features", lambda f: F.abs(f["shap_value"]))
    return F.array_compact(
        F.array(
            F.when(~named(probability).between(0, 1), "probability outside 0..1"),
            F.when(F.size("positive_factors") + F.size("negative_factors") == 0, "no factor"),
            F.when(F.size("top_features") != top_n, "wrong number of top features"),
            F.when(sizes != F.reverse(F.array_sort(sizes)), "top features out of order"),
        )
    )


def explanation_checks(df: DataFrame, top_n: int, probability: str = "probability") -> DataFrame:
    """Rows checked and rows that break a rule."""
    broken = F.size(broken_rules(top_n, probability)) > 0
    return df.agg(F.count("*").alias("checked"), F.count_if(broken).alias("broken"))


def report_lines(scored: DataFrame, explained_top: DataFrame, ids: list[str], with_labels: bool = True) -> DataFrame:
    """(line_no, line) report: risk distribution, check against labels, the riskiest rows.

    ``explained_top`` holds the few explained rows with ``place`` 1..k.
    """
    p = F.col("probability")
    bands = {
        "high": ("  High Risk (>70%):   ", p > 0.7),
        "medium": ("  Medium Risk (30-70%): ", (p > 0.3) & (p <= 0.7)),
        "low": ("  Low Risk (<30%):    ", p <= 0.3),
    }
    counts = [F.count("*").alias("n")] + [F.count_if(test).alias(k) for k, (_, test) in bands.items()]
    if with_labels:
        y = F.col("label")
        counts += [
            F.count_if((p > 0.5) & (y == 1)).alias("tp"),
            F.count_if((p > 0.5) & (y == 0)).alias("fp"),
            F.count_if((p <= 0.5) & (y == 1)).alias("fn"),
        ]
    rule, title = "=" * 80, lambda t: [F.lit("=" * 80), F.lit(t), F.lit("=" * 80), F.lit("")]
    band_lines = [
        F.concat(
            F.lit(text), F.col(k).cast("string"), F.lit(" machines ("),
            F.format_string("%.1f%%", F.coalesce(F.try_divide(F.col(k) * 100.0, F.col("n").cast("double")), F.lit(0.0))),
            F.lit(")"),
        )
        for k, (text, _) in bands.items()
    ]
    lines = [*title("Model Interpretability Report"), F.lit("Overall Risk Distribution:"), *band_lines, F.lit("")]
    if with_labels:
        lines += [
            F.lit("Prediction Validation:"),
            F.concat(F.lit("  True Positives:  "), F.col("tp").cast("string")),
            F.concat(F.lit("  False Positives: "), F.col("fp").cast("string")),
            F.concat(F.lit("  False Negatives: "), F.col("fn").cast("string")),
            F.lit(""),
        ]
    lines += title("Top High-Risk Machines - Detailed Explanations")
    head = scored.agg(*counts).select(F.lit(0).alias("place"), F.array(*lines).alias("lines"))
    row_name = F.concat_ws(" ", *[named(c).cast("string") for c in ids])
    body = explained_top.select(
        F.col("place").cast("int"),
        F.flatten(
            F.array(
                F.array(
                    F.concat(F.lit("Machine #"), F.col("place").cast("string"), F.lit(" (Instance "), row_name, F.lit("):")),
                    F.concat(F.lit("  Risk Level: "), F.col("risk_level")),
                    F.concat(F.lit("  Failure Probability: "), F.format_string("%.1f%%", p * 100)),
                    F.lit(""),
                ),
                F.split("summary", "\n"),
                F.array(F.lit(""), F.lit("-" * len(rule)), F.lit("")),
            )
        ).alias("lines"),
    )
    placed = head.unionByName(body).select("place", F.posexplode("lines").alias("at", "line"))
    # A report holds some hundred lines whatever the data.
    return placed.select(F.row_number().over(Window.orderBy("place", "at")).alias("line_no"), "line")


def high_risk_rows(scored: DataFrame, ids: list[str], k: int = 5) -> DataFrame:
    """The k riskiest rows with ``place`` 1..k."""
    top = scored.orderBy(F.desc("probability"), *ids).limit(k)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("probability"), *ids)))
