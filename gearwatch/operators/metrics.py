"""Evaluation of scored rows: all from grouped counts, never from collected predictions."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearwatch.functions.columns import named
from gearwatch.session import written

# Metric names callers may rank by, and the column each stands for.
METRIC_COLUMNS = {
    "recall": "recall",
    "precision": "precision",
    "f1": "f1",
    "f1-score": "f1",
    "roc_auc": "roc_auc",
    "roc-auc": "roc_auc",
}
# Distinct scores per bucket of the AUC, and the most buckets.
AUC_BUCKET_SCORES = 500_000
AUC_BUCKETS = 10_000


def confusion_matrix(df: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    """One row tn, fp, fn, tp; cells of absent classes are 0.

    A missing prediction claims no failure; rows without a label cannot be judged and are left out.
    """
    y, p = named(label) == 1, F.coalesce(named(predicted) == 1, F.lit(False))
    return df.agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(F.lit(2.0) * precision * recall, precision + recall)


def classification_metrics(confusion: DataFrame) -> DataFrame:
    """Adds recall, precision and f1 of the positive class; a zero denominator gives 0."""
    precision = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return confusion.select(
        "*", recall.alias("recall"), precision.alias("precision"), _f1(precision, recall).alias("f1")
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """Exact, tie-aware area under the ROC curve; 0 when a class is absent or a score missing.

    Rows are first grouped by score. Many distinct scores are cut at quantiles into
    buckets, the negatives below a score are counted inside its bucket, and bucket totals
    (at most AUC_BUCKETS rows) supply the rest, so no sort of all scores runs in one task.
    """
    scores = (
        df.groupBy(named(score).cast("double").alias("s"))
        .agg(F.count_if(named(label) == 1).alias("pos"), F.count_if(named(label) != 1).alias("neg"))
    )
    scores = written(scores, "scores")
    known = scores.agg(F.count("*").alias("n"), F.count_if(F.col("s").isNull()).alias("missing")).first()
    scores = scores.filter(F.col("s").isNotNull())
    if known["missing"]:
        return scores.sparkSession.createDataFrame([(0.0,)], "roc_auc double")
    buckets = min(AUC_BUCKETS, known["n"] // AUC_BUCKET_SCORES + 1)
    if buckets == 1:
        bucketed = scores.withColumn("bucket", F.lit(0.0))
    else:
        ranks = [i / buckets for i in range(1, buckets)]
        cuts = sorted(set(scores.approxQuantile("s", ranks, 0.25 / buckets)))
        splits = [float("-inf"), *cuts, float("inf")]
        bucketed = Bucketizer(splits=splits, inputCol="s", outputCol="bucket").transform(scores)
    inside = Window.partitionBy("bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    totals = bucketed.groupBy("bucket").agg(F.sum("neg").alias("neg"))
    lower = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("bucket", F.coalesce(F.sum("neg").over(lower), F.lit(0)).alias("below"))
    ranked = bucketed.withColumn("inside", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    ranked = ranked.join(F.broadcast(totals), "bucket")  # at most AUC_BUCKETS rows
    wins = F.col("pos").cast("double") * (F.col("below") + F.col("inside") + F.col("neg") / F.lit(2.0))
    sums = ranked.agg(F.sum(wins).alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return sums.select(area_of("wins", "p", "n").alias("roc_auc"))


def area_of(wins: str, positives: str, negatives: str) -> Column:
    """Share of won pairs. Pairs of a large log exceed a LONG, so they are counted in doubles."""
    return _ratio(F.col(wins), F.col(positives).cast("double") * F.col(negatives).cast("double"))


def per_class_report(df: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    """precision, recall, f1 and support for 0, 1, accuracy, macro avg and weighted avg."""
    c = confusion_matrix(df, label, predicted)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))

    def entry(name: str, hit: Column, claimed: Column, actual: Column) -> Column:
        precision, recall = _ratio(hit, claimed), _ratio(hit, actual)
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            _f1(precision, recall).alias("f1"),
            actual.alias("support"),
        )

    two = c.select(
        F.array(entry("0", tn, tn + fn, tn + fp), entry("1", tp, tp + fp, tp + fn)).alias("classes"),
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        (tn + fp + fn + tp).alias("total"),
    )
    a, b = F.col("classes")[0], F.col("classes")[1]

    def mean(field: str, weighted: bool) -> Column:
        if not weighted:
            return (a[field] + b[field]) / 2.0
        return _ratio(a[field] * a["support"] + b[field] * b["support"], F.col("total"))

    def average(name: str, weighted: bool) -> Column:
        fields = [mean(f, weighted).alias(f) for f in ("precision", "recall", "f1")]
        return F.struct(F.lit(name).alias("class"), *fields, F.col("total").alias("support"))

    accuracy = F.struct(
        F.lit("accuracy").alias("class"),
        *[F.col("accuracy").alias(f) for f in ("precision", "recall", "f1")],
        F.col("total").alias("support"),
    )
    rows = F.concat(F.col("classes"), F.array(accuracy, average("macro avg", False), average("weighted avg", True)))
    return two.select(F.inline(rows))


def risk_band(probability: Column, inclusive: bool = False) -> Column:
    """HIGH / MEDIUM / LOW at 0.7 and 0.3; reports leave the bounds out, the scorer includes them."""
    if inclusive:
        return F.when(probability >= 0.7, "HIGH").when(probability >= 0.3, "MEDIUM").otherwise("LOW")
    return F.when(probability > 0.7, "HIGH").when(probability > 0.3, "MEDIUM").otherwise("LOW")


def risk_histogram(df: DataFrame, probability: str = "probability") -> DataFrame:
    """Rows and percent per band; all three bands appear."""
    band = risk_band(named(probability))
    counts = df.agg(*[F.count_if(band == b).alias(b) for b in ("HIGH", "MEDIUM", "LOW")])
    total = F.col("HIGH") + F.col("MEDIUM") + F.col("LOW")
    rows = F.array(
        *[
            F.struct(
                F.lit(b).alias("risk_level"),
                F.col(b).alias("row_count"),
                _ratio(F.col(b) * 100.0, total).alias("percent"),
            )
            for b in ("HIGH", "MEDIUM", "LOW")
        ]
    )
    return counts.select(F.inline(rows))


def threshold_counts(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """True/false positives and false negatives of ``probability > 0.5``."""
    y, p = named(label), named(probability)
    return df.agg(
        F.count_if((p > 0.5) & (y == 1)).alias("true_positives"),
        F.count_if((p > 0.5) & (y == 0)).alias("false_positives"),
        F.count_if((p <= 0.5) & (y == 1)).alias("false_negatives"),
    )


def evaluate(
    df: DataFrame,
    model_name: str,
    label: str = "label",
    predicted: str = "prediction",
    probability: str | None = "probability",
) -> DataFrame:
    """One row: model, confusion cells, recall, precision, f1, roc_auc."""
    one = classification_metrics(confusion_matrix(df, label, predicted)).withColumn("model", F.lit(model_name))
    if probability is None:
        return one.withColumn("roc_auc", F.lit(0.0))
    # Both sides are one-row aggregates.
    area = roc_auc(df, label, probability).withColumn("model", F.lit(model_name))
    return one.join(area, "model")


def compare_models(results: list[DataFrame], primary_metric: str = "recall") -> DataFrame:
    """Metric rows of all models, best first; an unknown metric falls back to recall."""
    by = METRIC_COLUMNS.get(primary_metric.lower(), "recall")
    table = reduce(DataFrame.unionByName, results)
    return table.select("model", "recall", "precision", "f1", "roc_auc").orderBy(F.desc(by), "model")
