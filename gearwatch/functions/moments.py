"""Count, mean and squared deviation as one mergeable struct."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def moments(value: Column, over=None) -> Column:
    """``struct(n, mean, m2)`` of the non-null values, as an aggregate or over a window."""
    parts = (F.count(value), F.sum(value), F.var_pop(value))
    if over is not None:
        parts = tuple(p.over(over) for p in parts)
    n, total, variance = parts
    return F.struct(
        n.cast("double").alias("n"),
        F.when(n > 0, total / n).otherwise(F.lit(0.0)).alias("mean"),
        F.coalesce(variance * n, F.lit(0.0)).alias("m2"),
    )


def no_moments() -> Column:
    return F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))


def merge(a: Column, b: Column) -> Column:
    """Pairwise update of Chan, Golub and LeVeque; exact zero spread stays exact zero."""
    n = a["n"] + b["n"]
    delta = b["mean"] - a["mean"]
    share = F.when(n > 0, b["n"] / n).otherwise(F.lit(0.0))
    mean = F.when(a["n"] == 0, b["mean"]).otherwise(a["mean"] + delta * share)
    spread = F.when((a["n"] == 0) | (b["n"] == 0), F.lit(0.0)).otherwise(delta * delta * a["n"] * share)
    return F.struct(n.alias("n"), mean.alias("mean"), (a["m2"] + b["m2"] + spread).alias("m2"))


def merge_all(parts: Column) -> Column:
    return F.aggregate(parts, no_moments(), merge)


def mean_of(m: Column) -> Column:
    return F.when(m["n"] > 0, m["mean"])


def sample_std_of(m: Column) -> Column:
    return F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1)))
