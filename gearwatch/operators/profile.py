"""Counts that describe a log or a training set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearwatch.functions.columns import instant, named
from gearwatch.options import LogOptions


def rows_per_machine(df: DataFrame, options: LogOptions) -> DataFrame:
    """Row count per machine and whether the machine has one row only."""
    counts = df.groupBy(named(options.machine).alias("machine_id")).agg(F.count("*").alias("row_count"))
    return counts.withColumn("single_row", F.col("row_count") == 1)


def ingest_profile(df: DataFrame, options: LogOptions) -> DataFrame:
    """Rows, columns, time range and machines, in one aggregate per machine and one over those."""
    us = instant(df, options.time)
    per_machine = df.groupBy(named(options.machine).alias("m")).agg(
        F.count("*").alias("n"), F.min(us).alias("lo"), F.max(us).alias("hi")
    )
    return per_machine.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.min("lo").alias("first_us"),
        F.max("hi").alias("last_us"),
        F.count("m").alias("machines"),
    )


def distinct_machines(df: DataFrame, options: LogOptions) -> DataFrame:
    return df.select(named(options.machine).alias("machine_id")).distinct()


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(named(label).cast("long").alias("label")).agg(F.count("*").alias("row_count"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows, balanced weights n / (2 n_c) and the neg/pos ratio, in one row.

    The ratio is 1 when a class is absent, and an absent class has no balanced weight.
    """
    y = named(label)
    counts = df.agg(F.count_if(y == 0).alias("negatives"), F.count_if(y == 1).alias("positives"))
    n = F.col("negatives") + F.col("positives")

    def balanced(c: Column) -> Column:
        return F.when(c > 0, n / (F.lit(2.0) * c))

    ratio = F.when(
        (F.col("negatives") > 0) & (F.col("positives") > 0), F.col("negatives") / F.col("positives")
    ).otherwise(F.lit(1.0))
    return counts.select(
        "negatives",
        "positives",
        balanced(F.col("negatives")).alias("weight_negative"),
        balanced(F.col("positives")).alias("weight_positive"),
        ratio.alias("negative_positive_ratio"),
    )
