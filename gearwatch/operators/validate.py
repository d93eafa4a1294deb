"""Leakage checks. Each returns findings as data; ``validate_pipeline`` puts them together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.functions.columns import instant, named
from gearwatch.operators.schema import failure_column
from gearwatch.operators.target import failure_after_row, normalise_failure
from gearwatch.operators.timeline import US, Timeline
from gearwatch.options import LogOptions
from gearwatch.session import written

# Pieces of a feature name that hint at the future.
FORWARD_WORDS = ("future", "forward", "next", "ahead", "lead")


def time_order_violations(df: DataFrame, options: LogOptions) -> DataFrame:
    """Machines whose time goes back in row order, with the number of such steps.

    Row order is the first order column; machines are cut along it, not along time.
    """
    row = options.order[0]
    t = Timeline.measure(df, options, axis=row)
    df = t.attach(df).withColumn("_ts", instant(df, options.time))
    df = df.select(
        "*",
        F.lag("_ts").over(t.forward()).alias("_before"),
        F.row_number().over(t.forward()).alias("_rn"),
    )
    has_before = F.col("_rn") > 1
    before = F.col("_before")
    if t.split:
        df = t.carry(
            df,
            [F.max_by("_ts", F.struct(*t.order())).alias("_end")],
            [F.lag("_end").over(t.earlier()).alias("_end_before"), F.row_number().over(t.earlier()).alias("_sn")],
        )
        before = F.when(has_before, before).otherwise(F.col("_end_before"))
        has_before = has_before | (F.col("_sn") > 1)
    violated = has_before & ~F.coalesce(before <= F.col("_ts"), F.lit(False))
    return (
        df.filter(violated)
        .groupBy(named(options.machine).cast("string").alias("machine_id"))
        .agg(F.count("*").alias("violations"))
    )


def train_test_overlap(train: DataFrame, test: DataFrame, options: LogOptions) -> DataFrame:
    """Machines of both sets with their last train and first test instant."""
    m = named(options.machine).cast("string").alias("machine_id")
    last = train.groupBy(m).agg(F.max(instant(train, options.time)).alias("last_train_us"))
    first = test.groupBy(m).agg(F.min(instant(test, options.time)).alias("first_test_us"))
    return last.join(first, "machine_id").withColumn(
        "leaks", F.coalesce(F.col("last_train_us") >= F.col("first_test_us"), F.lit(False))
    )


def common_machines(train: DataFrame, test: DataFrame, options: LogOptions) -> DataFrame:
    m = named(options.machine).cast("string").alias("machine_id")
    return train.select(m).intersect(test.select(m))


def suspicious_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Feature names that hint at the future, with the word they contain."""
    names = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    words = F.filter(F.array(*map(F.lit, FORWARD_WORDS)), lambda w: F.contains(F.lower("feature"), w))
    return names.select("feature", F.explode(words).alias("word"))


def unexplained_labels(df: DataFrame, options: LogOptions) -> DataFrame:
    """Failing rows with label 1 that no later failing row inside the horizon explains."""
    column = failure_column(df, options)
    if column is None:
        raise ValueError("no failure column to check the labels against")
    df = normalise_failure(df, options)
    columns = df.columns
    t = Timeline.measure(df, options)
    df = failure_after_row(df, options, column, t)
    explained = F.coalesce(F.col("_next_row_fail") - F.col(US) <= options.horizon_us, F.lit(False))
    flagged = (named(options.target) == 1) & named(column) & ~explained
    return df.filter(flagged).select(*map(named, columns))


def feature_prefix_mismatches(df: DataFrame, options: LogOptions, make, cut_us: int, keys: list[str]) -> DataFrame:
    """Rows whose features change when all later rows are cut off.

    An addition of ours: backward-looking features must not notice the cut.
    """
    early = instant(df, options.time) <= F.lit(cut_us)
    whole = make(df).filter(early)
    prefix = make(df.filter(early))
    return whole.exceptAll(prefix.select(*map(named, whole.columns))).select(*keys)


def validate_pipeline(
    train: DataFrame, test: DataFrame, options: LogOptions, features: list[str] | None = None
) -> DataFrame:
    """All checks as one table of findings; a check without findings has one passing row.

    Time order and train/test overlap fail; suspicious names and unexplained labels warn.
    """
    spark = train.sparkSession
    checks, parts = [], []

    def add(check: str, found: DataFrame, machine, detail, warn: bool) -> None:
        checks.append((check,))
        parts.append(
            found.select(
                F.lit(check).alias("check_name"),
                machine.cast("string").alias("machine_id"),
                F.lit(warn).alias("passed"),
                F.lit("warn" if warn else "error").alias("severity"),
                detail.alias("detail"),
            )
        )

    for side, df in (("train", train), ("test", test)):
        add(
            f"time_order_{side}", time_order_violations(df, options), F.col("machine_id"),
            F.format_string("%d steps back in time", F.col("violations")), False,
        )
    ends = train.agg(F.max(instant(train, options.time)).alias("us"), F.lit("last").alias("side")).unionByName(
        test.agg(F.min(instant(test, options.time)).alias("us"), F.lit("first").alias("side"))
    )
    border = ends.agg(
        F.max(F.when(F.col("side") == "last", F.col("us"))).alias("last_train_us"),
        F.max(F.when(F.col("side") == "first", F.col("us"))).alias("first_test_us"),
    ).filter("last_train_us >= first_test_us")
    add("train_before_test", border, F.lit(None), F.lit("sets overlap in time"), False)
    overlap = train_test_overlap(train, test, options).filter("leaks")
    add("train_before_test_per_machine", overlap, F.col("machine_id"), F.lit("sets overlap in time"), False)
    if features:
        add(
            "feature_names", suspicious_features(train, features), F.lit(None),
            F.format_string("%s contains %s", F.col("feature"), F.col("word")), True,
        )
    if options.target in train.columns and failure_column(train, options):
        add(
            "labels", unexplained_labels(train, options), named(options.machine),
            F.lit("label without later failure in the horizon"), True,
        )
    # Findings are read twice, as rows and to tell which checks have none: written once, together.
    findings = written(reduce(DataFrame.unionByName, parts), "findings")
    every = spark.createDataFrame(checks, "check_name string")
    clean = every.join(findings, "check_name", "left_anti").select(
        "check_name",
        F.lit(None).cast("string").alias("machine_id"),
        F.lit(True).alias("passed"),
        F.lit("ok").alias("severity"),
        F.lit("").alias("detail"),
    )
    return findings.unionByName(clean)


def all_passed(findings: DataFrame) -> bool:
    return findings.agg(F.bool_and("passed")).first()[0]


def bag_union(train: DataFrame, test: DataFrame) -> DataFrame:
    """All rows of both sets, duplicates kept."""
    return train.unionByName(test)
