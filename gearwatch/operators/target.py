"""The failure flag and the label made from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearwatch.functions.columns import is_flag_word, is_true_word, named, parse_number
from gearwatch.operators.schema import failure_column
from gearwatch.operators.timeline import US, Step, Timeline, before_current
from gearwatch.options import LogOptions


def failure_flag(df: DataFrame, column: str, options: LogOptions) -> Column:
    """Boolean expression for a failure column of any type.

    Text is read as yes/no words when all its values are such words, else as numbers;
    that needs one aggregate over the column.
    """
    c = named(column)
    kind = df.schema[column].dataType
    missing = F.lit(options.missing_is_failure)
    if isinstance(kind, T.BooleanType):
        return F.coalesce(c, missing)
    if isinstance(kind, T.NumericType):
        return F.coalesce(c != 0, missing)
    words_only = is_flag_word(c)
    if options.missing_is_failure:
        words_only = F.coalesce(words_only, F.lit(False))
    if df.agg(F.coalesce(F.bool_and(words_only), F.lit(True))).first()[0]:
        return F.coalesce(is_true_word(c), F.lit(False))
    return F.coalesce(parse_number(c), F.lit(0.0)) != 0


def normalise_failure(df: DataFrame, options: LogOptions) -> DataFrame:
    """Replace the failure column by its boolean form."""
    column = failure_column(df, options)
    if column is None:
        return df
    flag = failure_flag(df, column, options)
    return df.select(*[flag.alias(c) if c == column else named(c) for c in df.columns])


def create_target(
    df: DataFrame,
    options: LogOptions,
    timeline: Timeline | None = None,
    observed: str | None = None,
) -> DataFrame:
    """Label 1 where the machine fails within (t, t + horizon].

    A machine with a single row takes its own failure flag. Without any failure column
    all labels are 0. ``observed`` names an extra column that tells whether the log
    covers the horizon of the row.
    """
    column = failure_column(df, options)
    if column is None:
        return df.withColumn(options.target, F.lit(0))
    df = normalise_failure(df, options)
    t = timeline or Timeline.measure(df, options)
    columns = [c for c in df.columns if c != options.target]
    return t.run(df, [target_step(df, options, t, observed)], [*map(named, columns)])


def target_step(df: DataFrame, options: LogOptions, t: Timeline, observed: str | None = None) -> Step:
    """The label of a log whose failure column, if any, is normalised."""
    column = failure_column(df, options)
    if column is None:
        return Step(lambda rows: rows, [F.lit(0).alias(options.target)])
    failed_at = F.when(named(column), F.col(US))
    later = t.by_instant_desc().rangeBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*t.keys)

    def inside(rows: DataFrame) -> DataFrame:
        return rows.select(
            "*",
            F.min(failed_at).over(later).alias("_next"),
            F.count("*").over(group).alias("_rows"),
            F.max(US).over(group).alias("_end"),
        )

    def chain(states: DataFrame) -> DataFrame:
        machine = Window.partitionBy("_m")
        return states.select(
            "*",
            F.last("_fail", ignorenulls=True).over(before_current(t.later())).alias("_later_fail"),
            F.sum("_held").over(machine).alias("_all"),
            F.max("_hi").over(machine).alias("_all_end"),
        )

    next_failure, rows, end = F.col("_next"), F.col("_rows"), F.col("_end")
    if t.split:
        next_failure, rows, end = F.coalesce(next_failure, F.col("_later_fail")), F.col("_all"), F.col("_all_end")
    soon = F.coalesce(next_failure - F.col(US) <= F.lit(options.horizon_us), F.lit(False))
    out = [F.when(rows == 1, named(column)).otherwise(soon).cast("int").alias(options.target)]
    if observed:
        out.append((soon | (F.col(US) + F.lit(options.horizon_us) <= end)).alias(observed))
    summary = [F.min(failed_at).alias("_fail"), F.count("*").alias("_held"), F.max(US).alias("_hi")]
    return Step(inside, out, summary, chain, ["_later_fail", "_all", "_all_end"])


def target_by_join(df: DataFrame, options: LogOptions) -> DataFrame:
    """Rows with a failure within (t, t + horizon], by an interval semi join.

    A second way to the label, for checks. Time is cut into horizon-wide cells. Of the
    failures in a row's own cell only the last one matters, of those in the next cell only
    the first, so failures shrink to one row per machine and cell and the join is an equi
    join that compares each reading once.
    """
    column = failure_column(df, options)
    df = normalise_failure(df, options)
    t = Timeline(options, None, 0, 0, (0, 0), None)
    keyed = t.attach(df).withColumn("_cell", F.floor(F.col(US) / options.horizon_us))
    failures = (
        keyed.filter(named(column))
        .groupBy(named(options.machine).alias("_fm"), F.col("_cell").alias("_c"))
        .agg(F.min(US).alias("_first"), F.max(US).alias("_last"))
    )
    nothing = F.lit(None).cast("long")
    sides = F.array(
        F.struct(F.col("_c").alias("cell"), F.col("_last").alias("last"), nothing.alias("first")),
        F.struct((F.col("_c") - 1).alias("cell"), nothing.alias("last"), F.col("_first").alias("first")),
    )
    failures = (
        failures.select("_fm", F.inline(sides))
        .groupBy("_fm", "cell")
        .agg(F.max("last").alias("_last"), F.min("first").alias("_first"))
    )
    within = (
        named(options.machine).eqNullSafe(F.col("_fm"))
        & (F.col("_cell") == F.col("cell"))
        & ((F.col("_last") > F.col(US)) | (F.col("_first") - F.col(US) <= options.horizon_us))
    )
    return keyed.join(failures, within, "left_semi").drop(US, "_cell")


def failure_after_row(df: DataFrame, options: LogOptions, column: str, t: Timeline) -> DataFrame:
    """Adds ``_next_row_fail``: instant of the first failing row after this row in row order."""
    df = t.attach(df)
    failed_at = F.when(named(column), F.col(US))
    df = df.withColumn(
        "_next_row_fail", F.last(failed_at, ignorenulls=True).over(before_current(t.backward()))
    )
    if t.split:
        df = t.carry(
            df,
            [F.min(failed_at).alias("_fail")],
            [F.last("_fail", ignorenulls=True).over(before_current(t.later())).alias("_later_fail")],
        )
        df = df.withColumn("_next_row_fail", F.coalesce("_next_row_fail", "_later_fail")).drop("_later_fail")
    return df


def target_summary(df: DataFrame, options: LogOptions) -> DataFrame:
    """Rows, positive labels and their share, failures, and the misfit flag."""
    column = failure_column(df, options)
    failures = F.count_if(named(column)) if column else F.lit(0).cast("long")
    positives = F.coalesce(F.sum(named(options.target)).cast("long"), F.lit(0).cast("long"))
    return df.agg(
        F.count("*").alias("row_count"),
        positives.alias("positives"),
        F.coalesce(F.avg(named(options.target)), F.lit(0.0)).alias("positive_rate"),
        failures.alias("failures"),
        ((failures > 0) & (positives == 0)).alias("failures_without_labels"),
    )

