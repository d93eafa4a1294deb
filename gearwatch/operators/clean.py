"""Range check, gap filling and the counts that go with them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gearwatch.functions.columns import named
from gearwatch.operators.schema import range_checked_columns, sensor_columns
from gearwatch.operators.timeline import US, Timeline, before_current, up_to_current
from gearwatch.options import LogOptions
from gearwatch.session import written

METHODS = ("time", "linear", "forward")


def _impossible(name: str, options: LogOptions) -> Column:
    return (named(name) < F.lit(options.sensor_min)) | (named(name) > F.lit(options.sensor_max))


def remove_impossible_values(df: DataFrame, options: LogOptions, sensors: list[str] | None = None) -> DataFrame:
    """Readings outside [sensor_min, sensor_max] become null; rows stay."""
    chosen = set(range_checked_columns(df, options) if sensors is None else sensors)
    return df.select(
        *[
            F.when(~_impossible(c, options), named(c)).alias(c) if c in chosen else named(c)
            for c in df.columns
        ]
    )


def outlier_counts(df: DataFrame, options: LogOptions, sensors: list[str] | None = None) -> DataFrame:
    """Impossible values per column, plus a ``(total)`` row; one pass over the data."""
    chosen = range_checked_columns(df, options) if sensors is None else sensors
    counts = df.agg(*[F.count_if(_impossible(c, options)).alias(c) for c in chosen])
    return _long(counts, chosen, "outliers")


def missing_counts(df: DataFrame, sensors: list[str], name: str = "missing") -> DataFrame:
    counts = df.agg(*[F.count_if(named(c).isNull()).alias(c) for c in sensors])
    return _long(counts, sensors, name)


def _long(one_row: DataFrame, names: list[str], value: str) -> DataFrame:
    total = reduce(lambda a, b: a + b, [named(c) for c in names], F.lit(0).cast("long"))
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), named(c).alias(value)) for c in names],
        F.struct(F.lit("(total)").alias("column_name"), total.alias(value)),
    )
    return one_row.select(F.inline(pairs))


def missing_profile(before: DataFrame, after: DataFrame, sensors: list[str]) -> DataFrame:
    """Missing before, missing after and filled, per column and in total."""
    return (
        missing_counts(before, sensors, "missing_before")
        .join(missing_counts(after, sensors, "missing_after"), "column_name")
        .withColumn("filled", F.col("missing_before") - F.col("missing_after"))
    )


def interpolate_missing_values(
    df: DataFrame,
    options: LogOptions,
    sensors: list[str] | None = None,
    method: str = "time",
    timeline: Timeline | None = None,
) -> DataFrame:
    """Fill gaps per machine.

    ``time``: straight line in time between the neighbouring readings; ``linear``:
    straight line by row position; both fill leading and trailing gaps with the
    nearest reading, so they look ahead. ``forward`` carries the last reading on and
    never looks ahead.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    chosen = sensor_columns(df, options) if sensors is None else sensors
    if not chosen:
        return df
    t = timeline or Timeline.measure(df, options)
    columns = df.columns
    df = t.attach(df)
    if method == "linear":
        df = df.withColumn("_at", F.row_number().over(t.forward()).cast("long"))
    else:
        df = df.withColumn("_at", F.col(US))
    at = F.col("_at")

    def reading(c: str) -> Column:
        return F.when(named(c).isNotNull(), F.struct(at.alias("at"), named(c).cast("double").alias("x")))


    def nearest(df: DataFrame, side: str, order: WindowSpec) -> DataFrame:
        found = [F.last(reading(c), ignorenulls=True).over(up_to_current(order)) for c in chosen]
        return df.select("*", *[f.alias(f"{side}{i}") for i, f in enumerate(found)])

    # The nearest reading at or before, the last one at the same instant, the nearest at or
    # after. In this order the first two share an exchange and a sort.
    df = nearest(df, "_p", t.forward())
    if method == "time":
        peers = (
            Window.partitionBy(*t.keys, F.col(US))
            .orderBy(*[named(c) for c in options.order])
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        )
        df = df.select(
            "*", *[F.last(named(c), ignorenulls=True).over(peers).alias(f"_s{i}") for i, c in enumerate(chosen)]
        )
    df = nearest(df, "_q", t.backward())
    if t.split:
        df = _carry_readings(df, t, chosen, method)

    filled = {}
    for i, c in enumerate(chosen):
        p, q = F.col(f"_p{i}"), F.col(f"_q{i}")
        if method == "forward":
            between = p["x"]
        else:
            slope = (q["x"] - p["x"]) * (at - p["at"]) / (q["at"] - p["at"])
            between = F.when(p.isNull(), q["x"]).when(q.isNull(), p["x"]).otherwise(p["x"] + slope)
        same = [F.col(f"_s{i}").cast("double")] if method == "time" else []
        filled[c] = F.coalesce(named(c).cast("double"), *same, between)
    return df.select(*[filled[c].alias(c) if c in filled else named(c) for c in columns])


def _carry_readings(df: DataFrame, t: Timeline, chosen: list[str], method: str) -> DataFrame:
    """Readings of neighbouring segments where a segment has none on one side."""
    n = len(chosen)
    summary = [F.count("*").alias("_n")]
    for i in range(n):
        # The last row of a segment knows its last reading, the first row its first.
        summary.append(F.max_by(F.col(f"_p{i}"), F.struct(*t.order())).alias(f"_l{i}"))
        summary.append(F.min_by(F.col(f"_q{i}"), F.struct(*t.order())).alias(f"_f{i}"))
    offset = F.lit(0).cast("long")
    if method == "linear":
        offset = F.coalesce(F.sum("_n").over(before_current(t.earlier())), F.lit(0)).cast("long")

    def shifted(name: str) -> Column:
        s = F.col(name)
        return F.when(s.isNotNull(), F.struct((s["at"] + F.col("_offset")).alias("at"), s["x"].alias("x")))

    # One step for the offsets, one for the readings, both on the per-segment table.
    per_segment = written(t.per_segment(df, summary), "segments").withColumn("_offset", offset)
    passed = [F.col("_offset")]
    for i in range(n):
        passed.append(F.last(shifted(f"_l{i}"), True).over(before_current(t.earlier())).alias(f"_cp{i}"))
        passed.append(F.last(shifted(f"_f{i}"), True).over(before_current(t.later())).alias(f"_cq{i}"))
    table = per_segment.select("_m", "_s", *passed)
    joined = t.join_segments(df, table)
    keep = [c for c in df.columns if c not in {"_at", *[f"_p{i}" for i in range(n)], *[f"_q{i}" for i in range(n)]}]
    return joined.select(
        *[named(c) for c in keep],
        (F.col("_at") + F.col("_offset")).alias("_at"),
        *[F.coalesce(shifted(f"_p{i}"), F.col(f"_cp{i}")).alias(f"_p{i}") for i in range(n)],
        *[F.coalesce(shifted(f"_q{i}"), F.col(f"_cq{i}")).alias(f"_q{i}") for i in range(n)],
    )


def clean_pipeline(
    df: DataFrame,
    options: LogOptions,
    sensors: list[str] | None = None,
    method: str = "time",
    timeline: Timeline | None = None,
) -> DataFrame:
    """Range check, then gap filling: an impossible reading is a gap like any other."""
    checked = remove_impossible_values(df, options, sensors)
    return interpolate_missing_values(checked, options, sensors, method, timeline)
