"""Split at one instant: train strictly before, test from there on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearwatch.functions.columns import instant, named
from gearwatch.options import LogOptions
from gearwatch.sources.artifacts import save_datasets

# Quantiles of the sketch are at most one row in so many off their rank.
ACCURACY = 20_000
# Rows that are listed instant by instant.
LISTED_ROWS = 100_000


def time_threshold(df: DataFrame, options: LogOptions) -> int | None:
    """Instant at rank int(n * (1 - test_size)) of all rows in time order, in microseconds.

    Exact selection from a mergeable sketch: two quantiles that are further from the rank than
    the sketch can err hold it between them. One more scan counts the rows before and lists the
    instants between; only where these are too many does a sketch of the rows between come first.
    No sort. Rows without a time rank last; None when the rank lies beyond the timed rows.
    """
    us = instant(df, options.time)
    rows = df.select(us.alias("us"), named(options.time).alias("t"))
    whole = df.schema[options.time].dataType.typeName() == "long"
    rank, low, high, share = None, None, None, 1 - options.test_size
    while True:
        # The filter is on the raw column, so that parquet can skip row groups.
        upto = rows if high is None else rows.where(F.col("t") <= (F.lit(high) if whole else F.timestamp_micros(F.lit(high))))
        early = F.lit(False) if low is None else F.col("us") < low
        held = F.when(~early, F.col("us"))
        points = _points(share)
        found = upto.agg(
            F.count("*").alias("n"), F.count_if(early).alias("before"), F.count(held).alias("held"),
            F.percentile_approx(held, F.array(*map(F.lit, points)), F.lit(ACCURACY)).alias("q"),
        ).first()
        rank = int(found["n"] * (1 - options.test_size)) if rank is None else rank
        place, n = rank - found["before"], found["held"]
        if place >= n:
            return None
        off = n / ACCURACY + 1
        under = [i for i, p in enumerate(points) if p * n + off < place]
        over = [i for i, p in enumerate(points) if p * n - off > place]
        first, last = (under[-1] if under else None), (over[0] if over else None)
        low = low if first is None else found["q"][first]
        high = high if last is None else found["q"][last]
        if low is not None and low == high:
            return low
        between = n * ((1.0 if last is None else points[last]) - (0.0 if first is None else points[first])) + 2 * off
        if between <= LISTED_ROWS or between >= n:
            break
        begin = 0.0 if first is None else points[first] * n
        share = min(1.0, max(0.0, (place - begin) / between))
    upto = rows.where("us IS NOT NULL") if high is None else rows.where(F.col("us") <= high)
    # Rows before the bracket are one group.
    cell = F.col("us") if low is None else F.when(F.col("us") >= low, F.col("us"))
    counts = upto.groupBy(cell.alias("cell")).count().collect()
    for at, held in sorted(((r["cell"], r["count"]) for r in counts), key=lambda c: (c[0] is not None, c[0])):
        if rank < held:
            return at
        rank -= held
    return None


def _points(share: float) -> list[float]:
    """Shares to ask a sketch for: tenths, and ever closer ones around a share."""
    near = [share + sign * k / ACCURACY for k in (3, 10, 100, 1000) for sign in (-1, 1)]
    return sorted({round(p, 9) for p in (*near, *(i / 10 for i in range(11))) if 0.0 <= p <= 1.0})


def _in_train(df: DataFrame, options: LogOptions, threshold: int | None) -> Column:
    us = instant(df, options.time)
    return us.isNotNull() if threshold is None else us < F.lit(threshold)


def _in_test(df: DataFrame, options: LogOptions, threshold: int | None) -> Column:
    """Timed rows from the threshold on; rows without a time belong to neither side."""
    us = instant(df, options.time)
    return F.lit(False) if threshold is None else us >= F.lit(threshold)


def with_split(df: DataFrame, options: LogOptions, threshold: int | None = None) -> DataFrame:
    """Adds ``split`` = train, test or null (rows without a time belong to neither)."""
    if threshold is None:
        threshold = time_threshold(df, options)
    side = F.when(_in_train(df, options, threshold), F.lit("train")).when(_in_test(df, options, threshold), F.lit("test"))
    return df.withColumn("split", side)


def time_based_split(df: DataFrame, options: LogOptions) -> tuple[DataFrame, DataFrame]:
    threshold = time_threshold(df, options)
    train = df.filter(_in_train(df, options, threshold))
    test = df.filter(_in_test(df, options, threshold))
    return train, test


def split_report(df: DataFrame, options: LogOptions) -> DataFrame:
    """Rows and time range per side of a frame that has ``split``, with the overlap flag."""
    us = instant(df, options.time)
    one = df.filter(F.col("split").isNotNull()).agg(
        *[
            f(F.when(F.col("split") == side, us)).alias(f"{side}_{name}")
            for side in ("train", "test")
            for name, f in (("row_count", F.count), ("first_us", F.min), ("last_us", F.max))
        ]
    )
    return one.withColumn("overlap", F.coalesce(F.col("train_last_us") >= F.col("test_first_us"), F.lit(False)))


def split_pipeline(
    df: DataFrame,
    options: LogOptions,
    base: str | None = None,
    version: str | None = None,
    format: str = "parquet",
) -> tuple[DataFrame, DataFrame, str | None, str | None]:
    """Split and, with a ``base`` folder, save both sides."""
    train, test = time_based_split(df, options)
    if base is None:
        return train, test, None, None
    return train, test, *save_datasets(train, test, base, version, format)
