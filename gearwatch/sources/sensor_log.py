"""Raw sensor logs: CSV scan, type inference, time, machine and row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearwatch.functions.columns import named, parse_number, without_nan
from gearwatch.options import MACHINE_ALIASES, MICROS_PER_HOUR, LogOptions
from gearwatch.session import written
from gearwatch.sources.csv_records import csv_records, spans_lines
from gearwatch.sources.files import exists

# Texts that stand for a missing cell.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Clock and machine of logs that lack the column.
CLOCK_START = "2024-01-01 00:00:00"
LONE_MACHINE = "machine_1"

_INTEGER = r"^\s*[+-]?\d{1,18}\s*$"


def read_csv_log(
    spark: SparkSession,
    path: str,
    options: LogOptions,
    schema: T.StructType | None = None,
    time_formats: tuple[str, ...] = (),
    multi_line: bool | None = None,
) -> DataFrame:
    """CSV with a header to a log with machine, time and row-order columns.

    Cells are read as text, missing texts become null, then each column takes the
    narrowest type all its cells fit (one aggregate over the file), or that of ``schema``.
    Quoted cells may span lines; ``multi_line`` says whether some do, which a scan finds out if it
    is not given. Either way files are read in splits.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"data file not found: {path}")
    # The standard dialect: a quote inside a quoted cell is doubled.
    raw = spark.read.options(header=True, quote='"', escape='"').csv(path)
    names = raw.columns
    # A log that brings its own order columns needs no row index.
    own_order = set(options.order) <= set(names)
    if spans_lines(spark, path) if multi_line is None else multi_line:
        records = csv_records(spark, path, names)
        df = records if own_order else with_contiguous(records, "_record", options.order[0])
    else:
        df = raw if own_order else with_row_index(raw, options.order[0])
    index = [] if own_order else [options.order[0]]
    df = df.select(
        *index,
        *[F.when(~F.trim(named(c)).isin(*MISSING_TEXTS), named(c)).alias(c) for c in names],
    )
    kinds = {f.name: f.dataType for f in schema.fields} if schema else _inferred(df, names, options)
    df = df.select(*index, *[_typed(named(c), kinds.get(c, T.StringType())).alias(c) for c in names])
    return without_nan(complete_log(df, options, time_formats))


def _inferred(df: DataFrame, names: list[str], options: LogOptions) -> dict[str, T.DataType]:
    tests = []
    for i, c in enumerate(names):
        text = named(c)
        tests += [
            F.count(text).alias(f"n{i}"),
            F.count_if(text.rlike(_INTEGER)).alias(f"i{i}"),
            F.count_if(parse_number(text).isNotNull()).alias(f"d{i}"),
            F.count_if(F.lower(F.trim(text)).isin("true", "false")).alias(f"b{i}"),
        ]
    found = df.agg(*tests).first()
    kinds: dict[str, T.DataType] = {}
    for i, c in enumerate(names):
        n = found[f"n{i}"]
        if n == found[f"i{i}"] and n > 0:
            kinds[c] = T.LongType()
        elif n == found[f"d{i}"]:
            kinds[c] = T.DoubleType()
        elif n == found[f"b{i}"]:
            kinds[c] = T.BooleanType()
        else:
            kinds[c] = T.StringType()
    return kinds


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return parse_number(text).cast(kind)
    return F.trim(text).try_cast(kind)


def with_row_index(df: DataFrame, name: str) -> DataFrame:
    """Contiguous row index in file order for a frame straight from a file scan.

    A row's place inside its file block comes from the generated id; the rows before the
    block come from a table with one line per block. Ids and blocks depend on how a scan
    is cut, which may change when executors come and go, so they are written once.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    placed = written(placed, "rows")
    blocks = placed.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        placed.join(blocks, ["_file", "_block"])
        .withColumn(name, (F.col("_before") + F.col("_id") - F.col("_first")).cast("long"))
        .drop("_file", "_block", "_id", "_first", "_before")
    )


def with_contiguous(df: DataFrame, number: str, name: str) -> DataFrame:
    """Row index 0, 1, 2, ... in the order of a number that has gaps: counts per range of numbers first."""
    df = written(df, "records")
    width = 1 << 20
    ranges = df.groupBy(F.call_function("div", named(number), F.lit(width)).alias("_range")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = df.withColumn("_range", F.call_function("div", named(number), F.lit(width))).join(ranges, "_range")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(number)) - 1
    return placed.withColumn(name, (F.col("_before") + inside).cast("long")).drop("_range", "_before", number)


def complete_log(df: DataFrame, options: LogOptions, time_formats: tuple[str, ...] = ()) -> DataFrame:
    """Time and machine columns in their final form, made up where the log has none."""
    return with_machine(with_time(df, options, time_formats), options)


def with_time(df: DataFrame, options: LogOptions, time_formats: tuple[str, ...] = ()) -> DataFrame:
    """Timestamps; text that is no time becomes null; a log without clock ticks hourly."""
    name = options.time
    if name not in df.columns:
        start = F.unix_micros(F.lit(CLOCK_START).cast("timestamp"))
        ticks = F.timestamp_micros(start + named(options.order[0]) * F.lit(MICROS_PER_HOUR))
        return df.withColumn(name, ticks)
    kind = df.schema[name].dataType
    c = named(name)
    if isinstance(kind, T.StringType):
        c = F.coalesce(F.try_to_timestamp(c), *[F.try_to_timestamp(c, F.lit(f)) for f in time_formats])
    elif isinstance(kind, T.NumericType):
        # Nanoseconds since the epoch; whole numbers stay whole, as a DOUBLE cannot hold them.
        whole = isinstance(kind, T.IntegralType)
        micros = F.call_function("div", c - F.pmod(c, F.lit(1000)), F.lit(1000)) if whole else F.floor(c / 1000)
        c = F.timestamp_micros(micros)
    return df.withColumn(name, c.try_cast("timestamp"))


def with_machine(df: DataFrame, options: LogOptions) -> DataFrame:
    """Machine id from the named column, else the first known alias, else one machine."""
    if options.machine in df.columns:
        return df.withColumn(options.machine, named(options.machine).cast("string"))
    alias = next((a for a in MACHINE_ALIASES if a in df.columns), None)
    return df.withColumn(options.machine, named(alias).cast("string") if alias else F.lit(LONE_MACHINE))


def timed_rows(df: DataFrame, options: LogOptions) -> DataFrame:
    return df.filter(named(options.time).isNotNull())


def untimed_rows(df: DataFrame, options: LogOptions) -> DataFrame:
    """Rejects: rows whose time is missing or was no time."""
    return df.filter(named(options.time).isNull()).withColumn("reason", F.lit("no valid timestamp"))


def sort_by_time(df: DataFrame, options: LogOptions) -> DataFrame:
    """Machine, then time (missing last), then row order."""
    for name in (options.time, options.machine):
        if name not in df.columns:
            raise ValueError(f"required column {name!r} not found")
    return df.orderBy(
        named(options.machine).asc(), named(options.time).asc_nulls_last(), *[named(c) for c in options.order]
    )
