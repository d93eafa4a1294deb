"""Which columns of a log play which part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gearwatch.functions.columns import is_numeric
from gearwatch.options import FAILURE_ALIASES, ID_COLUMNS, MODEL_EXCLUDES, LogOptions


def failure_column(df: DataFrame, options: LogOptions) -> str | None:
    """The failure column: the named one, else the first known alias, else none."""
    if options.failure in df.columns:
        return options.failure
    return next((name for name in FAILURE_ALIASES if name in df.columns), None)


def sensor_columns(df: DataFrame, options: LogOptions) -> list[str]:
    """Numeric columns that hold readings: no keys, ids, failure or tie-break columns."""
    reserved = {options.machine, options.time, options.target, *options.order, *ID_COLUMNS}
    failure = failure_column(df, options)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in reserved and f.name != failure and is_numeric(f)
    ]


def range_checked_columns(df: DataFrame, options: LogOptions) -> list[str]:
    """Columns the range check covers: the failure flag counts, ids do not."""
    reserved = {options.machine, options.time, *options.order, *ID_COLUMNS}
    return [f.name for f in df.schema.fields if f.name not in reserved and is_numeric(f)]


def gap_filled_columns(df: DataFrame, options: LogOptions) -> list[str]:
    """All numeric columns but the keys: the widest reading of "sensor"."""
    reserved = {options.machine, options.time, *options.order}
    return [f.name for f in df.schema.fields if f.name not in reserved and is_numeric(f)]


def model_columns(df: DataFrame, options: LogOptions, exclude: list[str] | None = None) -> list[str]:
    """Numeric columns a model may learn from."""
    reserved = {options.machine, options.time, options.target, *options.order, *MODEL_EXCLUDES, *(exclude or [])}
    failure = failure_column(df, options)
    if failure:
        reserved.add(failure)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in reserved and is_numeric(f) and not isinstance(f.dataType, T.BooleanType)
    ]


def detected_columns(df: DataFrame, options: LogOptions) -> DataFrame:
    """One row per column and part it plays, as data."""
    parts = {
        "range_check": range_checked_columns(df, options),
        "gap_fill": gap_filled_columns(df, options),
        "feature": sensor_columns(df, options),
    }
    rows = [(part, name) for part, names in parts.items() for name in names]
    return df.sparkSession.createDataFrame(rows, "part string, column_name string")
