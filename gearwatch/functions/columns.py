"""Scalar column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearwatch.options import MICROS_PER_HOUR

# Spellings of a flag.
FLAG_WORDS = ("0", "1", "true", "false", "yes", "no", "y", "n", "t", "f")
TRUE_WORDS = ("1", "true", "yes", "y", "t")

_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


def named(name: str) -> Column:
    """Column by its literal name, dots and brackets included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(field: T.StructField, with_boolean: bool = False) -> bool:
    kind = field.dataType
    return isinstance(kind, T.NumericType) or (with_boolean and isinstance(kind, T.BooleanType))


def instant(df: DataFrame, time: str) -> Column:
    """Microseconds since the epoch of a time column (a LONG passes through)."""
    kind = df.schema[time].dataType
    if isinstance(kind, T.LongType):
        return named(time)
    return F.unix_micros(named(time).cast("timestamp"))


def parse_number(text: Column) -> Column:
    """Number in a text, or null. Java suffixes such as ``1d`` do not count as numbers."""
    return F.when(F.lower(text).rlike(_NUMBER), F.trim(text).try_cast("double"))


def is_flag_word(text: Column) -> Column:
    return F.lower(text).isin(*FLAG_WORDS)


def is_true_word(text: Column) -> Column:
    return F.lower(text).isin(*TRUE_WORDS)


def add_hours(time: Column, hours: Column | float) -> Column:
    """Instant ``hours`` later, to the microsecond."""
    hours = hours if isinstance(hours, Column) else F.lit(hours)
    return F.timestamp_micros(F.unix_micros(time) + (hours * F.lit(MICROS_PER_HOUR)).cast("long"))


def version_text(time: Column) -> Column:
    """``yyyyMMdd_HHmmss`` text of an instant."""
    return F.date_format(time, "yyyyMMdd_HHmmss")


def logistic(margin: Column) -> Column:
    """1 / (1 + e^-x) with the exponent clipped to +-250."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(margin, F.lit(250.0)), F.lit(-250.0))))


def sanitised_text(text: Column) -> Column:
    """Feature name with ``[ ] < >`` turned into underscores."""
    return F.translate(text, "[]<>", "____")


def sanitised(name: str) -> str:
    return name.translate(str.maketrans("[]<>", "____"))


def without_nan(df: DataFrame) -> DataFrame:
    """NaN to null in all floating columns: Spark sorts and averages NaN as a value."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.when(~F.isnan(named(f.name)), named(f.name)).alias(f.name)
            if isinstance(f.dataType, floating)
            else named(f.name)
            for f in df.schema.fields
        ]
    )


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row.

    The optimiser copies a projected expression into every filter that uses it, and lambda
    bodies see it per element. The output of a generator is never copied.
    """
    return df.select(*[named(c) for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def fixed(number: Column, places: int = 6) -> Column:
    """Rounded for comparison; the nudge keeps exact halves from flipping either way."""
    return F.round(number + F.lit(3e-9), places)
