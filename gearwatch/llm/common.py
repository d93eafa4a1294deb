"""Word classes, bytes helpers and written tables shared by the text operators."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.session import fresh_path

# Executors need no copy of the package: functions of these modules travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What separates words, as a Java regular expression.
SPACES = r"[\x20\x09-\x0D]+"
#: bytes.translate table that lower-cases A-Z only.
LOWER_AZ = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words(text: Column | str) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), SPACES), "")


def as_bytes(text: Column | str) -> Column:
    """UTF-8 bytes of a text for Python workers; null is empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column, F.lit("")).cast("binary")


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written to the folder all executors share and read back, and its path."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table of ``stored`` that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
