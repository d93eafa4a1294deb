"""Versioned artifacts: datasets, reports, metrics and cached attributions."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearwatch.sources.files import exists, folders, move, read_text, remove, write_text

# Spark writes milliseconds unless told otherwise; logs have microseconds.
CSV_OPTIONS = {"header": True, "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
# Names a version whose files are whole; Spark's readers pass over files that start so.
MANIFEST = "_manifest.json"
FORMATS = {"parquet": ("parquet",), "csv": ("csv",), "both": ("parquet", "csv")}


def new_version() -> str:
    return datetime.now().strftime("%Y%m%d_%H%M%S")


def save_datasets(
    train: DataFrame, test: DataFrame, base: str, version: str | None = None, format: str = "parquet"
) -> tuple[str, str]:
    """Write both sets below ``base/<format>/version=<v>/split=<name>``; returns the two paths.

    Both sets are first written to a staging folder and moved when they are whole; the manifest
    comes last. Readers only see versions with a manifest, so a run that stops on the way leaves
    the newest committed version in place, also one of the same name.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {sorted(FORMATS)}")
    spark = train.sparkSession
    version = version or new_version()
    staging = f"{base}/_staging/{uuid.uuid4().hex}"
    for kind in FORMATS[format]:
        for name, df in (("train", train), ("test", test)):
            if kind == "parquet":
                df.write.parquet(f"{staging}/{kind}/split={name}")
            else:
                df.write.options(**CSV_OPTIONS).csv(f"{staging}/{kind}/split={name}")
    manifest = json.dumps({"version": version, "splits": {"train": train.schema.json(), "test": test.schema.json()}})
    homes = [f"{base}/{kind}/version={version}" for kind in FORMATS[format]]
    for kind, home in zip(FORMATS[format], homes):
        remove(spark, f"{home}/{MANIFEST}")
        remove(spark, home)
        move(spark, f"{staging}/{kind}", home)
        write_text(spark, f"{home}/{MANIFEST}", manifest)
    remove(spark, staging)
    return f"{homes[0]}/split=train", f"{homes[0]}/split=test"


def committed_versions(spark: SparkSession, base: str, kind: str) -> list[str]:
    """Versions of a format that were written to the end, oldest first."""
    found = [f.split("=", 1)[1] for f in folders(spark, f"{base}/{kind}") if f.startswith("version=")]
    return sorted(v for v in found if exists(spark, f"{base}/{kind}/version={v}/{MANIFEST}"))


def latest_version(spark: SparkSession, base: str, kind: str | None = None) -> str:
    """The newest committed version, of one format or of any."""
    versions = [v for k in ([kind] if kind else FORMATS["both"]) for v in committed_versions(spark, base, k)]
    if not versions:
        raise FileNotFoundError(f"no committed dataset version below {base}")
    return max(versions)


def load_dataset(
    spark: SparkSession, base: str, split: str = "test", path: str | None = None, version: str | None = None
) -> DataFrame:
    """The newest committed version of a split, a version by name, or an explicit path.

    Parquet where the version has it, else CSV under the schema its manifest names.
    """
    if path is not None:
        if not exists(spark, path):
            raise FileNotFoundError(f"dataset not found: {path}")
        return spark.read.parquet(path)
    version = version or latest_version(spark, base)
    kind = next((k for k in FORMATS["both"] if version in committed_versions(spark, base, k)), None)
    home = f"{base}/{kind}/version={version}"
    splits = json.loads(read_text(spark, f"{home}/{MANIFEST}"))["splits"] if kind else {}
    if split not in splits:
        raise FileNotFoundError(f"dataset not found: version {version}, split {split} below {base}")
    if kind == "parquet":
        return spark.read.parquet(f"{home}/split={split}")
    return load_csv(spark, f"{home}/split={split}", T.StructType.fromJson(json.loads(splits[split])))


def save_csv(df: DataFrame, path: str) -> None:
    """Frame of any size as CSV parts with headers."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def load_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV written by this module, with the given schema."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def save_ranking(df: DataFrame, path: str, by: str, *ties: str) -> None:
    """Small table as one CSV file, largest ``by`` first."""
    df.orderBy(F.desc(by), *ties).coalesce(1).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def save_json(df: DataFrame, path: str) -> None:
    """Small table as JSON lines."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def load_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def save_text(lines: DataFrame, path: str) -> None:
    """``(line_no, line)`` table as one text file."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)


def cached(spark: SparkSession, base: str | None, version: str, key: str, compute) -> DataFrame:
    """Result stored under version and key; computed and stored at the first call.

    The version and the key are part of the address: a new model, or other rows under a key
    that names them, never meet old values.
    """
    if base is None:
        return compute()
    path = f"{base}/version={version}/key={key}"
    if not exists(spark, f"{path}/_SUCCESS"):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
