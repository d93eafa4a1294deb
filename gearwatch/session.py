"""Session set-up and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}
_runs: list[str] = []


def local_session(
    app: str = "gearwatch", cores: str = "*", partitions: int = 8, checkpoint_dir: str | None = None
) -> SparkSession:
    """Session for tests and trials; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("GEARWATCH_DRIVER_MEMORY", "8g"))
    )
    if checkpoint_dir:
        builder = builder.config(CHECKPOINT_KEY, checkpoint_dir)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder all executors share: the one the cluster names.

    Only a local session may fall back to a folder of its own; on a cluster a
    machine-local folder would be lost with the machine.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="gearwatch-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """New path below the folder of the run, or the working folder."""
    return f"{_runs[-1] if _runs else work_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables of one run, removed with all of them at its end.

    Frames made inside read these tables, so what they give must be saved before.
    """
    path = f"{work_dir(spark)}/run-{uuid.uuid4().hex}"
    _runs.append(path)
    try:
        yield path
    finally:
        _runs.remove(path)
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the working folder and read it back."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
