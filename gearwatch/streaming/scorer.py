"""The request scorer on a stream: stateless, rejects in a table of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gearwatch.operators.attribution import model_trees
from gearwatch.operators.models import FailureModel
from gearwatch.operators.scoring import parse_requests, rejected_requests, score_requests, valid_requests


def request_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """JSON records, one per line, from files that arrive in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)


def start_scoring(
    stream: DataFrame, model: FailureModel, out: str, checkpoint: str, body: str = "value", explain: bool = True
) -> StreamingQuery:
    """Score what is there and stop; restart with the same checkpoint to go on.

    Each micro-batch is parsed once and written to ``out/scored`` and ``out/rejected``, each under
    its batch number. A batch that is repeated after a stop replaces what it wrote before, so every
    record is once in one of the tables.
    """
    trees = model_trees(model) if explain and model.kind != "baseline" else None

    def write(batch: DataFrame, number: int) -> None:
        # A micro-batch is bounded by the trigger; lost parts are parsed again.
        parsed = parse_requests(batch, body).persist()
        try:
            sinks = {
                "scored": score_requests(valid_requests(parsed), model, explain=explain, trees=trees),
                "rejected": rejected_requests(parsed, body),
            }
            for name, df in sinks.items():
                df.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        finally:
            parsed.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def score_stream(
    stream: DataFrame, model: FailureModel, out: str, checkpoint: str, body: str = "value", explain: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Run to the end of the input and return the two tables."""
    start_scoring(stream, model, out, checkpoint, body, explain).awaitTermination()
    spark = stream.sparkSession
    return tuple(spark.read.parquet(f"{out}/{name}").drop("batch") for name in ("scored", "rejected"))
