"""Change log: read new records, apply them, acknowledge them.

State and acknowledgements are written per micro-batch into ``applied_batch=<id>`` folders. A batch that is run
again after a failure replaces its own folder, so applying is idempotent although delivery is at least once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from chartlift.operators.aggregates import pick_per_key


def change_log_stream(
    spark: SparkSession, path: str, schema: StructType | str, file_format: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """New records of a change log that arrives as files in a folder."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).filter(F.col("status") == "NEW")


def latest_changes(changes: DataFrame, keys: Sequence[str], order: str = "id") -> DataFrame:
    """The last change of each key, by change id."""
    columns = [c for c in changes.columns if c not in keys]
    return pick_per_key(changes, keys, columns, [order], last=True).select(*changes.columns)


def apply_changes(
    stream: DataFrame, state_path: str, ack_path: str, checkpoint: str, keys: Sequence[str], order: str = "id",
    interval: str | None = None,
) -> StreamingQuery:
    """Start applying changes: each batch leaves the last change per key, and the ids it has done.

    With ``interval`` ('1 minute') the log is polled for ever, without it what is there is worked off once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        changes = batch.persist()  # read for both writes
        latest_changes(changes, keys, order).write.mode("overwrite").parquet(f"{state_path}/applied_batch={batch_id}")
        done = changes.select(F.col(order), F.lit("DONE").alias("status"))
        done.write.mode("overwrite").parquet(f"{ack_path}/applied_batch={batch_id}")
        changes.unpersist()

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def current_state(spark: SparkSession, state_path: str, keys: Sequence[str], order: str = "id") -> DataFrame:
    """The state after all batches: the last change of each key over the batch folders."""
    return latest_changes(spark.read.parquet(state_path).drop("applied_batch"), keys, order)


def compact_state(spark: SparkSession, state_path: str, target: str, keys: Sequence[str], order: str = "id") -> None:
    """Write the current state as the first batch of a new state folder."""
    current_state(spark, state_path, keys, order).write.mode("overwrite").parquet(f"{target}/applied_batch=-1")


def acknowledged(spark: SparkSession, ack_path: str) -> DataFrame:
    """Ids marked as done."""
    return spark.read.parquet(ack_path).drop("applied_batch").dropDuplicates()
