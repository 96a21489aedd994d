"""The change log: once, again after a failure, and with more data."""

from pyspark.sql import functions as F

from chartlift.runtime import scratch_path
from chartlift.streaming import changes

SCHEMA = "id long, status string, patient_id long, note string"


def test_changes_apply_once_and_continue(spark):
    log, state, acks, progress = (scratch_path(spark, n) for n in ("log", "state", "acks", "progress"))
    spark.createDataFrame([(1, "NEW", 1, "a"), (2, "NEW", 2, "b"), (3, "DONE", 1, "old"), (5, "NEW", 1, "c")], SCHEMA).coalesce(1).write.mode("append").parquet(log)

    def run():
        stream = changes.change_log_stream(spark, log, SCHEMA)
        changes.apply_changes(stream, state, acks, progress, ["patient_id"]).awaitTermination()
        return {r.patient_id: (r.id, r.note) for r in changes.current_state(spark, state, ["patient_id"]).collect()}

    assert run() == {1: (5, "c"), 2: (2, "b")}
    assert run() == {1: (5, "c"), 2: (2, "b")}  # nothing new, nothing changes
    spark.createDataFrame([(4, "NEW", 1, "late"), (6, "NEW", 2, "d")], SCHEMA).coalesce(1).write.mode("append").parquet(log)
    assert run() == {1: (5, "c"), 2: (6, "d")}  # an older id does not win
    assert sorted(r.id for r in changes.acknowledged(spark, acks).collect()) == [1, 2, 4, 5, 6]
    compacted = scratch_path(spark, "compacted")
    changes.compact_state(spark, state, compacted, ["patient_id"])
    assert changes.current_state(spark, compacted, ["patient_id"]).count() == 2


def test_a_repeated_batch_replaces_itself(spark):
    state, acks = scratch_path(spark, "state"), scratch_path(spark, "acks")
    batch = spark.createDataFrame([(1, "NEW", 1, "a")], SCHEMA)
    for _ in range(2):
        changes.latest_changes(batch, ["patient_id"]).write.mode("overwrite").parquet(f"{state}/applied_batch=0")
        batch.select("id", F.lit("DONE").alias("status")).write.mode("overwrite").parquet(f"{acks}/applied_batch=0")
    assert spark.read.parquet(acks).count() == 1 and spark.read.parquet(state).count() == 1
