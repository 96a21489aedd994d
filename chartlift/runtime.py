"""Session helpers: where durable data goes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = 8, app: str = "chartlift", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster the caller brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def durable_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written stages.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where the driver is the
    one executor, falls back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root
    current = context.getCheckpointDir()
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="chartlift-")
    context.setCheckpointDir(root)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the durable root; nothing is ever overwritten there."""
    return f"{durable_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage, so that lost executors cannot change its rows."""
    durable_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written below the durable root and read again: like ``settle``, but the caller says when the files go."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete files that this run has written and nobody reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        place = hadoop(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
