"""Sinks: CSV, JDBC, JSON documents and stages that can be run again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> None:
    """Comma separated files with a header."""
    formats = {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format}
    df.write.mode(mode).options(header=True, **formats).csv(path)


def jdbc_write_options(url: str, table: str, batch_size: int = 10_000, writers: int | None = None, **properties):
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), **properties}
    if writers is not None:
        options["numPartitions"] = str(writers)
    return options


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    """Parallel batched inserts; ``writers`` bounds the number of connections."""
    df.write.format("jdbc").mode(mode).options(**jdbc_write_options(url, table, **options)).save()


def export_json(df: DataFrame, name: str = "json", keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON document per row, null fields left out, next to the columns named in ``keep``."""
    document = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return df.select(*keep, document.alias(name))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def overwrite_stage(df: DataFrame, path: str, run: str, partition: str = "run") -> None:
    """Write one run of a stage; running it again replaces just its own rows."""
    (
        df.withColumn(partition, F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def revert_run(target: DataFrame, stage: DataFrame, key: str) -> DataFrame:
    """The target without the rows that a stage produced."""
    return target.join(stage.select(key), key, "left_anti")
