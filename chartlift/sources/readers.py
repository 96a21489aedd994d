"""Sources: JDBC tables, extraction queries, staged tables, CSV files, inline mappings, source views."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Renames and type changes of every staged table.
STAGE_RENAMES = {"PATIENT_ID": "source_patient_id", "ENCOUNTER_ID": "source_encounter_id"}
STAGE_TYPES = {"VARCHAR2": "string", "NUMBER": "decimal(38,10)", "CHAR": "string"}


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options of a JDBC read; a partition column needs its bounds, or the read is one task."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A whole table or view, or a query in brackets with an alias, read in parallel ranges."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def extract(
    spark: SparkSession,
    query: str,
    tables: dict[str, DataFrame],
    row_limit: int | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Run an extraction query over named source tables, with the optional cap of a trial run.

    The cap is a top-k by ``order_by``, so that two trial runs see the same rows.
    """
    result = spark.sql(query, **tables)
    if row_limit is None:
        return result
    if not order_by:
        raise ValueError("row_limit needs order_by to be repeatable")
    return result.orderBy(*order_by).limit(row_limit)


def stage_table(
    df: DataFrame,
    scope: DataFrame | None = None,
    encounters: DataFrame | None = None,
    rename: dict[str, str] | None = None,
    types: dict[str, str] | None = None,
) -> DataFrame:
    """Rename, cast and scope a source table.

    Names become lower case, keys get their ``source_`` name, ``types`` maps columns to Spark types.
    ``scope`` holds ``source_patient_id``: a table with that key keeps the patients in scope, a table
    with ``source_encounter_id`` only is scoped through ``encounters``.
    """
    renames = STAGE_RENAMES if rename is None else rename
    casts = types or {}
    columns = [
        (F.col(name).cast(casts[name]) if name in casts else F.col(name)).alias(renames.get(name, name.lower()))
        for name in df.columns
    ]
    staged = df.select(*columns)
    if scope is None:
        return staged
    keys = scope.select("source_patient_id")
    if "source_patient_id" in staged.columns:
        return staged.join(keys, "source_patient_id", "left_semi")
    if "source_encounter_id" in staged.columns:
        if encounters is None:
            raise ValueError("a table keyed by encounter needs the encounters to find its patients")
        in_scope = encounters.join(keys, "source_patient_id", "left_semi").select("source_encounter_id")
        return staged.join(in_scope, "source_encounter_id", "left_semi")
    return staged


def load_csv(spark: SparkSession, path: str, schema: str | T.StructType, **options) -> DataFrame:
    """A headerless comma separated file with a declared schema."""
    return spark.read.schema(schema).options(**options).csv(path)


def inline_mapping(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A code table written in the program; being program text, it is small enough to broadcast."""
    return F.broadcast(spark.createDataFrame([tuple(row) for row in rows], schema))


def rename_columns(df: DataFrame, columns: dict[str, str | Column]) -> DataFrame:
    """Select ``{new name: old name or expression}``."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def user_view(
    users: DataFrame, parties: DataFrame, persons: DataFrame, relations: DataFrame, memberships: DataFrame
) -> DataFrame:
    """Users with their e-mail, names and membership state: the reusable five-table source view."""
    members = relations.filter(F.col("rel_type") == "membership_rel").join(
        memberships.filter(F.col("member_state").isNotNull()), "rel_id"
    )
    return (
        users.join(parties, users["user_id"] == parties["party_id"])
        .join(persons, users["user_id"] == persons["person_id"])
        .join(members, users["user_id"] == members["object_id_two"])
        .select(
            users["user_id"].alias("source_user_id"), "email", F.col("first_names").alias("first_name"),
            "last_name", "password", "salt", "member_state",
        )
    )


def coded_by(df: DataFrame, column: str, codes: dict[str, str], alias: str) -> DataFrame:
    """Add the code of a column's value from a table written in the program; unknown values get null."""
    mapping = inline_mapping(df.sparkSession, codes.items(), f"{column} string, {alias} string")
    return df.join(mapping, column, "left")
