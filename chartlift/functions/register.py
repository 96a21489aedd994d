"""The two functions that SQL callers use by name."""

from __future__ import annotations

from pyspark.sql import SparkSession

from chartlift.functions.ids import NAME_UUID_NAMESPACE


def register_sql_functions(spark: SparkSession) -> None:
    """Temporary SQL functions ``uuid_name(table, key)`` and ``substring_before(text, separator)``.

    Both are SQL expressions, so they stay inside generated code; no Python runs per row.
    """
    digest = f"md5(concat('{NAME_UUID_NAMESPACE}-', table_name, '-', key))"
    nibble = f"substring('89ab', cast(conv(substring({digest}, 17, 1), 16, 10) as int) % 4 + 1, 1)"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION uuid_name(table_name STRING, key STRING) RETURNS STRING
        RETURN concat(substring({digest}, 1, 8), '-', substring({digest}, 9, 4), '-3',
                      substring({digest}, 14, 3), '-', {nibble}, substring({digest}, 18, 3), '-',
                      substring({digest}, 21, 12))
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION substring_before(value STRING, separator STRING) RETURNS STRING
        RETURN substring_index(value, separator, 1)
    """)
