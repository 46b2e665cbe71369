"""Configuration tables from a catalog, a folder or a database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# The tables topics, encoders and columns are configured in, and their columns.
CONFIG_TABLES = {
    "kafka_logs": "log string, type string, host string, enabled int",
    "kafka_log_encoders": "log string, type string, data string",
    "source_log_fields": "log_id bigint, field_id bigint, field_name string, data_type string",
    "source_logs": "log_id bigint, log_name string",
}


def read_config_tables(
    spark: SparkSession,
    folder: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    names: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The configuration tables by name.

    From parquet below ``folder``, over JDBC (filters and columns reach the database), or from
    the session's catalog. ``names`` renames tables, such as a view for ``source_logs``.
    """
    tables = {}
    for table, schema in CONFIG_TABLES.items():
        name = (names or {}).get(table, table)
        if folder is not None:
            tables[table] = spark.read.schema(schema).parquet(f"{folder}/{name}")
        elif jdbc is not None:
            tables[table] = spark.read.format("jdbc").options(**jdbc, dbtable=name).load()
        else:
            tables[table] = spark.table(name)
    return tables
