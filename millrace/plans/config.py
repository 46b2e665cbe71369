"""Queries on configuration tables, with customers as topics and their orders as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import payload
from millrace.operators import settings as ops
from millrace.plans.inputs import ON_CONFIG, config
from millrace.plans.registry import query, table
from millrace.session import new_folder
from millrace.sources.tables import read_config_tables as read_tables

HOST = "host-3"


@query(ON_CONFIG + """
SELECT e.log, e.type, CASE WHEN e.data <> '' THEN 2 ELSE count(f.field_id) END AS n_columns
FROM kafka_log_encoders e JOIN source_logs s ON s.log_name = e.log LEFT JOIN source_log_fields f ON f.log_id = s.log_id
GROUP BY e.log, e.type, e.data
""")
def read_config_tables(spark, sf_dir):
    folder = new_folder(spark, "config")
    for name, rows in config(spark, sf_dir).items():
        rows.write.parquet(f"{folder}/{name}")
    tables = read_tables(spark, folder)
    defined = ops.encoder_definitions(
        tables["kafka_log_encoders"], tables["source_logs"], tables["source_log_fields"]
    )
    return defined.select(
        F.col("topic").alias("log"), F.col("encoder").alias("type"), F.size("definitions").alias("n_columns")
    )


@query(ON_CONFIG + """
SELECT log, 0 AS position, 'user/id' AS path, '-1' AS "default" FROM kafka_log_encoders WHERE data <> ''
UNION ALL SELECT log, 1, 'k', CAST(c_custkey AS VARCHAR) FROM kafka_log_encoders WHERE data <> ''
""")
def parse_definitions(spark, sf_dir):
    encoders = config(spark, sf_dir)["kafka_log_encoders"].where("data <> ''")
    columns = encoders.select("log", F.posexplode(payload.parse_definitions(F.col("data"))).alias("position", "d"))
    return columns.select("log", "position", F.array_join("d.path", "/").alias("path"), F.col("d.default").alias("default"))


@query(ON_CONFIG + """
SELECT log_id, field_id, CASE data_type WHEN 'string' THEN '' WHEN 'boolean' THEN 'false' ELSE '-1' END AS "default"
FROM source_log_fields
""")
def type_default(spark, sf_dir):
    fields = config(spark, sf_dir)["source_log_fields"]
    return fields.select("log_id", "field_id", payload.type_default(F.col("data_type")).alias("default"))


@query(ON_CONFIG + """
SELECT e.log, f.field_id, f.field_name AS path,
  CASE f.data_type WHEN 'string' THEN '' WHEN 'boolean' THEN 'false' ELSE '-1' END AS "default"
FROM kafka_log_encoders e JOIN source_logs s ON s.log_name = e.log JOIN source_log_fields f ON f.log_id = s.log_id
WHERE e.data = ''
""")
def log_columns(spark, sf_dir):
    tables = config(spark, sf_dir)
    return ops.log_columns(tables["kafka_log_encoders"], tables["source_logs"], tables["source_log_fields"])


PROPERTIES = """, properties AS (
  SELECT c_name AS topic,
    CASE WHEN c_nationkey < 10 THEN 'json' END AS decoder,
    CASE WHEN c_nationkey % 2 = 0 THEN 'obj' ELSE 'clock' END AS time_parser,
    CASE WHEN c_acctbal < 0 THEN 'json' END AS encoder
  FROM customer)
"""


def properties(spark, sf_dir) -> DataFrame:
    nation = F.col("c_nationkey")
    values = F.array(
        F.struct(F.lit("decoder").alias("name"), F.when(nation < 10, "json").alias("value")),
        F.struct(F.lit("time_parser").alias("name"), F.when(nation % 2 == 0, "obj").otherwise("clock").alias("value")),
        F.struct(F.lit("encoder").alias("name"), F.when(F.col("c_acctbal") < 0, "json").alias("value")),
    )
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("topic"), F.inline(values))
    return rows.where("value is not null")


@query(ON_CONFIG + PROPERTIES + """
SELECT k.log AS topic,
  CASE coalesce(e.type, p.encoder, 'json-tsv') WHEN 'avro' THEN 'default' ELSE coalesce(e.type, p.encoder, 'json-tsv') END AS encoder,
  coalesce(p.decoder, 'default') AS decoder, CASE p.time_parser WHEN 'obj' THEN 'obj' ELSE 'now' END AS time_parser
FROM kafka_logs k LEFT JOIN kafka_log_encoders e ON e.log = k.log LEFT JOIN properties p ON p.topic = k.log
""")
def resolve_settings(spark, sf_dir):
    tables = config(spark, sf_dir)
    encoders = ops.encoder_definitions(
        tables["kafka_log_encoders"], tables["source_logs"], tables["source_log_fields"]
    )
    topics = tables["kafka_logs"].select(F.col("log").alias("topic"))
    resolved = ops.resolve_settings(topics, encoders, properties(spark, sf_dir), {"encoder": "json-tsv"})
    return resolved.drop("definitions")


@query(ON_CONFIG + "SELECT log FROM kafka_logs WHERE type = 'hdfs' AND host = 'host-3' AND enabled = 1")
def enabled_topics(spark, sf_dir):
    return ops.enabled_topics(config(spark, sf_dir)["kafka_logs"], HOST)


ACTIVE = """, wanted AS (SELECT log FROM kafka_logs WHERE type = 'hdfs' AND host = 'host-3' AND enabled = 1),
active AS (SELECT c_name AS log FROM customer WHERE c_nationkey = 3 AND c_acctbal < 5000)
"""


def topics(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf_dir, "customer")
    active = customer.where("c_nationkey = 3 and c_acctbal < 5000").select(F.col("c_name").alias("log"))
    return ops.enabled_topics(config(spark, sf_dir)["kafka_logs"], HOST), active


@query(ON_CONFIG + ACTIVE + "SELECT log FROM wanted WHERE log NOT IN (SELECT log FROM active)")
def topics_to_add(spark, sf_dir):
    return ops.topics_to_add(*topics(spark, sf_dir))


@query(ON_CONFIG + ACTIVE + "SELECT log FROM active WHERE log NOT IN (SELECT log FROM wanted)")
def topics_to_remove(spark, sf_dir):
    return ops.topics_to_remove(*topics(spark, sf_dir))


@query("""
SELECT c_name AS key, CAST(c_nationkey AS VARCHAR) AS value FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def sub_settings(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.concat_ws(".", "c_mktsegment", "c_name").alias("key"), F.col("c_nationkey").cast("string").alias("value")
    )
    return ops.sub_settings(rows, "BUILDING")
