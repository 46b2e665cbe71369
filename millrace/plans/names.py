"""Queries on file names and dated directories, with names built from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import timekeys
from millrace.operators import files
from millrace.plans.inputs import ON_NAMES, names
from millrace.plans.registry import query
from millrace.sinks.imports import import_manifest

HOST = "host-a"


@query(ON_NAMES + """
SELECT event_id, split_part(name1, '_', 1) AS type1, split_part(name1, '_', 2) AS id1, strftime(ts, '%Y%m%d%H') AS date_hour1,
  split_part(name2, '_', 1) AS type2, '1' AS id2, strftime(ts, '%Y%m%d%H') AS date_hour2
FROM names
""")
def parse_file_name(spark, sf_dir):
    rows = names(spark, sf_dir)
    parsed = rows.select(
        "event_id",
        timekeys.parse_file_name(F.col("name1"), 1).alias("a"),
        timekeys.parse_file_name(F.col("name2"), 2).alias("b"),
    )
    fields = [F.col(f"{m}.{f}").alias(f"{f}{i}") for i, m in ((1, "a"), (2, "b")) for f in ("type", "id", "date_hour")]
    return parsed.select("event_id", *fields)


@query(ON_NAMES + """
SELECT event_id, strftime(ts, 'dt=%Y%m%d/hr=%Y%m%d%H') AS dir1, strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') AS dir2 FROM names
""")
def partition_dir(spark, sf_dir):
    date_hour = timekeys.name_date_hour(F.col("name1"))
    return names(spark, sf_dir).select(
        "event_id", timekeys.partition_dir(date_hour, 1).alias("dir1"), timekeys.partition_dir(date_hour, 2).alias("dir2")
    )


@query(ON_NAMES + """
SELECT '/landed/' || name1 AS id, '/log/raw/' || split_part(name1, '_', 1) || strftime(ts, '/dt=%Y%m%d/hr=%Y%m%d%H/')
  || 'host-a-' || name1 AS remote
FROM names
""")
def remote_path(spark, sf_dir):
    local = names(spark, sf_dir).select(F.lit("hdfs").alias("ds"), F.concat(F.lit("/landed/"), "name1").alias("id"))
    return import_manifest(local, HOST).select("id", "remote")


@query(ON_NAMES + "SELECT event_id, name1 FROM names WHERE name1 LIKE '%.txt'")
def filter_files(spark, sf_dir):
    kept = files.filter_files(names(spark, sf_dir), lambda name: name.endswith(".txt"), "name1")
    return kept.select("event_id", "name1")


@query(ON_NAMES + """
SELECT event_id, split_part(name2, '_', 1) AS type, strftime(ts, '%Y/%m/%d/%H') AS dir FROM names
""")
def custom_file_models(spark, sf_dir):
    def date_first(name):
        digits = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2}-\d{2})", 1)
        kind = F.regexp_extract(name, r"^([a-z]+)_", 1)
        return F.struct(kind.alias("type"), F.lit("1").alias("id"), F.replace(digits, F.lit("-"), F.lit("")).alias("date_hour"))

    def slashes(d):
        return F.concat_ws("/", F.left(d, F.lit(4)), F.substring(d, 5, 2), F.substring(d, 7, 2), F.substring(d, 9, 2))

    parsed = names(spark, sf_dir).select(
        "event_id", timekeys.parse_file_name(F.col("name2"), 9, {9: date_first}).alias("n")
    )
    directory = timekeys.partition_dir(F.col("n.date_hour"), 9, {9: slashes})
    return parsed.select("event_id", F.col("n.type").alias("type"), directory.alias("dir"))
