"""The test tables as messages, ledger, files and configuration, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.ids import make_dsid
from millrace.functions.payload import definition_list
from millrace.functions.timekeys import epoch_millis, floor_div
from millrace.plans.registry import table

# --- events as messages --------------------------------------------------------------------
# The payload is the event's props with its time and user added. Some payloads are cut short
# and some are missing, as on a real topic.

MESSAGES = """
messages AS (
  SELECT topic, part, "offset", priority, ts_ms, user_id,
    CASE WHEN "offset" % 50 = 1 THEN NULL
         WHEN "offset" % 50 = 0 THEN left(payload, length(payload) - 1)
         ELSE payload END AS value
  FROM (
    SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS part, event_id AS "offset",
      user_id % 3 AS priority, epoch_us(ts) // 1000 AS ts_ms, user_id,
      left(props, length(props) - 1) || ', "ts": ' || (epoch_us(ts) // 1000) || ', "user": {"id": ' || user_id
        || CASE user_id % 3 WHEN 0 THEN ', "tag": null' WHEN 1 THEN ', "tag": "t' || user_id || '"' ELSE '' END
        || '}}' AS payload
    FROM events))
"""

# The projection of the tests: a value, nested values (one may be null or missing), a key that
# is never there, and an empty path.
DEFINITIONS = '[["/k", -1], ["user//id", -1], ["user/tag", "none"], ["user/zip", "00000"], ["", "x"]]'

# Settings by topic, from the topics there are.
SETTINGS = """
settings AS (
  SELECT topic,
    CASE topic WHEN 'click' THEN 'json-csv' WHEN 'view' THEN 'json-tsv' WHEN 'signup' THEN 'json'
               ELSE 'default' END AS encoder,
    CASE topic WHEN 'error' THEN 'default' ELSE 'json' END AS decoder,
    CASE WHEN topic IN ('signup', 'error') THEN 'now' ELSE 'obj' END AS time_parser
  FROM (SELECT DISTINCT topic FROM messages))
"""

# Cells of the projection for a good payload.
CELLS = """
cells AS (
  SELECT m.*, json_valid(value) AS valid,
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.k') END AS c0,
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.user.id') END AS c1,
    CASE WHEN json_valid(value) THEN
      CASE WHEN json_type(value, '$.user.tag') IS NULL THEN 'none'
           ELSE coalesce(json_extract_string(value, '$.user.tag'), '') END END AS c2
  FROM messages m)
"""

NOW_MS = 1_706_745_600_000  # the clock of the tests: 2024-02-01

# Good messages on their way: record decoded where it should be, time, key, output line.
PROCESSED = f"""
processed AS (
  SELECT *, topic || '_' || strftime(make_timestamp(line_ms * 1000), '%Y%m%d%H') AS key
  FROM (
    SELECT c.topic, c.part, c."offset", c.priority, s.encoder,
      CASE s.time_parser WHEN 'obj' THEN c.ts_ms ELSE {NOW_MS} END AS line_ms,
      CASE s.encoder
        WHEN 'json-csv' THEN concat_ws(',', c0, c1, c2, '00000', 'x')
        WHEN 'json-tsv' THEN concat_ws(chr(9), c0, c1, c2, '00000', 'x')
        WHEN 'json' THEN CAST(json(CASE WHEN valid THEN value END) AS VARCHAR)
        ELSE value END AS line
    FROM cells c JOIN settings s ON s.topic = c.topic
    WHERE c.value IS NOT NULL AND (s.decoder = 'default' OR valid)))
"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ", ".join(c.strip() for c in ctes) + "\n"


ON_MESSAGES = with_ctes(MESSAGES)
ON_PROCESSED = with_ctes(MESSAGES, SETTINGS, CELLS, PROCESSED)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    tag = (
        F.when(F.col("user_id") % 3 == 0, ', "tag": null')
        .when(F.col("user_id") % 3 == 1, F.concat(F.lit(', "tag": "t'), user, F.lit('"')))
        .otherwise("")
    )
    payload = F.concat(
        F.left("props", F.length("props") - 1),
        F.lit(', "ts": '), epoch_millis(F.col("ts")).cast("string"),
        F.lit(', "user": {"id": '), user, tag, F.lit("}}"),
    )
    place = F.col("event_id") % 50
    value = F.when(place == 0, F.left(payload, F.length(payload) - 1)).when(place != 1, payload)
    return events.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        (F.col("user_id") % 3).alias("priority"),
        epoch_millis(F.col("ts")).alias("ts_ms"),
        "user_id",
        value.alias("value"),
    )


def settings(rows: DataFrame) -> DataFrame:
    """What ``resolve_settings`` gives for the topics of the messages."""
    topic = F.col("topic")
    columns = F.array(
        *[
            F.struct(F.array(*[F.lit(s) for s in path]).cast("array<string>").alias("path"), F.lit(default).alias("default"))
            for path, default in definition_list(DEFINITIONS)
        ]
    )
    encoder = (
        F.when(topic == "click", "json-csv").when(topic == "view", "json-tsv")
        .when(topic == "signup", "json").when(topic == "error", "avro").otherwise("default")
    )
    return rows.select("topic").distinct().select(
        "topic",
        encoder.alias("encoder"),
        columns.alias("definitions"),
        F.when(topic == "error", "default").otherwise("json").alias("decoder"),
        F.when(topic.isin("signup", "error"), "now").otherwise("obj").alias("time_parser"),
    )


# --- orders as the ledger ------------------------------------------------------------------

LEDGER = """
ledger AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' ELSE 'orders' END || chr(1) || o_orderkey AS dsid,
    CASE o_orderstatus WHEN 'F' THEN 'done' ELSE 'run' END AS status, o_orderdate AS ts
  FROM orders)
"""
UNITS = """
units AS (
  SELECT CASE WHEN l_linenumber = 7 THEN 'urgent' ELSE 'orders' END || chr(1) || l_orderkey AS dsid
  FROM lineitem)
"""
ON_LEDGER = with_ctes(LEDGER)
ON_UNITS = with_ctes(LEDGER, UNITS)


def order_source() -> F.Column:
    return F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").otherwise("orders")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        make_dsid(order_source(), F.col("o_orderkey")).alias("dsid"),
        F.when(F.col("o_orderstatus") == "F", "done").otherwise("run").alias("status"),
        F.col("o_orderdate").alias("ts"),
    )


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units named by the line items: repeated, and partly unknown to the ledger."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, "urgent").otherwise("orders").alias("ds"),
        F.col("l_orderkey").cast("string").alias("id"),
    )


# --- documents as growing files ------------------------------------------------------------
# A third of the files is half sent, a third is sent, the rest is new.

LINES = """
raw_lines AS (
  SELECT CAST(doc_id AS VARCHAR) AS file, doc_id, strlen(text) AS size, string_split(text, chr(10)) AS parts
  FROM documents),
numbered AS (
  SELECT file, doc_id, size, unnest(parts) AS value, generate_subscripts(parts, 1) - 1 AS line_no
  FROM raw_lines),
lines AS (
  SELECT file, doc_id, size, line_no, value, "end" - strlen(value) - 1 AS start, least("end", size) AS "end"
  FROM (
    SELECT *, sum(strlen(value) + 1) OVER (PARTITION BY file ORDER BY line_no) AS "end"
    FROM numbered))
"""
PROGRESS = """
listing AS (SELECT CAST(doc_id AS VARCHAR) AS file, doc_id, strlen(text) AS size FROM documents),
progress AS (
  SELECT file, doc_id, size, CASE doc_id % 3 WHEN 0 THEN size // 2 WHEN 1 THEN size ELSE 0 END AS sent_size
  FROM listing)
"""
SPACES = """
spaces AS (
  SELECT 'documents' AS ns, file, size, sent_size FROM progress UNION ALL SELECT 'archive', file, size, 0 FROM progress)
"""
RANGES = """
ranges AS (
  SELECT *, CASE WHEN doc_id % 4 = 0 AND batch % 2 = 0 THEN 'run' ELSE 'done' END AS status
  FROM (
    SELECT file, doc_id, line_no // 20 AS batch, min(start) AS start, max("end") AS "end",
      count(*) AS n, string_agg(value, chr(10) ORDER BY line_no) AS body
    FROM lines GROUP BY file, doc_id, line_no // 20))
"""
ON_LINES = with_ctes(LINES)
ON_PROGRESS = with_ctes(LINES, PROGRESS, SPACES)
ON_RANGES = with_ctes(LINES, PROGRESS, SPACES, RANGES)

BATCH_LINES = 20
NS = "documents"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as the text source gives them; a part of a file holds at most 64 lines here."""
    documents = table(spark, sf_dir, "documents")
    split = documents.select(
        F.col("doc_id").cast("string").alias("file"),
        F.octet_length("text").cast("bigint").alias("file_size"),
        F.posexplode(F.split("text", "\n")).alias("seq", "value"),
    )
    return split.select(
        "file", "file_size", floor_div(F.col("seq"), 64).alias("block"), "seq",
        (F.octet_length("value") + 1).cast("bigint").alias("bytes"), "value",
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("file"), F.octet_length("text").cast("bigint").alias("size")
    )


def listing_of_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files in two name spaces; only of one are positions and ranges known."""
    spaces = F.explode(F.array(F.lit(NS), F.lit("archive"))).alias("ns")
    return listing(spark, sf_dir).select(spaces, "file", "size")


def increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was read of each file so far, in two steps."""
    size, third = F.col("size"), F.col("doc_id") % 3
    sent = F.when(third == 0, floor_div(size, 2)).when(third == 1, size)
    read = listing(spark, sf_dir).withColumn("doc_id", F.col("file").cast("bigint")).withColumn("sent", sent)
    first = floor_div(F.col("sent"), 3)
    steps = F.explode(F.array(first, F.col("sent") - first))
    return read.where("sent is not null").select(F.lit(NS).alias("ns"), "file", steps.alias("delta"))


# --- file names from events ----------------------------------------------------------------

NAMES = """
names AS (
  SELECT event_id, ts,
    event_type || '_' || user_id || '_hr_' || strftime(ts, '%Y%m%d%H') || CASE user_id % 2 WHEN 0 THEN '.gz' ELSE '.txt' END AS name1,
    event_type || '_' || strftime(ts, '%Y-%m-%d-%H') || '.gz' AS name2
  FROM events)
"""
ON_NAMES = with_ctes(NAMES)


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    extension = F.when(F.col("user_id") % 2 == 0, ".gz").otherwise(".txt")
    hour = F.date_format("ts", "yyyyMMddHH")
    return events.select(
        "event_id",
        F.concat("event_type", F.lit("_"), F.col("user_id").cast("string"), F.lit("_hr_"), hour, extension).alias("name1"),
        F.concat("event_type", F.lit("_"), F.date_format("ts", "yyyy-MM-dd-HH"), F.lit(".gz")).alias("name2"),
    )


# --- customers and orders as configuration -------------------------------------------------

CONFIG = """
kafka_logs AS (
  SELECT c_name AS log, CASE c_mktsegment WHEN 'MACHINERY' THEN 'ftp' ELSE 'hdfs' END AS type,
    'host-' || c_nationkey AS host, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS enabled
  FROM customer),
kafka_log_encoders AS (
  SELECT c_name AS log, c_custkey,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'json-csv' WHEN 'HOUSEHOLD' THEN 'json-tsv'
                      WHEN 'AUTOMOBILE' THEN 'json' ELSE 'avro' END AS type,
    CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal > 5000
         THEN '[["//user//id", -1], ["k", ' || c_custkey || ']]' ELSE '' END AS data
  FROM customer WHERE c_mktsegment <> 'MACHINERY'),
source_log_fields AS (
  SELECT o_custkey AS log_id, o_orderkey AS field_id, 'f/' || o_orderkey AS field_name,
    CASE o_orderstatus WHEN 'F' THEN 'string' WHEN 'O' THEN 'boolean' ELSE 'int' END AS data_type
  FROM orders),
source_logs AS (SELECT c_custkey AS log_id, c_name AS log_name FROM customer)
"""
ON_CONFIG = with_ctes(CONFIG)


def config(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    segment, status = F.col("c_mktsegment"), F.col("o_orderstatus")
    encoder = (
        F.when(segment == "BUILDING", "json-csv").when(segment == "HOUSEHOLD", "json-tsv")
        .when(segment == "AUTOMOBILE", "json").otherwise("avro")
    )
    data = F.concat(F.lit('[["//user//id", -1], ["k", '), F.col("c_custkey").cast("string"), F.lit("]]"))
    return {
        "kafka_logs": customer.select(
            F.col("c_name").alias("log"),
            F.when(segment == "MACHINERY", "ftp").otherwise("hdfs").alias("type"),
            F.concat(F.lit("host-"), F.col("c_nationkey").cast("string")).alias("host"),
            (F.col("c_acctbal") > 0).cast("int").alias("enabled"),
        ),
        "kafka_log_encoders": customer.where(segment != "MACHINERY").select(
            F.col("c_name").alias("log"),
            encoder.alias("type"),
            F.when((segment == "BUILDING") & (F.col("c_acctbal") > 5000), data).otherwise("").alias("data"),
        ),
        "source_log_fields": orders.select(
            F.col("o_custkey").alias("log_id"),
            F.col("o_orderkey").alias("field_id"),
            F.concat(F.lit("f/"), F.col("o_orderkey").cast("string")).alias("field_name"),
            F.when(status == "F", "string").when(status == "O", "boolean").otherwise("int").alias("data_type"),
        ),
        "source_logs": customer.select(F.col("c_custkey").alias("log_id"), F.col("c_name").alias("log_name")),
    }
