"""Queries on messages: decode, project, encode, key, route, batch, order, roll."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.payload import (
    decode_payload as decode,
    definition_list,
    encode_payload as encode,
    json_to_array as to_array,
    json_to_csv as to_csv,
    json_to_tsv as to_tsv,
    lookup,
)
from millrace.functions.timekeys import event_time as time_of, hour_key as key_of
from millrace.operators import messages as ops, processing, rolls, routing
from millrace.plans.inputs import (
    DEFINITIONS,
    NOW_MS,
    ON_MESSAGES,
    ON_PROCESSED,
    CELLS,
    MESSAGES,
    SETTINGS,
    messages,
    settings,
    with_ctes,
)
from millrace.plans.registry import query

ON_CELLS = with_ctes(MESSAGES, CELLS)
GOOD = definition_list(DEFINITIONS)


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir)
    return processing.decode_messages(rows.withColumn("decoder", F.lit("json")))


def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processing.drop_null_payload(decoded(spark, sf_dir))


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir)
    return processing.process_messages(rows.drop("ts_ms"), settings(rows), F.lit(NOW_MS).cast("bigint"))


@query(ON_MESSAGES + """
SELECT "offset", topic, json_extract_string(v, '$.k') AS k, json_extract_string(v, '$.ts') AS ts,
  CAST(json_extract(v, '$.user') AS VARCHAR) AS user
FROM (SELECT *, CASE WHEN topic <> 'error' AND json_valid(value) THEN value END AS v FROM messages)
""")
def decode_payload(spark, sf_dir):
    rows = messages(spark, sf_dir)
    decoder = F.when(F.col("topic") == "error", "unknown").otherwise("json")
    record = rows.select("offset", "topic", decode(F.col("value"), decoder).alias("record"))
    fields = [F.col("record")[k].alias(k) for k in ("k", "ts", "user")]
    return record.select("offset", "topic", *fields)


@query(ON_PROCESSED + 'SELECT "offset", encoder, line FROM processed')
def encode_payload(spark, sf_dir):
    rows = messages(spark, sf_dir)
    with_record = processing.decode_messages(processing.with_settings(rows, settings(rows)))
    kept = processing.drop_null_payload(with_record)
    line = encode(F.col("value"), F.col("record"), F.col("encoder"), F.col("layout"), decoder=F.col("decoder"))
    known = F.when(F.col("encoder") == "avro", "default").otherwise(F.col("encoder"))
    return kept.select("offset", known.alias("encoder"), line.alias("line"))


@query(ON_MESSAGES + 'SELECT topic, "offset", value FROM messages WHERE value IS NOT NULL AND NOT json_valid(value)')
def dead_letter(spark, sf_dir):
    return processing.dead_letter(decoded(spark, sf_dir)).select("topic", "offset", "value")


@query(ON_MESSAGES + 'SELECT topic, "offset", value FROM messages WHERE value IS NOT NULL AND json_valid(value)')
def drop_null_payload(spark, sf_dir):
    return good(spark, sf_dir).select("topic", "offset", "value")


@query(ON_CELLS + """
SELECT "offset", c0, c1, CASE WHEN json_type(value, '$.user.tag') = 'NULL' THEN NULL ELSE c2 END AS c2,
  '00000' AS c3, 'x' AS c4
FROM cells WHERE valid
""")
def json_to_array(spark, sf_dir):
    cells = good(spark, sf_dir).select("offset", to_array(F.col("record"), GOOD).alias("c"))
    return cells.select("offset", *[F.col("c")[i].alias(f"c{i}") for i in range(len(GOOD))])


@query(ON_CELLS + """SELECT "offset", concat_ws(',', c0, c1, c2, '00000', 'x') AS line FROM cells WHERE valid""")
def json_to_csv(spark, sf_dir):
    return good(spark, sf_dir).select("offset", to_csv(F.col("record"), GOOD).alias("line"))


@query(ON_CELLS + """SELECT "offset", concat_ws(chr(9), c0, c1, c2, '00000', 'x') AS line FROM cells WHERE valid""")
def json_to_tsv(spark, sf_dir):
    return good(spark, sf_dir).select("offset", to_tsv(F.col("record"), GOOD).alias("line"))


@query(ON_PROCESSED + 'SELECT "offset", line_ms AS ts_ms FROM processed')
def event_time(spark, sf_dir):
    return processed(spark, sf_dir).select("offset", "ts_ms")


@query(ON_MESSAGES + """
SELECT "offset", topic || '_' || strftime(make_timestamp(ts_ms * 1000), '%Y%m%d%H') AS key FROM messages
""")
def hour_key(spark, sf_dir):
    return messages(spark, sf_dir).select("offset", key_of(F.col("topic"), F.col("ts_ms")).alias("key"))


@query(ON_MESSAGES + """
SELECT 1 AS n_payloads, value AS payload, 'events' AS ds, 1 AS n_ids, CAST("offset" AS VARCHAR) AS id,
  topic, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END AS accept, ts_ms, priority
FROM messages
""")
def make_message(spark, sf_dir):
    rows = messages(spark, sf_dir).withColumns(
        {"ds": F.lit("events"), "accept": F.col("user_id") % 2 == 0}
    )
    made = ops.make_message(rows, ids="offset", ts="ts_ms")
    return made.select(
        F.size("payloads").alias("n_payloads"), F.col("payloads")[0].cast("string").alias("payload"),
        "ds", F.size("ids").alias("n_ids"), F.col("ids")[0].alias("id"), "topic",
        F.col("accept").cast("int").alias("accept"), F.col("ts").alias("ts_ms"), "priority",
    )


# --- routing -------------------------------------------------------------------------------

ROUTES = """
routes AS (
  SELECT DISTINCT topic, CASE topic WHEN 'error' THEN 'alerts' ELSE 'hourly' END AS processor
  FROM messages WHERE topic <> 'signup')
"""
ON_ROUTES = with_ctes(MESSAGES, ROUTES)


def routes(rows: DataFrame) -> DataFrame:
    topics = rows.select("topic").distinct().where("topic <> 'signup'")
    return topics.withColumn("processor", F.when(F.col("topic") == "error", "alerts").otherwise("hourly"))


@query(ON_ROUTES + 'SELECT "offset", topic, processor FROM messages JOIN routes USING (topic)')
def route(spark, sf_dir):
    rows = messages(spark, sf_dir)
    return routing.route(rows, routes(rows)).select("offset", "topic", "processor")


@query(ON_ROUTES + 'SELECT "offset", topic FROM messages WHERE topic NOT IN (SELECT topic FROM routes)')
def unroutable(spark, sf_dir):
    rows = messages(spark, sf_dir)
    return routing.unroutable(rows, routes(rows)).select("offset", "topic")


# --- packing and batching ------------------------------------------------------------------

BATCHES = """
batches AS (
  SELECT *, (row_number() OVER (PARTITION BY topic ORDER BY "offset") - 1) // 7 AS batch
  FROM messages WHERE value IS NOT NULL)
"""
ON_BATCHES = with_ctes(MESSAGES, BATCHES)
BLOCK_ROWS = 1024  # small blocks, so that the test tables have many


def batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir).where("value is not null")
    named = rows.select("topic", "offset", "value", F.col("offset").cast("string").alias("id"))
    return ops.batch_messages(named, 7, block_rows=BLOCK_ROWS)


@query(ON_BATCHES + """
SELECT topic, batch, count(*) AS n, string_agg(value, chr(10) ORDER BY "offset") AS payloads,
  string_agg(CAST("offset" AS VARCHAR), ',' ORDER BY "offset") AS ids
FROM batches GROUP BY topic, batch
""")
def pack_messages(spark, sf_dir):
    return ops.pack_messages(batched(spark, sf_dir)).select(
        "topic", "batch", F.size("payloads").alias("n"),
        F.array_join("payloads", "\n").alias("payloads"), F.array_join("ids", ",").alias("ids"),
    )


@query(ON_BATCHES + """
SELECT topic, batch, (row_number() OVER (PARTITION BY topic, batch ORDER BY "offset")) - 1 AS pos, value FROM batches
""")
def explode_payloads(spark, sf_dir):
    packed = ops.pack_messages(batched(spark, sf_dir)).withColumn("payloads", F.array("payloads"))
    return ops.explode_payloads(packed).select("topic", "batch", "pos", "value")


@query(ON_BATCHES + 'SELECT topic, batch, CAST("offset" AS VARCHAR) AS id FROM batches')
def explode_ids(spark, sf_dir):
    return ops.explode_ids(ops.pack_messages(batched(spark, sf_dir))).select("topic", "batch", "id")


@query(ON_MESSAGES + """, ended AS (
  SELECT *, CASE WHEN topic = 'error' AND value LIKE '{"k": 99,%' THEN NULL ELSE coalesce(value, '') END AS payload FROM messages),
cut AS (
  SELECT *, sum(CASE WHEN payload IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY topic ORDER BY part, "offset") AS nulls,
    row_number() OVER (PARTITION BY topic ORDER BY part, "offset") AS rn
  FROM ended)
SELECT topic, (rn - 1) // 50 AS batch, count(*) AS n, min("offset") AS first_offset, max("offset") AS last_offset
FROM cut WHERE nulls = 0 GROUP BY topic, (rn - 1) // 50
""")
def batch_messages(spark, sf_dir):
    rows = messages(spark, sf_dir)
    ends = (F.col("topic") == "error") & F.col("value").startswith('{"k": 99,')
    payload = F.when(~F.coalesce(ends, F.lit(False)), F.coalesce("value", F.lit("")))
    batches = ops.batch_messages(
        rows.select("topic", "partition", "offset", payload.alias("payload")), 50, stop_at_null="payload", block_rows=BLOCK_ROWS
    )
    return batches.groupBy("topic", "batch").agg(
        F.count("*").alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


@query(ON_MESSAGES + 'SELECT priority, ts_ms, topic, "offset" FROM messages')
def priority_order(spark, sf_dir):
    rows = messages(spark, sf_dir)
    return ops.priority_order(rows, ["ts_ms", "topic", "partition", "offset"]).select("priority", "ts_ms", "topic", "offset")


@query(ON_PROCESSED + """
SELECT key, part AS "partition", "offset" // 512 AS part, count(*) AS n, string_agg(line, chr(10) ORDER BY "offset") AS body
FROM processed GROUP BY key, processed.part, "offset" // 512
""")
def group_by_key(spark, sf_dir):
    groups = ops.group_by_key(processed(spark, sf_dir), ["key"], group_rows=512)
    return groups.select("key", "partition", "part", "n", F.array_join("lines", "\n").alias("body"))


# --- rolls ---------------------------------------------------------------------------------


@query(ON_PROCESSED + """
SELECT topic, roll, count(*) AS n, sum(b) AS bytes, min("offset") AS first_offset, max("offset") AS last_offset
FROM (
  SELECT *, (sum(b) OVER (PARTITION BY topic ORDER BY part, "offset") - b) // 10000 AS roll
  FROM (SELECT *, strlen(line) + 1 AS b FROM processed))
GROUP BY topic, roll
""")
def size_rolls(spark, sf_dir):
    rolled = rolls.size_rolls(processed(spark, sf_dir), ["topic"], roll_bytes=10_000, block_rows=BLOCK_ROWS)
    return rolled.groupBy("topic", "roll").agg(
        F.count("*").alias("n"), F.sum(rolls.line_bytes(F.col("line"))).alias("bytes"),
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
    )


@query(ON_MESSAGES + """
SELECT topic, roll, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms, count(*) AS n, sum(strlen(value) + 1) AS bytes
FROM (
  SELECT *, sum(opens) OVER (PARTITION BY topic ORDER BY ts_ms, "offset") AS roll
  FROM (
    SELECT *, CASE WHEN ts_ms - lag(ts_ms) OVER (PARTITION BY topic ORDER BY ts_ms, "offset") >= 900000 THEN 1 ELSE 0 END AS opens
    FROM messages WHERE value IS NOT NULL))
GROUP BY topic, roll
""")
def idle_rolls(spark, sf_dir):
    rows = messages(spark, sf_dir).where("value is not null")
    return rolls.idle_rolls(rows, ["topic"], line="value", idle_ms=900_000)


@query(ON_MESSAGES + """, lines AS (
  SELECT *, strlen(value) + 1 AS size, CASE WHEN ts_ms - lag(ts_ms) OVER w >= 900000 THEN 1 ELSE 0 END AS opens
  FROM messages WHERE value IS NOT NULL WINDOW w AS (PARTITION BY topic ORDER BY ts_ms, part, "offset")),
opened AS (SELECT *, sum(opens) OVER (PARTITION BY topic ORDER BY ts_ms, part, "offset") AS idle_no FROM lines)
SELECT topic, "offset", CAST(idle_no AS BIGINT) AS idle_no,
  CAST((sum(size) OVER (PARTITION BY topic, idle_no ORDER BY ts_ms, part, "offset") - size) // 300 AS BIGINT) AS roll
FROM opened
""")
def size_and_idle_rolls(spark, sf_dir):
    """The file of every line, where files end by size or by 15 idle minutes."""
    rows = messages(spark, sf_dir).where("value is not null")
    placed = rolls.size_and_idle_rolls(rows, ["topic"], line="value", roll_bytes=300, idle_ms=900_000, slot_ms=3_600_000)
    return placed.select("topic", "offset", "idle_no", "roll")


# --- hooks ---------------------------------------------------------------------------------

ON_PAIRS = """WITH pairs AS (
  SELECT event_id, event_type, epoch_us(ts) // 1000000 AS sec, user_id,
    'user=' || user_id || ';kind=' || event_type || ';sec=' || (epoch_us(ts) // 1000000) AS text
  FROM events)
"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ``name=value`` lists, a format of the user's own."""
    sec = F.floor(F.col("ts_ms") / 1000).cast("string")
    text = F.concat(
        F.lit("user="), F.col("user_id").cast("string"), F.lit(";kind="), F.col("topic"), F.lit(";sec="), sec
    )
    return messages(spark, sf_dir).select("offset", "topic", text.alias("value"))


def pair_decoder(value):
    return F.str_to_map(value, F.lit(";"), F.lit("="))


@query(ON_PAIRS + 'SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS user, event_type AS kind FROM pairs')
def custom_decoder(spark, sf_dir):
    record = decode(F.col("value"), F.lit("pairs"), {"pairs": pair_decoder})
    rows = pairs(spark, sf_dir).select("offset", record.alias("record"))
    return rows.select("offset", F.col("record")["user"].alias("user"), F.col("record")["kind"].alias("kind"))


@query(ON_CELLS + """SELECT "offset", concat_ws('|', c0, c1, c2, '00000', 'x') AS line FROM cells WHERE valid""")
def custom_encoder(spark, sf_dir):
    pipe = {"pipe": lambda value, record, defs: to_csv(record, defs, "|")}
    line = encode(F.col("value"), F.col("record"), F.lit("pipe"), GOOD, pipe)
    return good(spark, sf_dir).select("offset", line.alias("line"))


@query(ON_PAIRS + 'SELECT event_id AS "offset", sec * 1000 AS ts_ms FROM pairs')
def custom_time(spark, sf_dir):
    seconds = {"seconds": lambda record, path: lookup(record, path, None).try_cast("bigint") * 1000}
    record = pair_decoder(F.col("value"))
    ts_ms = time_of(record, F.lit("seconds"), F.lit(NOW_MS), ["sec"], seconds)
    return pairs(spark, sf_dir).select("offset", ts_ms.alias("ts_ms"))


@query(ON_PROCESSED + """
SELECT key, count(*) AS n, sum(strlen(line)) AS bytes FROM processed GROUP BY key
""")
def process_messages(spark, sf_dir):
    """The whole way of a message, counted by hour key."""
    lines = processed(spark, sf_dir)
    return lines.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.octet_length("line")).alias("bytes"))

