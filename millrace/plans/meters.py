"""Queries on rates, counters, distributions and typed bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import values
from millrace.functions.timekeys import floor_div
from millrace.operators import meters as ops, routing
from millrace.plans.inputs import MESSAGES, ON_MESSAGES, ON_PROCESSED, messages, with_ctes
from millrace.plans.messages import ROUTES, processed, routes
from millrace.plans.registry import query, table
from millrace.streaming import jobs

HOUR = 3_600_000


@query(ON_PROCESSED + """, per AS (
  SELECT topic, false AS whole, line_ms // 3600000 * 3600000 AS window_ms, count(*) AS n, sum(strlen(line)) AS bytes FROM processed GROUP BY ALL
  UNION ALL SELECT 'total', true, line_ms // 3600000 * 3600000, count(*), sum(strlen(line)) FROM processed GROUP BY ALL)
SELECT topic, whole, window_ms, n, bytes, round(n / 3600.0::DOUBLE, 9) AS n_per_sec, round(bytes / 3600.0::DOUBLE, 9) AS bytes_per_sec FROM per
""")
def topic_throughput(spark, sf_dir):
    rates = ops.topic_throughput(processed(spark, sf_dir), window_ms=HOUR)
    return rates.withColumns({c: F.round(c, 9) for c in ("n_per_sec", "bytes_per_sec")})


@query(with_ctes(MESSAGES, ROUTES) + """, per AS (
  SELECT processor, false AS whole, ts_ms // 3600000 * 3600000 AS window_ms, count(*) AS n FROM messages JOIN routes USING (topic) GROUP BY ALL
  UNION ALL SELECT 'total', true, ts_ms // 3600000 * 3600000, count(*) FROM messages JOIN routes USING (topic) GROUP BY ALL)
SELECT processor, whole, window_ms, n, round(n / 3600.0::DOUBLE, 9) AS n_per_sec FROM per
""")
def publish_rate(spark, sf_dir):
    rows = messages(spark, sf_dir)
    rates = ops.publish_rate(routing.route(rows, routes(rows)), window_ms=HOUR)
    return rates.withColumn("n_per_sec", F.round("n_per_sec", 9))


def rate_sql(minutes: int) -> str:
    part = f"CASE WHEN t = t0 THEN 1 ELSE 1 - exp(-1 / 12e0 / {minutes}) END"
    return f"round(sum(c.n / 300e0 * {part} * exp(-(m * 12 + 11 - t) / 12e0 / {minutes})), 9) AS rate_{minutes}"


@query(ON_MESSAGES + f"""
, c AS (SELECT topic, ts_ms // 300000 AS t, count(*) AS n FROM messages GROUP BY ALL),
f AS (SELECT topic, min(t) AS t0 FROM c GROUP BY topic), m AS (SELECT DISTINCT topic, t // 12 AS m FROM c)
SELECT topic, m * 3600000 AS minute_ms, {rate_sql(1)}, {rate_sql(5)}, {rate_sql(15)}
FROM m JOIN f USING (topic) JOIN c USING (topic) WHERE t <= m * 12 + 11 GROUP BY topic, m
""")
def moving_rates(spark, sf_dir):
    """Rates that fade, with ticks of five minutes, so that a minute of twelve ticks is an hour."""
    rates = ops.moving_rates(messages(spark, sf_dir), "topic", tick_ms=300_000)
    return rates.withColumns({f"rate_{m}": F.round(f"rate_{m}", 9) for m in ops.MINUTES})


@query("""
SELECT l_returnflag AS name, q, count(*) AS n, min(l_extendedprice) AS min, max(l_extendedprice) AS max, true AS close
FROM lineitem, (SELECT unnest([0.5::DOUBLE, 0.75, 0.95, 0.98, 0.99, 0.999]) AS q) GROUP BY ALL
""")
def value_sketches(spark, sf_dir):
    """Quantiles of prices from a sketch per flag and month, and whether their true ranks are as close as promised."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("name"), F.col("l_extendedprice").cast("double").alias("value"),
        (F.unix_date(F.trunc(F.col("l_shipdate").cast("date"), "month")).cast("bigint") * 86_400_000).alias("ts_ms"),
    )
    found = ops.sketched_quantiles(ops.value_sketches(items, width_ms=86_400_000), ["name"])
    ranked = items.join(F.broadcast(found), "name").groupBy("name", "q", "n", "min", "max").agg(
        F.avg((items["value"] <= found["value"]).cast("double")).alias("rank")
    )  # a row per name and quantile is broadcast
    return ranked.select("name", "q", "n", "min", "max", (F.abs(F.col("rank") - F.col("q")) <= 0.02).alias("close"))


@query(ON_MESSAGES + """
SELECT topic, part AS "partition", "offset" // 500 AS batch, min("offset") AS min_offset, max("offset") AS max_offset, count(*) AS n
FROM messages GROUP BY topic, part, "offset" // 500
""")
def offset_ranges(spark, sf_dir):
    return ops.offset_ranges(messages(spark, sf_dir), floor_div(F.col("offset"), 500))


@query("SELECT event_type AS topic, epoch_ms(date_trunc('hour', ts)) AS hour_ms, count(*) AS n FROM events GROUP BY ALL")
def hourly_counts(spark, sf_dir):
    rows = messages(spark, sf_dir).withColumn("ts", F.timestamp_millis("ts_ms"))
    return jobs.hourly_counts(rows).select("topic", F.unix_millis("hour").alias("hour_ms"), "n")


@query("""
SELECT l_returnflag AS name, CAST(sum(CASE l_linestatus WHEN 'F' THEN l_quantity ELSE -l_quantity END) AS BIGINT) AS value
FROM lineitem GROUP BY l_returnflag
""")
def counter_totals(spark, sf_dir):
    quantity = F.col("l_quantity").cast("bigint")
    changes = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("name"), F.when(F.col("l_linestatus") == "F", quantity).otherwise(-quantity).alias("delta")
    )
    return ops.counter_totals(changes)


@query("""
WITH v AS (SELECT l_returnflag AS name, CAST(floor(l_extendedprice * 100 + 0.5::DOUBLE) AS BIGINT) AS value FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY value) AS rn, count(*) OVER (PARTITION BY name) AS n FROM v)
SELECT name, max(n) AS n, min(value) AS min, max(value) AS max, round(avg(value), 3) AS mean, round(stddev_samp(value), 3) AS stddev,
  max(CASE WHEN rn = ceil(0.5 * n) THEN value END) AS p50, max(CASE WHEN rn = ceil(0.75 * n) THEN value END) AS p75,
  max(CASE WHEN rn = ceil(0.95 * n) THEN value END) AS p95, max(CASE WHEN rn = ceil(0.98 * n) THEN value END) AS p98,
  max(CASE WHEN rn = ceil(0.99 * n) THEN value END) AS p99, max(CASE WHEN rn = ceil(0.999 * n) THEN value END) AS p99_9
FROM r GROUP BY name
""")
def value_distribution(spark, sf_dir):
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("name"), cents.alias("value"))
    return ops.value_distribution(rows).withColumns({c: F.round(c, 3) for c in ("mean", "stddev")})


@query("""
SELECT l_orderkey, l_linenumber, lpad(hex(l_orderkey), 16, '0') AS key_hex, lpad(hex(-l_orderkey - 1), 16, '0') AS negative_hex,
  lpad(hex(l_linenumber), 8, '0') AS line_hex, hex(l_returnflag || 'é') AS text_hex
FROM lineitem
""")
def encode_values(spark, sf_dir):
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    text = F.concat("l_returnflag", F.lit("é"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.hex(values.long_bytes(key)).alias("key_hex"), F.hex(values.long_bytes(-key - 1)).alias("negative_hex"),
        F.hex(values.int_bytes(line)).alias("line_hex"), F.hex(values.text_bytes(text)).alias("text_hex"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_orderkey AS long_value, -l_linenumber AS int_value, 0 AS other_value,
  CAST(l_orderkey AS VARCHAR) AS long_text, CAST(-l_linenumber AS VARCHAR) AS int_text, l_returnflag || '-ab' AS text,
  CAST(((48 * 256 + 48) * 256 + 48) * 256 + ascii(CAST(l_linenumber AS VARCHAR)) AS VARCHAR) AS digits, l_linenumber AS tagged
FROM lineitem
""")
def decode_values(spark, sf_dir):
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    stored = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        values.long_bytes(key).alias("long"),
        values.int_bytes(-line).alias("int"),
        values.text_bytes(F.col("l_returnflag")).alias("flag"),
        values.text_bytes(F.concat("l_returnflag", F.lit("-ab"))).alias("words"),
        values.text_bytes(F.lpad(line.cast("string"), 4, "0")).alias("number"),
        values.tagged_bytes(line.cast("string"), F.lit("i")).alias("tagged"),
    )
    return stored.select(
        "l_orderkey", "l_linenumber",
        values.long_value(F.col("long")).alias("long_value"),
        values.long_value(F.col("int")).alias("int_value"),
        values.long_value(F.col("flag")).alias("other_value"),
        values.text_value(F.col("long")).alias("long_text"),
        values.text_value(F.col("int")).alias("int_text"),
        values.text_value(F.col("words")).alias("text"),
        values.text_value(F.col("number")).alias("digits"),
        values.long_value(F.col("tagged")).alias("tagged"),
    )
