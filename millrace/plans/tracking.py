"""Queries on the run/done ledger, with orders as tracked units."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import ids
from millrace.functions.timekeys import epoch_millis
from millrace.operators import ledger as ops
from millrace.plans.inputs import ON_LEDGER, ON_UNITS, ledger, order_source, units
from millrace.plans.registry import query, table
from millrace.session import new_folder

CHANGED = "2005-01-01 00:00:00"  # an instant after all orders


def shown(state: DataFrame) -> DataFrame:
    """Ledger rows with the time as epoch milliseconds."""
    return state.select("dsid", "status", epoch_millis(F.col("ts")).alias("ts_ms"))


def instant(text: str = CHANGED):
    return F.lit(text).cast("timestamp_ntz")


@query(ON_LEDGER + "SELECT dsid FROM ledger")
def make_dsid(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(ids.make_dsid(order_source(), F.col("o_orderkey")).alias("dsid"))


@query(ON_LEDGER + """
SELECT split_part(dsid, chr(1), 1) AS ds, split_part(dsid, chr(1), 2) || chr(1) || 'part' AS ids, status, epoch_ms(ts) AS ts_ms
FROM ledger
""")
def split_dsid(spark, sf_dir):
    longer = F.concat_ws(ids.SEPARATOR, F.col("dsid"), F.lit("part"))
    rows = ops.deserialized(ledger(spark, sf_dir).withColumn("dsid", longer))
    return rows.select("ds", "ids", "status", epoch_millis(F.col("ts")).alias("ts_ms"))


@query(ON_LEDGER + """
SELECT dsid, status, epoch_ms(ts) AS ts_ms FROM ledger
WHERE starts_with(dsid, 'orders' || chr(1)) AND status = 'run' ORDER BY dsid, ts, status LIMIT 100
""")
def select_ds_messages(spark, sf_dir):
    return shown(ops.select_ds_messages(ledger(spark, sf_dir), "orders"))


@query(ON_LEDGER + """
SELECT dsid, status, epoch_ms(ts) AS ts_ms FROM ledger
WHERE status = 'done' AND ts >= TIMESTAMP '1998-01-01' ORDER BY dsid, ts, status LIMIT 100 OFFSET 20
""")
def select_messages(spark, sf_dir):
    where = "status = 'done' and ts >= timestamp_ntz'1998-01-01'"
    return shown(ops.select_messages(ledger(spark, sf_dir), where, 20))


@query(ON_LEDGER + """
SELECT dsid, status, epoch_ms(ts) AS ts_ms FROM ledger ORDER BY dsid, ts, status LIMIT 100 OFFSET 150
""")
def page(spark, sf_dir):
    return shown(ops.page(ledger(spark, sf_dir), 150))


@query(ON_LEDGER + """
SELECT dsid, status, epoch_ms(ts) AS ts_ms FROM ledger ORDER BY dsid, ts, status LIMIT 200 OFFSET 1000
""")
def page_deep(spark, sf_dir):
    """A page far down the ledger, without gathering the rows before it."""
    return shown(ops.page(ledger(spark, sf_dir), 1000, 200, range_rows=500))


@query(ON_LEDGER + """
SELECT status, count(*) AS n FROM ledger WHERE starts_with(dsid, 'orders' || chr(1)) GROUP BY status
""")
def status_counts(spark, sf_dir):
    return ops.status_counts(ledger(spark, sf_dir), "orders")


def events(spark, sf_dir) -> DataFrame:
    """Every order was put into run; finished orders were later marked done, urgent ones
    among them set to run again and then removed."""
    state = ledger(spark, sf_dir)
    start = state.select("dsid", F.lit("run").alias("status"), "ts", F.col("ts").alias("at"))
    finished = state.where("status = 'done'")
    done = finished.select("dsid", "status", "ts", F.expr("ts + interval 1 day").alias("at"))
    urgent = ops.of_source(finished, "urgent")
    again = urgent.select("dsid", F.lit("run").alias("status"), "ts", F.expr("ts + interval 2 day").alias("at"))
    gone = urgent.where("dsid like '%7'").select(
        "dsid", F.lit(None).cast("string").alias("status"), "ts", F.expr("ts + interval 3 day").alias("at")
    )
    return start.unionByName(done).unionByName(again).unionByName(gone)


@query(ON_LEDGER + """
SELECT dsid, CASE WHEN starts_with(dsid, 'urgent') THEN 'run' ELSE status END AS status, epoch_ms(ts) AS ts_ms
FROM ledger WHERE NOT (starts_with(dsid, 'urgent') AND status = 'done' AND dsid LIKE '%7')
""")
def latest_state(spark, sf_dir):
    return shown(ops.latest_state(events(spark, sf_dir)))


@query(ON_UNITS + """
SELECT DISTINCT dsid, 'run' AS status FROM units WHERE dsid NOT IN (SELECT dsid FROM ledger WHERE status = 'done')
""")
def mark_run(spark, sf_dir):
    known = ledger(spark, sf_dir).where("status = 'done'")
    return ops.mark_run(known, units(spark, sf_dir), instant()).select("dsid", "status")


@query(ON_UNITS + """
SELECT DISTINCT u.dsid, 'done' AS status, epoch_ms(l.ts) AS ts_ms FROM units u JOIN ledger l USING (dsid) WHERE l.status = 'run'
""")
def mark_done(spark, sf_dir):
    return shown(ops.mark_done(ledger(spark, sf_dir), units(spark, sf_dir), instant()))


@query(ON_UNITS + """
SELECT DISTINCT u.dsid, coalesce(l.status, 'unknown') AS status FROM units u LEFT JOIN ledger l USING (dsid)
WHERE l.status IS NULL OR l.status <> 'run'
""")
def invalid_transitions(spark, sf_dir):
    found = ops.invalid_transitions(ledger(spark, sf_dir), units(spark, sf_dir))
    return found.withColumn("status", F.coalesce("status", F.lit("unknown")))


@query(ON_LEDGER + """
SELECT dsid, status, epoch_ms(ts) AS ts_ms FROM ledger WHERE ts > TIMESTAMP '2000-06-01' - INTERVAL 28 DAYS
""")
def expire(spark, sf_dir):
    return shown(ops.expire_after(ledger(spark, sf_dir), instant("2000-06-01 00:00:00")))


@query(ON_UNITS + """
SELECT dsid, CASE WHEN dsid IN (SELECT dsid FROM units) THEN 'held' ELSE status END AS status, epoch_ms(ts) AS ts_ms
FROM ledger
""")
def update_message(spark, sf_dir):
    state = ledger(spark, sf_dir)
    changes = ops.update_message(state, units(spark, sf_dir), instant(), status=F.lit("held"))
    return shown(ops.apply_events(state, changes, instant("1990-01-01 00:00:00")))


@query(ON_UNITS + """
SELECT dsid, status, epoch_ms(ts) AS ts_ms FROM ledger WHERE dsid NOT IN (SELECT dsid FROM units)
""")
def delete_message(spark, sf_dir):
    state = ledger(spark, sf_dir)
    changes = ops.delete_message(state, units(spark, sf_dir), instant())
    return shown(ops.apply_events(state, changes, instant("1990-01-01 00:00:00")))


@query(ON_UNITS + "SELECT DISTINCT dsid FROM units")
def dedup_units(spark, sf_dir):
    return ops.dedup_units(units(spark, sf_dir))


@query(ON_LEDGER + """
SELECT 'orders' AS ds, split_part(dsid, chr(1), 2) AS ids, epoch_ms(ts) AS ts_ms FROM ledger
WHERE starts_with(dsid, 'orders' || chr(1)) AND status = 'run'
""")
def replay_run(spark, sf_dir):
    waiting = ops.replay_run(ledger(spark, sf_dir), "orders")
    return waiting.select("ds", "ids", epoch_millis(F.col("ts")).alias("ts_ms"))


@query(ON_LEDGER + """
SELECT 'orders' AS ds, split_part(dsid, chr(1), 2) AS ids FROM ledger
WHERE starts_with(dsid, 'orders' || chr(1)) AND status = 'run'
  AND split_part(dsid, chr(1), 2) IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_linestatus = 'O')
""")
def processor_replay(spark, sf_dir):
    there = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'")
    listing = there.select(F.col("l_orderkey").cast("string").alias("path"))
    return ops.processor_replay(ledger(spark, sf_dir), "orders", listing).select("ds", "ids")


@query("""
SELECT ds || chr(1) || id AS dsid, CASE WHEN status = 'F' THEN 'done' ELSE 'run' END AS status, 946684800000 AS ts_ms
FROM (SELECT 'orders-' || o_orderpriority AS ds, o_orderkey AS id, o_orderstatus AS status FROM orders)
""")
def ledger_table(spark, sf_dir):
    """Orders as units of a stored ledger: tracked, compacted, and some marked done batch by batch."""
    orders = table(spark, sf_dir, "orders")
    source = F.concat(F.lit("orders-"), F.col("o_orderpriority")).alias("ds")
    wanted = orders.select(source, F.col("o_orderkey").alias("id"), "o_orderstatus", "o_orderpriority")
    kept = ops.LedgerTable(spark, new_folder(spark, "ledger"))
    kept.mark_run(wanted, instant("2000-01-01 00:00:00").cast("timestamp"), "run")
    kept.compact()
    for turn in range(2):
        mine = wanted.where((F.col("o_orderstatus") == "F") & ((F.left("o_orderpriority", F.lit(1)) <= "2") == (turn == 0)))
        kept.mark_done(mine, instant().cast("timestamp"), f"done-{turn}")
    return kept.state().select("dsid", "status", F.unix_millis("ts").alias("ts_ms"))
