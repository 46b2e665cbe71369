"""Queries that write and read back: sinks, sources and streams over the test tables."""

from __future__ import annotations

import datetime

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import files, meters, processing
from millrace.operators.ledger import LedgerTable, dedup_units_stream as dedup_stream, deserialized, replay_run
from millrace.plans.inputs import (
    LINES,
    MESSAGES,
    NOW_MS,
    ON_LINES,
    ON_MESSAGES,
    ON_PROCESSED,
    messages,
    settings,
    with_ctes,
)
from millrace.plans.messages import ROUTES, processed, routes
from millrace.plans.registry import query, table
from millrace.session import new_folder
from millrace.sinks import imports, text, topics as topic_sink
from millrace.sources import lines as line_source, topics as topic_source
from millrace.streaming import compaction, jobs, rolls
from millrace.streaming.subscriptions import Subscriptions
from millrace.streaming.rolls import folder_name

RECORDS = "topic string, partition int, offset bigint, value string, ts_ms bigint"
TREE = "value string, topic string, dt string, hr string"
HOST = "host-a"


def instant():
    return F.timestamp_millis(F.lit(NOW_MS))


def landed_topics(spark: SparkSession, sf_dir: str) -> str:
    """Messages as record files, as a connector would deliver them."""
    folder = new_folder(spark, "topics")
    messages(spark, sf_dir).select("topic", "partition", "offset", "value", "ts_ms").write.parquet(folder)
    return folder


def written_lines(spark: SparkSession, sf_dir: str) -> str:
    """Documents as text files."""
    folder = new_folder(spark, "lines")
    text.write_lines(table(spark, sf_dir, "documents"), folder, "text")
    return folder


# --- text files ----------------------------------------------------------------------------


@query(ON_LINES + "SELECT value FROM lines")
def read_lines(spark, sf_dir):
    return line_source.read_lines(spark, written_lines(spark, sf_dir))


@query("""
SELECT lang, CAST(sum(strlen(text) + 1) AS BIGINT) AS size FROM documents WHERE text IS NOT NULL GROUP BY lang
UNION ALL SELECT 'none', 0
""")
def list_files(spark, sf_dir):
    """Documents as text files by language, and an empty file: sizes of the listed files by folder."""
    folder = new_folder(spark, "listed")
    docs = table(spark, sf_dir, "documents").where("text is not null")
    docs.select(F.col("text").alias("value"), "lang").write.partitionBy("lang").text(folder)
    empty = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/lang=none/empty.txt")
    empty.getFileSystem(spark._jsc.hadoopConfiguration()).create(empty).close()
    found = line_source.list_files(spark, f"{folder}/lang=*", "*.txt")
    lang = F.regexp_extract("path", "lang=([^/]+)/", 1).alias("lang")
    return found.groupBy(lang).agg(F.sum("size").alias("size"))


@query(ON_MESSAGES + "SELECT value FROM messages WHERE value IS NOT NULL")
def write_lines(spark, sf_dir):
    folder = new_folder(spark, "lines")
    text.write_lines(messages(spark, sf_dir), folder)
    return line_source.read_lines(spark, folder)


@query(ON_PROCESSED + """
SELECT topic, strftime(make_timestamp(line_ms * 1000), '%Y%m%d') AS dt, strftime(make_timestamp(line_ms * 1000), '%Y%m%d%H') AS hr,
  line AS value
FROM processed
""")
def write_hourly(spark, sf_dir):
    folder = new_folder(spark, "hourly")
    text.write_hourly(processed(spark, sf_dir), folder)
    return spark.read.schema(TREE).text(folder)


# --- landed files to the dated tree --------------------------------------------------------

def landed_sql(name: str, directory: str) -> str:
    """Rows of the dated tree: files of a topic and day each, named by a file model after its first hour."""
    return with_ctes(MESSAGES) + f"""
SELECT type, {directory}, 'host-a-' || {name} AS src, value
FROM (SELECT *, topic AS type, strftime(t, '%Y%m%d%H') AS hour FROM (SELECT *, date_trunc('day', make_timestamp(ts_ms * 1000)) AS t FROM messages))
WHERE value IS NOT NULL
"""


FLAT = "strftime(t, '%Y%m%d') AS dt, hour AS hr"
NESTED = "strftime(t, '%Y') AS year, strftime(t, '%m') AS month, strftime(t, '%d') AS day, strftime(t, '%H') AS hour"
BY_DAY = "strftime(t, '%Y%m%d') AS day"


def landed_files(spark: SparkSession, sf_dir: str, name) -> tuple[str, LedgerTable]:
    """Messages as landed files of one topic and day each, every file tracked in ``run``."""
    folder = new_folder(spark, "landed")
    rows = messages(spark, sf_dir).where("value is not null")
    named = rows.select("value", name(F.col("topic"), F.date_trunc("day", F.timestamp_millis("ts_ms"))).alias("name"))
    text.clustered(named, ["name"]).write.partitionBy("name").text(folder)
    tracked = LedgerTable(spark, new_folder(spark, "ledger"))
    found = line_source.list_files(spark, f"{folder}/name=*", "*.txt")
    tracked.mark_run(found.select(F.lit("rolled").alias("ds"), F.col("path").alias("id")), instant(), "run-0")
    return f"{folder}/name=*", tracked


def model_1(topic, ts):
    return F.concat(topic, F.lit("_1_hr_"), F.date_format(ts, "yyyyMMddHH"))


def model_2(topic, ts):
    return F.concat(topic, F.lit("_"), F.date_format(ts, "yyyy-MM-dd-HH"), F.lit(".gz"))


def own_name(topic, ts):
    return F.concat(F.date_format(ts, "yyyyMMddHH"), F.lit("+"), topic)


def own_parser(name):
    parts = F.split(name, r"\+")
    return F.struct(parts[1].alias("type"), F.lit("1").alias("id"), parts[0].alias("date_hour"))


def running_units(tracked: LedgerTable) -> DataFrame:
    return replay_run(tracked.state(), "rolled").select("ds", F.col("ids").alias("id"))


def imported(spark: SparkSession, out: str, keys: str) -> DataFrame:
    columns = ["type", *keys.split(), "src"]
    tree = ", ".join(f"{c} string" for c in ["value", *columns])
    return spark.read.schema(tree).option("basePath", out).text(f"{out}/batch=*").select(*columns, "value")


@query(landed_sql("type || '_1_hr_' || hour", FLAT))
def import_files(spark, sf_dir):
    landed, tracked = landed_files(spark, sf_dir, model_1)
    out = new_folder(spark, "imported")
    units = running_units(tracked)
    imports.import_files(spark, units, out, tracked, "0", HOST, instant(), landed=landed, name_of=folder_name)
    return imported(spark, out, "dt hr")


@query(landed_sql("hour || '+' || type", BY_DAY))
def import_files_custom(spark, sf_dir):
    """File and directory models of the user's own, and files deleted once they are done."""
    landed, tracked = landed_files(spark, sf_dir, own_name)
    out = new_folder(spark, "imported")
    models = {
        "file_model": 3, "file_models": {3: own_parser},
        "dir_model": 3, "dir_models": {3: lambda hour: F.concat(F.lit("day="), F.left(hour, F.lit(8)))},
    }
    imports.import_files(
        spark, running_units(tracked), out, tracked, "0", HOST, instant(), landed=landed, delete=True,
        name_of=folder_name, **models,
    )
    return imported(spark, out, "day")


@query(landed_sql("type || '_' || strftime(t, '%Y-%m-%d-%H') || '.gz'", NESTED))
def upload_stream(spark, sf_dir):
    """File model 2 into directory model 2, one tick of the stream."""
    landed, tracked = landed_files(spark, sf_dir, model_2)
    out, work = new_folder(spark, "imported"), new_folder(spark, "stream")
    jobs.upload_stream(
        spark, landed, out, tracked, "rolled", HOST, work, at=instant(), every=None,
        name_of=folder_name, file_model=2, dir_model=2,
    ).awaitTermination()
    return imported(spark, out, "year month day hour")


# --- topics --------------------------------------------------------------------------------


@query(ON_MESSAGES + """SELECT topic, part AS "partition", "offset", value FROM messages WHERE topic IN ('click', 'view')""")
def read_topics(spark, sf_dir):
    stream = topic_source.read_topic_files(spark, landed_topics(spark, sf_dir), RECORDS, ["click", "view"])
    out, work = new_folder(spark, "read"), new_folder(spark, "stream")
    sink = stream.drop("ts_ms").writeStream.format("parquet").option("path", out).option("checkpointLocation", work)
    jobs.triggered(sink, None).start().awaitTermination()
    return spark.read.parquet(out)


@query(ON_MESSAGES + "SELECT topic, value FROM messages WHERE value IS NOT NULL")
def write_topics(spark, sf_dir):
    folder = new_folder(spark, "published")
    topic_sink.write_topic_files(messages(spark, sf_dir).where("value is not null"), folder)
    return spark.read.parquet(folder).withColumn("value", F.col("value").cast("string"))


@query(ON_PROCESSED + """, per AS (
  SELECT topic, false AS whole, line_ms // 3600000 * 3600000 AS window_ms, count(*) AS n, sum(strlen(line)) AS bytes FROM processed GROUP BY ALL
  UNION ALL SELECT 'total', true, line_ms // 3600000 * 3600000, count(*), sum(strlen(line)) FROM processed GROUP BY ALL)
SELECT topic, whole, window_ms, n, bytes, n / 3600.0 AS n_per_sec, bytes / 3600.0 AS bytes_per_sec FROM per
""")
def throughput_report(spark, sf_dir):
    folder = new_folder(spark, "report")
    rates = meters.topic_throughput(processed(spark, sf_dir), window_ms=3_600_000)
    text.write_report(rates, folder)
    schema = "topic string, whole boolean, window_ms bigint, n bigint, bytes bigint, n_per_sec double, bytes_per_sec double"
    return spark.read.schema(schema).option("header", True).csv(folder)


# --- streams -------------------------------------------------------------------------------

HOURLY = ON_PROCESSED + """
SELECT topic, strftime(make_timestamp(line_ms * 1000), '%Y%m%d%H') AS hr, line AS value FROM processed
UNION ALL SELECT 'dead:' || topic, NULL, value FROM messages
WHERE topic <> 'error' AND value IS NOT NULL AND NOT json_valid(value)
"""


def topic_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_source.read_topic_files(spark, landed_topics(spark, sf_dir), RECORDS)


def hours_and_letters(spark: SparkSession, folder: str) -> DataFrame:
    """What was written by topic and hour, and the dead letters."""
    read = spark.read.schema(TREE).option("basePath", folder).text(f"{folder}/batch=*")
    dead = spark.read.parquet(f"{folder}.dead/batch=*")
    letters = dead.select(F.concat(F.lit("dead:"), "topic").alias("topic"), F.lit(None).cast("string").alias("hr"), "value")
    return read.select("topic", "hr", "value").unionByName(letters)


@query(HOURLY)
def hourly_stream(spark, sf_dir):
    """All topics with their own decoders, encoders and time parsers."""
    chosen = settings(messages(spark, sf_dir))
    out, work = new_folder(spark, "hourly"), new_folder(spark, "stream")
    stream = topic_stream(spark, sf_dir).drop("ts_ms")
    jobs.hourly_stream(stream, chosen, out, work, now_ms=F.lit(NOW_MS).cast("bigint"), every=None, salts=1).awaitTermination()
    return hours_and_letters(spark, out)


TARGET_BYTES = 4_000
FILE_ROWS = 250_000  # most rows of a landed file, which one task decodes and keeps


@query(ON_PROCESSED + """, lines AS (
  SELECT topic, strftime(make_timestamp(line_ms * 1000), '%Y%m%d%H') AS hr, line AS value FROM processed)
SELECT topic, hr, value, CASE WHEN hr < (SELECT max(hr) FROM lines) THEN true END AS packed FROM lines
""")
def compact_hours(spark, sf_dir):
    """The hourly stream in several micro-batches, then two runs of compaction: up to the middle hour, and all but
    the last one. A closed hour is packed if it has no more files than its bytes need."""
    chosen = settings(messages(spark, sf_dir))
    landed, out, work = (new_folder(spark, n) for n in ("topics", "hourly", "stream"))
    records = messages(spark, sf_dir).select("topic", "partition", "offset", "value", "ts_ms")
    files_each = 1 + records.count() // (3 * FILE_ROWS)
    records.repartition(3 * files_each, "offset").write.parquet(landed)
    stream = topic_source.read_topic_files(spark, landed, RECORDS, per_trigger=files_each).drop("ts_ms")
    jobs.hourly_stream(stream, chosen, out, work, now_ms=F.lit(NOW_MS).cast("bigint"), every=None, salts=1).awaitTermination()
    hours = compaction.hour_files(spark, out).agg(F.min("hr").alias("lo"), F.max("hr").alias("hi")).first()
    middle = compaction.hour_files(spark, out).agg(F.percentile_approx(F.col("hr").cast("bigint"), 0.5).alias("m")).first()["m"]
    compaction.compact_hours(spark, out, 0, str(middle), target_bytes=TARGET_BYTES)
    compaction.compact_hours(spark, out, 1, hours["hi"], target_bytes=TARGET_BYTES, newest=True)
    sizes = compaction.hour_files(spark, out).groupBy("topic", "hr").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    most = F.ceil(F.col("bytes") / TARGET_BYTES) + 1
    good = sizes.select("topic", "hr", F.when(F.col("hr") < hours["hi"], F.col("n") <= most).alias("packed"))
    return compaction.hour_lines(spark, out).join(good, ["topic", "hr"]).select("topic", "hr", "value", "packed")


@query(HOURLY)
def refresh_settings(spark, sf_dir):
    """As hourly_stream, with settings that are read from a table for every batch."""
    kept = new_folder(spark, "settings")
    settings(messages(spark, sf_dir)).write.parquet(kept)
    out, work = new_folder(spark, "hourly"), new_folder(spark, "stream")
    stream = topic_stream(spark, sf_dir).drop("ts_ms")
    load = lambda session: session.read.parquet(kept)
    jobs.refresh_settings(stream, load, out, work, now_ms=F.lit(NOW_MS).cast("bigint"), every=None, salts=1).awaitTermination()
    return hours_and_letters(spark, out)


WANTED = (("click", "view"), ("view", "purchase"), ("click", "view"))  # topics by step


@query(ON_MESSAGES + f""", parts AS (
  SELECT topic, value, ("offset" - lo) * {len(WANTED)} // (hi - lo + 1) AS part
  FROM messages, (SELECT min("offset") AS lo, max("offset") AS hi FROM messages))
SELECT topic, CASE WHEN topic = 'click' AND part = 1 THEN 2 WHEN topic = 'purchase' AND part = 0 THEN 1 ELSE part END AS step, value
FROM parts WHERE topic IN ('click', 'view') OR (topic = 'purchase' AND part <= 1)
""")
def subscriptions(spark, sf_dir):
    """Three parts of the messages land, and the list of topics changes with each: one topic stays, one goes and comes
    back, which then reads what it missed, one is there in the middle and reads what was there before."""
    rows = messages(spark, sf_dir)
    low, high = rows.agg(F.min("offset"), F.max("offset")).first()
    part = F.floor((F.col("offset") - low) * len(WANTED) / (high - low + 1))
    landed, out, state, listed = (new_folder(spark, n) for n in ("topics", "read", "stream", "wanted"))
    step = 0

    def start(topic: str, checkpoint: str):
        stream = topic_source.read_topic_files(spark, landed, RECORDS, [topic]).select("topic", "value", F.lit(step).cast("bigint").alias("step"))
        folder = f"{out}/{topic}"

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

        return jobs.triggered(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), None).start()

    wanted = Subscriptions(spark, lambda session: session.read.parquet(listed), start, state)
    for step, names in enumerate(WANTED):
        rows.where(part == step).select("topic", "partition", "offset", "value", "ts_ms").write.mode("append").parquet(landed)
        on = rows.where(F.col("topic").isin(*names)).select("topic").distinct()
        on.write.mode("overwrite").parquet(listed)
        wanted.refresh()
        wanted.await_all()
    return spark.read.option("recursiveFileLookup", True).parquet(out).select("topic", "step", "value")


@query(ON_PROCESSED + """
SELECT topic, strftime(make_timestamp(line_ms * 1000), '%Y%m%d%H') AS hr, 'run' AS status, count(*) AS n,
  CAST(sum(strlen(line)) AS BIGINT) AS bytes
FROM processed GROUP BY 1, 2
""")
def rolled_files(spark, sf_dir):
    """Encoded lines by topic and hour in the files that the ledger has in run."""
    chosen = settings(messages(spark, sf_dir))
    stream = topic_stream(spark, sf_dir).drop("ts_ms")
    lines = processing.process_messages(stream, chosen, F.lit(NOW_MS).cast("bigint"))
    out, work = new_folder(spark, "rolled"), new_folder(spark, "stream")
    tracked = LedgerTable(spark, new_folder(spark, "ledger"))
    jobs.rolled_files(lines, out, tracked, "rolled", work, instant(), every=None, salts=1).awaitTermination()
    written = (
        spark.read.schema(TREE).option("basePath", out).text(f"{out}/batch=*")
        .groupBy(F.col("_metadata.file_path").alias("ids"), "topic", "hr")
        .agg(F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("bytes"))
    )
    known = written.join(deserialized(tracked.state()), "ids")
    return known.groupBy("topic", "hr", "status").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))


@query(ON_MESSAGES + "SELECT DISTINCT topic || chr(1) || part || '-' || ts_ms // 3600000 AS dsid FROM messages")
def dedup_units_stream(spark, sf_dir):
    """A unit per partition and hour, wanted by every message of it, once."""
    stream = topic_source.read_topic_files(spark, landed_topics(spark, sf_dir), RECORDS)
    hour = F.concat_ws("-", F.col("partition").cast("string"), F.floor(F.col("ts_ms") / 3_600_000).cast("string"))
    units = stream.select(F.col("topic").alias("ds"), hour.alias("id"), F.timestamp_millis("ts_ms").alias("ts"))
    out, work = new_folder(spark, "units"), new_folder(spark, "stream")
    sink = dedup_stream(units, within="2 hours").writeStream.format("parquet").option("path", out)
    jobs.triggered(sink.option("checkpointLocation", work), None).start().awaitTermination()
    return spark.read.parquet(out).select("dsid")


ROLL_BYTES, ROLL_BATCHES, IDLE_BATCHES = 20_000, 3, 2
CLOSED_ROLLS = ON_PROCESSED.replace("WITH ", "WITH RECURSIVE ", 1) + f""", placed AS (
  SELECT topic, hr, b, size, coalesce(sum(size) OVER (PARTITION BY topic, hr, b ORDER BY part, "offset" ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0) // {ROLL_BYTES // rolls.SEGMENTS_PER_ROLL} AS seg
  FROM (SELECT topic, part, "offset", strlen(line) + 1 AS size, strftime(make_timestamp(line_ms * 1000), '%Y%m%d%H') AS hr,
      ("offset" - lo) * {ROLL_BATCHES} // (hi - lo + 1) AS b
    FROM processed, (SELECT min("offset") AS lo, max("offset") AS hi FROM messages))),
segs AS (SELECT topic, hr, b, seg, count(*) AS n, sum(size) AS bytes, row_number() OVER (PARTITION BY topic, hr ORDER BY b, seg) AS k
  FROM placed GROUP BY topic, hr, b, seg),
r AS (SELECT topic, hr, k, b, b || '-' || seg AS first, n, bytes FROM segs WHERE k = 1
  UNION ALL SELECT s.topic, s.hr, s.k, s.b, CASE WHEN anew THEN s.b || '-' || s.seg ELSE r.first END,
    CASE WHEN anew THEN s.n ELSE r.n + s.n END, CASE WHEN anew THEN s.bytes ELSE r.bytes + s.bytes END
  FROM (SELECT r.*, s.b AS sb, s.seg, s.n AS sn, s.bytes AS sbytes, s.k AS sk FROM r JOIN segs s ON s.topic = r.topic AND s.hr = r.hr AND s.k = r.k + 1) j,
    LATERAL (SELECT j.topic, j.hr, j.sk AS k, j.sb AS b, j.seg, j.sn AS n, j.sbytes AS bytes, j.bytes >= {ROLL_BYTES} OR j.sb - j.b >= {IDLE_BATCHES} AS anew) s,
    LATERAL (SELECT j.n, j.bytes, j.first) r),
closed AS (SELECT topic || '_' || first || '_hr_' || hr AS name, CAST(max(n) AS BIGINT) AS n, CAST(max(bytes) AS BIGINT) AS bytes
  FROM r GROUP BY topic, hr, first HAVING max(bytes) >= {ROLL_BYTES} OR max(b) + {IDLE_BATCHES} < {ROLL_BATCHES})
"""


def rolled_batches(spark: SparkSession, sf_dir: str) -> tuple[str, LedgerTable]:
    """Messages that land in three parts, an hour after the other, as rolled files tracked in ``run``."""
    rows = messages(spark, sf_dir)
    chosen = settings(rows)
    low, high = rows.agg(F.min("offset"), F.max("offset")).first()
    part = F.floor((F.col("offset") - low) * ROLL_BATCHES / (high - low + 1))
    landed, work, out, state = (new_folder(spark, n) for n in ("topics", "segments", "rolled", "stream"))
    tracked = LedgerTable(spark, new_folder(spark, "ledger"))
    for number in range(ROLL_BATCHES):
        mine = rows.where(part == number).select("topic", "partition", "offset", "value", "ts_ms")
        mine.repartition("offset").write.mode("append").parquet(landed)  # a part of the offsets is in few of the table's files
        stream = topic_source.read_topic_files(spark, landed, RECORDS).drop("ts_ms")
        lines = processing.process_messages(stream, chosen, F.lit(NOW_MS).cast("bigint"))
        clock = lambda batch: datetime.datetime(2024, 2, 1, batch, tzinfo=datetime.timezone.utc)
        rolls.write_segments(lines, work, f"{state}/lines", ROLL_BYTES, clock, every=None).awaitTermination()
    idle = IDLE_BATCHES * 3_600_000
    rolls.close_rolls(spark, work, out, tracked, "rolled", f"{state}/rolls", ROLL_BYTES, idle, instant(), every=None).awaitTermination()
    return out, tracked


@query(CLOSED_ROLLS + "SELECT name, 'done' AS status, n, bytes FROM closed")
def rolls_to_done(spark, sf_dir):
    """The way of a line from its topic through a file that goes on over three micro-batches, and is closed by
    size or after two idle hours, into the dated tree."""
    out, tracked = rolled_batches(spark, sf_dir)
    tree, work = new_folder(spark, "imported"), new_folder(spark, "stream")
    jobs.upload_stream(
        spark, f"{out}/batch=*/name=*", tree, tracked, "rolled", HOST, work, delete=True, at=instant(), every=None,
        name_of=folder_name,
    ).awaitTermination()
    done = deserialized(tracked.state()).select(folder_name(F.col("ids")).alias("name"), "status")
    lines = imported(spark, tree, "dt hr").withColumn("name", F.expr(f"substring(src, {len(HOST) + 2})"))
    sizes = lines.groupBy("name").agg(F.count("*").alias("n"), F.sum(F.octet_length("value") + 1).cast("bigint").alias("bytes"))
    return sizes.join(done, "name").select("name", "status", "n", "bytes")


FILE_DOCS = 10_000


def grow(docs: DataFrame, folder: str, whole: bool, files: int = 16) -> None:
    """Write documents into text files, or the even half of them and the beginning of one more.

    There are at least ``files``, and more where a file would get more than about ``FILE_DOCS``, as a task sorts one.
    """

    def write(batches):
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        with system.open_output_stream(f"{base}/{TaskContext.get().partitionId():04d}.txt") as out:
            for row in (r for batch in batches for r in batch.to_dict("records")):
                if whole or not row["odd"]:
                    out.write(row["text"].encode() + b"\n")
                else:
                    out.write(row["text"].encode()[: len(row["text"]) // 2])
                    break
        yield pd.DataFrame({"done": [True]})

    rows = docs.select((F.col("doc_id") % 2 == 1).alias("odd"), "doc_id", "text")
    dealt = rows.repartition(max(files, docs.count() // FILE_DOCS), "doc_id").sortWithinPartitions("odd", "doc_id")
    dealt.mapInPandas(write, "done boolean").count()


@query(with_ctes(LINES) + "SELECT value FROM lines")
def poll_files(spark, sf_dir):
    """Three polls of files that grow between the first two, in the middle of a line."""
    landed, work = new_folder(spark, "growing"), new_folder(spark, "poll")
    docs = table(spark, sf_dir, "documents")
    tracked = LedgerTable(spark, new_folder(spark, "ledger"))
    polls = []
    for number, whole in enumerate([False, True, True]):
        grow(docs, landed, whole)
        polls.append(jobs.poll_files(spark, landed, work, tracked, "documents", number, at=instant()))
    return polls[0].unionByName(polls[1]).unionByName(polls[2]).select(F.explode("lines").alias("value"))


@query(with_ctes(LINES) + "SELECT value, 'run' AS status FROM lines")
def tail_files(spark, sf_dir):
    """The same files as a stream that reads what was appended: a line once, in a batch that is in ``run``."""
    landed, work, state = new_folder(spark, "growing"), new_folder(spark, "tail"), new_folder(spark, "stream")
    docs = table(spark, sf_dir, "documents")
    tracked = LedgerTable(spark, new_folder(spark, "ledger"))
    for whole in (False, True, True):
        grow(docs, landed, whole)
        jobs.tail_stream(
            spark, landed, work, tracked, "documents", state, at=instant(), every=None, split_bytes=1 << 16
        ).awaitTermination()
    ranges = files.tracked_ranges(tracked.state()).select("file", "start", "end", "status")
    batches = spark.read.parquet(f"{work}/lines/batch=*").join(ranges, ["file", "start", "end"])
    return batches.select(F.explode("lines").alias("value"), "status")


@query(with_ctes(MESSAGES, ROUTES) + """
SELECT coalesce(processor, 'none') AS processor, value FROM messages LEFT JOIN routes USING (topic) WHERE value IS NOT NULL
""")
def custom_processor(spark, sf_dir):
    """Two processors, each writing its own folder, and a folder for what no processor takes."""
    stream = topic_source.read_topic_files(spark, landed_topics(spark, sf_dir), RECORDS)
    out, work = new_folder(spark, "processed"), new_folder(spark, "stream")

    def into(name: str):
        return lambda share, batch: text.write_lines(share, f"{out}/processor={name}/batch={batch}", mode="overwrite")

    processors = {name: into(name) for name in ("alerts", "hourly")}
    known = routes(messages(spark, sf_dir))
    jobs.custom_processor(stream, known, processors, work, every=None, unrouted=into("none")).awaitTermination()
    return spark.read.schema("value string, processor string, batch string").text(out).select("processor", "value")
