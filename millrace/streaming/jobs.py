"""Streams: hourly files, rolled files, polling, uploads, processors.

Every ``foreachBatch`` job names its output after the batch id and replaces it when the batch
is run again, and writes the ledger last: a job that is stopped anywhere and started again
leaves each unit once.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from millrace.functions.ids import plain_path
from millrace.operators.files import (
    batch_lines,
    file_progress,
    line_offsets,
    not_done_files,
    range_units,
    read_new_lines,
    read_ranges,
    sent_size,
    tracked_ranges,
)
from millrace.operators.ledger import RUN, LedgerTable, deserialized
from millrace.operators.processing import (
    dead_letter,
    decode_messages,
    drop_null_payload,
    key_and_encode,
    with_settings,
)
from millrace.operators.routing import dispatch, route_all
from millrace.sinks.imports import import_files
from millrace.sinks.text import write_hourly
from millrace.sources.lines import glob_paths, list_files, read_placed_lines
from millrace.sources.tail import tail_lines

POLL = "10 seconds"


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run at an interval, or with None once through all that is there."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def hourly_counts(lines: DataFrame, ts: str = "ts", late: str | None = None) -> DataFrame:
    """Rows per topic and hour. On a stream ``late`` lets the state of old hours go."""
    if late:
        lines = lines.withWatermark(ts, late)
    return (
        lines.groupBy("topic", F.window(ts, "1 hour").alias("_hour"))
        .agg(F.count("*").alias("n"))
        .select("topic", F.col("_hour.start").alias("hour"), "n")
    )


def throughput_stream(
    lines: DataFrame, checkpoint: str, out: str | None = None,
    width: str = "1 minute", late: str = "1 minute", every: str | None = POLL,
) -> StreamingQuery:
    """Messages and bytes per second by topic and in ``total`` (``whole``), to CSV files or to the console.

    A window is reported once the watermark has passed it.
    """
    written = lines.where(F.col("line").isNotNull()).withWatermark("ts", late)
    one, whole = (F.struct(l.alias("topic"), F.lit(w).alias("whole")) for l, w in ((F.col("topic"), False), (F.lit("total"), True)))
    counts = (
        written.select("ts", F.octet_length("line").alias("size"), F.explode(F.array(one, whole)).alias("_of"))
        .select("ts", "size", "_of.*")
        .groupBy(F.window("ts", width).alias("_w"), "topic", "whole")
        .agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    )
    seconds = F.unix_seconds("_w.end") - F.unix_seconds("_w.start")
    rates = counts.select(
        "topic", "whole", F.unix_millis("_w.start").alias("window_ms"), "n", "bytes",
        (F.col("n") / seconds).alias("n_per_sec"), (F.col("bytes") / seconds).alias("bytes_per_sec"),
    )
    writer = rates.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if out is None:
        return triggered(writer.format("console"), every).start()
    return triggered(writer.format("csv").option("path", out).option("header", True), every).start()


def hourly_stream(
    messages: DataFrame, resolved: DataFrame, out: str, checkpoint: str, **options
) -> StreamingQuery:
    """Decode, key and write an endless stream into hour folders, with fixed settings.

    A late record goes to its own, older hour. Options and output as in :func:`refresh_settings`.
    """
    return refresh_settings(messages, lambda session: resolved, out, checkpoint, **options)


def rolled_files(
    lines: DataFrame, out: str, ledger: LedgerTable, ds: str, checkpoint: str,
    at: Column | None = None, every: str | None = POLL, salts: int = 8,
) -> StreamingQuery:
    """Write each micro-batch as closed hour files and track every file in ``run``.

    A repeated batch whose files are tracked already is left as it is, as they may be imported by now. Files that
    go on over micro-batches until they have a size: :mod:`millrace.streaming.rolls`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if ledger.has(f"run-{batch_id}"):
            return
        folder = f"{out}/batch={batch_id}"
        write_hourly(batch, folder, mode="overwrite", salt="offset", salts=salts)
        if not glob_paths(batch.sparkSession, f"{folder}/topic=*"):
            return
        written = list_files(batch.sparkSession, f"{folder}/topic=*/dt=*/hr=*", "*.txt*")
        units = written.select(F.lit(ds).alias("ds"), F.col("path").alias("id"))
        ledger.mark_run(units, F.current_timestamp() if at is None else at, f"run-{batch_id}")

    return _for_each_batch(lines, write, checkpoint, every)


def _for_each_batch(
    rows: DataFrame, job: Callable[[DataFrame, int], None], checkpoint: str, every: str | None
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def refresh_settings(
    messages: DataFrame, load: Callable[[SparkSession], DataFrame], out: str, checkpoint: str,
    now_ms: Column | None = None, every: str | None = POLL, salts: int = 8, dead: str | None = None,
) -> StreamingQuery:
    """The hourly stream with the settings read again for every batch: ``out/batch=/topic=/dt=/hr=``.

    The lines of an hour meet in at most ``salts`` files per batch, so neither every task writes
    every hour nor one task a whole hour. Messages that could not be decoded go as they came to
    ``dead/batch=`` (default: ``out`` with ``.dead`` after it). A batch is decoded once.
    """
    letters = dead or f"{out.rstrip('/')}.dead"

    def write(batch: DataFrame, batch_id: int) -> None:
        now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
        decoded = decode_messages(with_settings(batch, load(batch.sparkSession))).persist()
        try:
            lines = key_and_encode(drop_null_payload(decoded), now)
            write_hourly(lines, f"{out}/batch={batch_id}", mode="overwrite", salt="offset", salts=salts)
            lost = dead_letter(decoded).select(*batch.columns)
            lost.write.mode("overwrite").parquet(f"{letters}/batch={batch_id}")
        finally:
            decoded.unpersist()

    return _for_each_batch(messages, write, checkpoint, every)


def custom_processor(
    messages: DataFrame, routes: DataFrame, processors: Mapping[str, Callable[[DataFrame, int], None]],
    checkpoint: str, every: str | None = POLL, spread: Sequence[str] = ("partition", "offset"),
    unrouted: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Hand the messages of each batch to the processor of their topic, with the batch id.

    Messages whose topic has no route, or whose route names no processor of these, go to
    ``unrouted``; without one the job stops at the first of them. A batch is routed once.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        def bound(job: Callable[[DataFrame, int], None]) -> Callable[[DataFrame], None]:
            return lambda share: job(share, batch_id)

        routed = route_all(batch, routes, spread).persist()
        try:
            other = routed.where(~F.coalesce(F.col("processor").isin(list(processors)), F.lit(False)))
            if unrouted:
                unrouted(other, batch_id)
            elif found := other.select("topic", "processor").first():
                raise LookupError(f"no processor {found['processor']!r} for topic {found['topic']!r}")
            dispatch(routed, {name: bound(job) for name, job in processors.items()})
        finally:
            routed.unpersist()

    return _for_each_batch(messages, process, checkpoint, every)


def upload_stream(
    spark: SparkSession, landed: str, out: str, ledger: LedgerTable, ds: str, host: str, checkpoint: str,
    delete: bool = False, at: Column | None = None, every: str | None = POLL, **options,
) -> StreamingQuery:
    """Import landed files that the ledger has in ``run``, at every tick.

    The ledger is the list of what is to be done: a file that is there before its unit, or a unit
    before its file, is imported by the tick that first finds both. Files are deleted only after
    their units are done. A failed batch is repeated as a whole and replaces what it had written.
    Options go to :func:`import_files`.
    """
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()

    def upload(batch: DataFrame, batch_id: int) -> None:
        running = ledger.state(f"done-{batch_id}", ds).where(F.col("status") == RUN)
        units = deserialized(running).select("ds", F.col("ids").alias("id"))
        moment = F.current_timestamp() if at is None else at
        import_files(spark, units, out, ledger, str(batch_id), host, moment, landed=landed, delete=delete, **options)

    writer = ticks.writeStream.foreachBatch(upload).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(once=True)).start()


def tail_stream(
    spark: SparkSession, landed: str, work: str, ledger: LedgerTable, ns: str, checkpoint: str,
    batch_size: int = 50, at: Column | None = None, every: str | None = POLL, **options,
) -> StreamingQuery:
    """Whole lines as they are appended to the files of a folder, in batches tracked in ``run``.

    As :func:`poll_files`, but the positions are the stream's own and only appended bytes are read, whatever the
    size of the files. Batches ``(file, start, end, n, lines)`` of one range each are in ``<work>/lines/batch=``; they
    are written, then tracked. Options go to :func:`millrace.sources.tail.tail_lines`.
    """

    def track(lines: DataFrame, batch_id: int) -> None:
        name = f"tail-{batch_id}"
        if ledger.has(name):
            return
        numbered = lines.select(
            plain_path(F.col("file")).alias("path"), "range_start", F.col("seq").alias("line_no"), "start", "end", "value"
        )
        # a range counts its own lines, so that a batch needs no other range
        keyed = numbered.select(F.concat_ws("\x01", "path", "range_start").alias("file"), "line_no", "start", "end", "value")
        batches = batch_lines(keyed, batch_size).withColumn("file", F.split_part("file", F.lit("\x01"), F.lit(1)))
        folder = f"{work}/lines/batch={batch_id}"
        batches.drop("batch").write.mode("overwrite").parquet(folder)
        written = lines.sparkSession.read.schema("file string, start bigint, end bigint").parquet(folder)
        ledger.mark_run(range_units(written, ns), F.current_timestamp() if at is None else at, name)

    return _for_each_batch(tail_lines(spark, landed, **options), track, checkpoint, every)


def poll_files(
    spark: SparkSession, landed: str, work: str, ledger: LedgerTable, ns: str, batch: int,
    batch_size: int = 50, at: Column | None = None, closed: bool = False, recover: bool = False,
) -> DataFrame:
    """One poll of a directory of growing files: the new whole lines in batches.

    Only files that are longer than their position are read. A last line without newline stays
    for a later poll, unless the files are ``closed``. With ``recover`` (at a start) the ranges that
    earlier polls left in ``run`` come first, read again from their files; files of such ranges
    are read too. The batches are written, then tracked in ``run``, and only then do the positions
    move. Give the same number to a poll that is repeated and the next number to the next poll;
    a poll reads the positions the one before has left.
    """
    schema = "ns string, file string, delta bigint"
    positions = spark.createDataFrame([], schema)
    if batch:
        positions = spark.read.schema(schema).parquet(f"{work}/positions/batch={batch - 1}")
    positions = positions.where(F.col("ns") == ns)
    here = list_files(spark, landed).select(F.lit(ns).alias("ns"), plain_path(F.col("path")).alias("file"), "size", "path")
    known = sent_size(positions).withColumn("file", plain_path(F.col("file")))
    unread = not_done_files(file_progress(here, known)).select("path")
    folder = f"{work}/lines/batch={batch}"
    parts = []
    if paths := [r["path"] for r in unread.collect()]:
        lines = read_placed_lines(spark, paths)
        parts.append(batch_lines(read_new_lines(lines, sent_size(positions), closed), batch_size).withColumn("again", F.lit(False)))
    if recover:
        state = ledger.state(f"poll-{batch}", ns)
        open_ranges = tracked_ranges(state).where(F.col("status") == RUN).select("file", "start", "end")
        left = open_ranges.select(plain_path(F.col("file")).alias("file")).distinct()
        if paths := [r["path"] for r in here.join(left, "file", "left_semi").select("path").collect()]:
            found = read_ranges(line_offsets(read_placed_lines(spark, paths)), open_ranges)
            of_range = found.withColumn("file", F.concat_ws("\x01", "file", "range_start", "range_end"))
            first = F.min("line_no").over(Window.partitionBy("file"))
            old = batch_lines(of_range.withColumn("line_no", F.col("line_no") - first), batch_size)
            parts.append(old.withColumn("file", F.split("file", "\x01")[0]).withColumn("again", F.lit(True)))
    empty = "file string, batch bigint, start bigint, end bigint, n bigint, lines array<string>, again boolean"
    batches = functools.reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], empty)
    batches.write.mode("overwrite").parquet(folder)
    written = spark.read.parquet(folder)
    new = written.where("not again")
    ledger.mark_run(range_units(new, ns), F.current_timestamp() if at is None else at, f"poll-{batch}")
    read = new.select(F.lit(ns).alias("ns"), "file", (F.col("end") - F.col("start")).alias("delta"))
    moved = sent_size(positions.unionByName(read)).withColumnRenamed("sent_size", "delta")
    moved.write.mode("overwrite").parquet(f"{work}/positions/batch={batch}")
    return written
