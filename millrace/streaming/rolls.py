"""Files of a topic and hour that go on over micro-batches and are closed by size or by idle time.

A first stream writes the lines of each micro-batch as segments, pieces of files, and a manifest with
one row per segment. A second one keeps the open file of every topic and hour in Spark's state store,
with a timer. Lines never pass through the state: a key costs a few numbers per micro-batch.
Only closed files are put together, named and tracked in the ledger.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.operators.joins import lookup_join
from millrace.operators.ledger import LedgerTable
from millrace.operators.rolls import IDLE_MS, ROLL_BYTES, line_bytes, size_rolls
from millrace.sinks.imports import delete_files
from millrace.sinks.text import hourly
from millrace.sources.lines import glob_paths, list_files
from millrace.streaming.jobs import POLL, _for_each_batch

SEGMENT = "topic string, dt string, hr string, first bigint, seg bigint, n bigint, bytes bigint, at timestamp"
KEYS = ("topic", "dt", "hr")
# Segments of a batch are this much smaller than a roll, so that a file exceeds its size by less.
SEGMENTS_PER_ROLL = 8
# Consecutive segments of a key share a file of up to about this size, so small rolls do not cost a file each.
FILE_BYTES = 16 << 20
TASK_BYTES = 32 << 20  # written by one task, in as many files as that takes

ROLL = "topic string, dt string, hr string, name string, n bigint, bytes bigint, reason string, segments string"
OPEN = "name string, n bigint, bytes bigint, last_ms bigint, segments string"


def write_segments(
    lines: DataFrame, work: str, checkpoint: str, roll_bytes: int = ROLL_BYTES,
    clock: Callable[[int], datetime.datetime] | None = None, every: str | None = POLL,
) -> StreamingQuery:
    """Write lines ``(topic, partition, offset, ts_ms, line)`` as segments and their manifest.

    ``<work>/segments/batch=/topic=/dt=/hr=/first=`` holds the lines in order of partition and offset, each after the
    number of its segment and a tab; ``first`` is the first segment of the file. ``<work>/manifest/batch=`` has
    a row per segment with the moment it was written (``clock`` gives it for a batch
    id; default: now) and one row without topic, by which time passes for all. The manifest comes last: a repeated
    batch that has one is left as it is. Moments rise strictly from batch to batch, whatever the clock does.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        manifest = f"{work}/manifest/batch={batch_id}"
        if glob_paths(spark, f"{manifest}/_SUCCESS"):
            return
        rows = hourly(batch, "partition", "offset")
        segment = max(1, roll_bytes // SEGMENTS_PER_ROLL)
        placed = size_rolls(rows, KEYS, "offset", "value", segment).withColumnRenamed("roll", "seg")
        first = F.col("seg") - F.pmod("seg", F.lit(max(1, FILE_BYTES // segment)))
        placed = placed.withColumn("first", first).persist()
        try:
            sizes = placed.groupBy(*KEYS, "first", "seg").agg(F.count("*").alias("n"), F.sum(line_bytes(F.col("value"))).alias("bytes"))
            written = sizes.groupBy(*KEYS, "first").agg(F.sum("bytes").alias("bytes"))
            dealt = placed.repartition(_tasks(written), *KEYS, "first").sortWithinPartitions(*KEYS, "first", "seg", "partition", "offset")
            mark = F.concat(F.col("seg").cast("string"), F.lit("\t"))
            marked = F.concat(mark, F.replace("value", F.lit("\n"), F.concat(F.lit("\n"), mark))).alias("value")
            writer = dealt.select(*KEYS, "first", marked).write.mode("overwrite").partitionBy(*KEYS, "first")
            writer.option("compression", "gzip").text(f"{work}/segments/batch={batch_id}")
            moment = _moment(spark, work, batch_id, clock)
            at = F.lit(moment).cast("timestamp").alias("at")
            tick = spark.range(1).selectExpr(
                *[f"CAST(NULL AS STRING) AS {k}" for k in KEYS], "0L AS first", "0L AS seg", "0L AS n", "0L AS bytes"
            )
            sizes.unionByName(tick).select("*", at).coalesce(8).write.mode("overwrite").parquet(manifest)
        finally:
            placed.unpersist()

    return _for_each_batch(lines, write, checkpoint, every)


def _tasks(files: DataFrame) -> int:
    """How many tasks write files of known ``bytes``. By bytes alone a few tasks would write very many small files."""
    found = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    return max(1, min(found["n"], max(4 * cores, found["bytes"] // TASK_BYTES + 1)))


def _moment(spark: SparkSession, work: str, batch_id: int, clock) -> datetime.datetime:
    now = clock(batch_id) if clock else datetime.datetime.now(datetime.timezone.utc)
    before = f"{work}/manifest/batch={batch_id - 1}"
    if glob_paths(spark, f"{before}/_SUCCESS"):
        last = spark.read.schema(SEGMENT).parquet(before).agg(F.unix_millis(F.max("at")).alias("ms")).first()["ms"]
        now = max(now, datetime.datetime.fromtimestamp((last + 1) / 1000, datetime.timezone.utc))
    return now


def closing(roll_bytes: int, idle_ms: int):
    """The state function: open files of one key, segment by segment."""

    def close(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[0] is None:
            return
        names = [part.split()[0] for part in OPEN.split(", ")]
        held = dict(zip(names, state.get)) if state.exists else None
        closed: list[dict] = []

        def shut(reason: str) -> None:
            closed.append({**dict(zip(KEYS, key)), **{k: held[k] for k in names if k != "last_ms"}, "reason": reason})

        if state.hasTimedOut:
            shut("idle")
            state.remove()
        else:
            rows = sorted(r for f in frames for r in f[["batch", "seg", "n", "bytes", "at_ms"]].itertuples(index=False, name=None))
            for batch, seg, n, size, at_ms in rows:
                if held and at_ms - held["last_ms"] >= idle_ms:
                    shut("idle")
                    held = None
                place = f"{batch}-{seg}"
                held = held or {"name": place, "n": 0, "bytes": 0, "segments": ""}
                segments = f"{held['segments']} {place}".strip()
                held |= {"n": held["n"] + int(n), "bytes": held["bytes"] + int(size), "last_ms": int(at_ms), "segments": segments}
                if held["bytes"] >= roll_bytes:
                    shut("size")
                    held = None
            if held:
                state.update(tuple(held[k] for k in names))
                state.setTimeoutTimestamp(held["last_ms"] + idle_ms - 1)  # fires once time is past it
            elif state.exists:
                state.remove()
        if closed:
            yield pd.DataFrame(closed)[[part.split()[0] for part in ROLL.split(", ")]]

    return close


def rolled_name() -> Column:
    """``topic_<first batch>-<first segment>_hr_<yyyyMMddHH>``, which file model 1 takes apart."""
    return F.concat_ws("_", "topic", "name", F.lit("hr"), "hr")


def folder_name(path: Column) -> Column:
    """The name of a file whose lines are in one folder ``name=<file name>``."""
    return F.regexp_extract(path, r"name=([^/]+)/", 1)


def close_rolls(
    spark: SparkSession, work: str, out: str, ledger: LedgerTable, ds: str, checkpoint: str,
    roll_bytes: int = ROLL_BYTES, idle_ms: int = IDLE_MS, at: Column | None = None,
    every: str | None = POLL, ticks: DataFrame | None = None,
) -> StreamingQuery:
    """Close the files of :func:`write_segments` and track each in ``run``.

    A file is closed as soon as it has ``roll_bytes``, or once ``idle_ms`` have passed since its last segment,
    whichever is first. Time is that of the manifest; ``ticks``, a stream with a column ``at``, makes
    it pass where no topic has lines. The lines of a closed file are written in order to
    ``out/batch=/name=<name>/``, where ``name`` begins with the batch and number of its first segment and so does
    not depend on when it was closed. Then the ledger has it in ``run``, and segment files are deleted whose last
    segment was closed: those of a key are closed in their order.
    """
    schema = f"{SEGMENT}, batch bigint"
    segments = spark.readStream.schema(schema).parquet(f"{work}/manifest")
    if ticks is not None:
        segments = segments.unionByName(ticks.select("at"), allowMissingColumns=True)
    timed = segments.withColumn("at_ms", F.unix_millis("at")).withWatermark("at", "0 seconds")
    rolls = timed.groupBy(*KEYS).applyInPandasWithState(
        closing(roll_bytes, idle_ms), ROLL, OPEN, "append", GroupStateTimeout.EventTimeTimeout
    )

    def finish(closed: DataFrame, batch_id: int) -> None:
        session, name = closed.sparkSession, f"run-{batch_id}"
        closed = closed.persist()
        try:
            closed.count()  # the state moves on once per batch, also where a repeated batch has nothing to do
            if ledger.has(name):
                return
            parts = closed.select(*KEYS, rolled_name().alias("name"), F.explode(F.split("segments", " ")).alias("p"))
            batch, seg = (F.split_part("p", F.lit("-"), F.lit(k)) for k in (1, 2))
            parts = parts.select(*KEYS, "name", batch.alias("batch"), seg.alias("seg"))
            numbers = [r["batch"] for r in parts.select("batch").distinct().collect()]
            if not numbers:
                return
            folder = f"{out}/batch={batch_id}"
            tree = "value string, batch string, topic string, dt string, hr string, first string"
            held = session.read.schema(tree).option("basePath", f"{work}/segments").option("lineSep", "\n")
            lines = held.text([f"{work}/segments/batch={n}" for n in numbers])
            seq = F.monotonically_increasing_id().alias("seq")  # a compressed file is read in order
            own = F.substring_index("value", "\t", 1).alias("seg"), F.substr("value", F.instr("value", "\t") + 1).alias("value")
            lines = lines.select(*KEYS, "batch", *own, seq)
            found = lookup_join(lines, parts, [*KEYS, "batch", "seg"], "inner")  # no more lines of a key than a segment has
            order = [F.col("batch").cast("bigint"), F.col("seg").cast("bigint"), F.col("seq")]
            dealt = found.repartition(_tasks(closed), "name").sortWithinPartitions("name", *order).select("name", "value")
            dealt.write.mode("overwrite").partitionBy("name").option("compression", "gzip").text(folder)
            written = list_files(session, folder, "*.txt*", deep=True)
            units = written.select(F.lit(ds).alias("ds"), F.col("path").alias("id"))
            ledger.mark_run(units, F.current_timestamp() if at is None else at, name)
            manifest = session.read.schema(schema).option("basePath", f"{work}/manifest")
            ends = manifest.parquet(*[f"{work}/manifest/batch={n}" for n in numbers]).groupBy(*KEYS, "batch", "first").agg(F.max("seg").alias("seg"))
            ends = ends.select(*KEYS, *[F.col(c).cast("string").alias(c) for c in ("batch", "first", "seg")])
            over = ends.join(parts, [*KEYS, "batch", "seg"], "left_semi")
            used = list_files(session, [f"{work}/segments/batch={n}" for n in numbers], "*.txt*", deep=True)
            key = [F.regexp_extract("path", f"/{c}=([^/]+)/", 1).alias(c) for c in (*KEYS, "batch", "first")]
            delete_files(used.select("path", *key).join(over, [*KEYS, "batch", "first"], "left_semi")).count()
        finally:
            closed.unpersist()

    return _for_each_batch(rolls, finish, checkpoint, every)
