"""Small files of closed hours put together, and the view of a tree of hours while that goes on.

An hourly stream leaves a few small files per topic, hour and micro-batch. Once the watermark has passed an
hour, its files are packed into bins of a target size. Files are joined byte by byte, which the text codecs
allow (plain lines, and gzip, bzip2 and zstd members one after the other), so no line is decoded or shuffled.

``<out>.compacted`` holds, by run: ``plan`` (which file goes to which bin), ``files`` (the bins) and ``done`` (the
bins that take the place of the planned files). A run counts from the moment its ``done`` is complete,
for all its hours at once; only then are the planned files deleted.
"""

from __future__ import annotations

import datetime
import functools
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.ids import plain_path
from millrace.operators.joins import lookup_join
from millrace.sinks.imports import delete_files, located
from millrace.sources.lines import glob_paths, list_files
from millrace.streaming.jobs import POLL, _for_each_batch, hourly_counts

TARGET_BYTES = 128 << 20
MAX_FILES = 10_000  # files of one bin
CHUNK_BYTES = 4 << 20
LOOK_BACK_HOURS = 48
TASK_BYTES = 128 << 20  # copied by one task, in as many bins as that takes
MAX_TASKS = 10_000

KEYS = ("topic", "dt", "hr")
LINES = "value string, topic string, dt string, hr string"
PLAN = "path string, size bigint, topic string, dt string, hr string, suffix string, bin bigint"
DONE = "path string, size bigint, topic string, dt string, hr string, suffix string"


def _part(name: str) -> Column:
    """The value of a partition folder as it is written in the path."""
    return F.regexp_extract("path", f"/{name}=([^/]+)/", 1)


def _runs(spark: SparkSession, out: str, kind: str) -> set[str]:
    found = glob_paths(spark, f"{out}.compacted/{kind}/run=*/_SUCCESS")
    return {path.rsplit("/run=", 1)[1].split("/")[0] for path in found}


def _tables(spark: SparkSession, out: str, kind: str, runs: set[str], schema: str) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{out}.compacted/{kind}/run={r}" for r in sorted(runs)])


def _batch_folders(spark: SparkSession, out: str) -> dict[int, str]:
    return {int(path.rsplit("/batch=", 1)[1]): path for path in glob_paths(spark, f"{out}/batch=*")}


def hour_files(spark: SparkSession, out: str, newest: bool = True, since: str = "") -> DataFrame:
    """``(path, size, topic, dt, hr, suffix, batch)`` of the files that hold the lines of a tree now.

    Bins of finished runs take the place of the files they were made of. Without ``newest`` the last batch is
    left out. ``batch`` is -1 in a bin. Hours before ``since`` (``yyyyMMddHH``) are left out.
    """
    folders = _batch_folders(spark, out)
    done = _runs(spark, out, "done")
    if not newest and folders:
        folders.pop(max(folders))
    files = _tables(spark, out, "done", done, DONE).withColumn("batch", F.lit(-1).cast("bigint"))
    if folders:
        listed = list_files(spark, list(folders.values()), "*.txt*", deep=True)
        suffix = F.regexp_extract("path", r"(\.txt[^/]*)$", 1).alias("suffix")
        batch = _part("batch").cast("bigint").alias("batch")
        files = files.unionByName(listed.select("path", "size", *[_part(k).alias(k) for k in KEYS], suffix, batch))
    replaced = _tables(spark, out, "plan", done, PLAN)
    files, replaced = (t.where(F.col("hr") >= since) for t in (files, replaced))
    return files.join(replaced.select(plain_path(F.col("path")).alias("_path")), plain_path(F.col("path")) == F.col("_path"), "left_anti")


def hour_lines(spark: SparkSession, out: str) -> DataFrame:
    """Lines ``(value, topic, dt, hr)`` of a tree of hours, each once whatever compaction has come to.

    What is deleted while this is read fails loudly, as elsewhere in Spark; ``compact_hours(delete=False)`` and a later
    :func:`delete_replaced` leave readers time.
    """
    deleted = _runs(spark, out, "deleted")  # in this order: a run that ends meanwhile is seen whole or not at all
    parts = []
    if _batch_folders(spark, out):
        parts.append(spark.read.schema(LINES).option("basePath", out).text(f"{out}/batch=*"))
    done = _runs(spark, out, "done")
    if done:
        bins = spark.read.schema(LINES).option("basePath", f"{out}.compacted/files")
        parts.append(bins.text([f"{out}.compacted/files/run={r}" for r in sorted(done)]))
    parts = [p for p in parts if len(p._jdf.inputFiles())]  # folders without files have no partition columns
    if not parts:
        return spark.createDataFrame([], LINES)
    located = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    lines = functools.reduce(DataFrame.unionByName, [p.select("value", *KEYS, plain_path(located).alias("_path")) for p in parts])
    left = _tables(spark, out, "plan", done - deleted, PLAN).select(plain_path(F.col("path")).alias("_path"))
    if done - deleted:
        lines = lookup_join(lines, left, ["_path"], "left_anti", ["value"])
    return lines.drop("_path")


def packed(files: DataFrame, target_bytes: int = TARGET_BYTES, max_files: int = MAX_FILES) -> DataFrame:
    """Files ``(path, size, topic, dt, hr, suffix, batch)`` with the bin they go to, for those that share one.

    A file of the target or more stays as it is. The others are cut, in order of batch and path, where the bytes
    before them pass a multiple of the target: an hour keeps at most ``ceil(bytes / target) + 1`` files of a kind,
    and one more per ``max_files``, which bound the list of one task. A bin has less than two targets.
    """
    kind = [*KEYS, "suffix"]
    small = files.where(F.col("size") < target_bytes)
    before = Window.partitionBy(*kind).orderBy("batch", "path").rowsBetween(Window.unboundedPreceding, -1)
    placed = small.withColumn("_bytes", F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn("_n", F.count("*").over(before))
    cut = [F.floor(F.col("_bytes") / target_bytes).alias("_b"), F.floor(F.col("_n") / max_files).alias("_f")]
    placed = placed.select("path", "size", *kind, "batch", *cut)
    numbered = placed.withColumn("bin", F.dense_rank().over(Window.partitionBy(*kind).orderBy("_b", "_f")).cast("bigint"))
    shared = F.count("*").over(Window.partitionBy(*kind, "bin"))
    return numbered.withColumn("_shared", shared).where("_shared > 1").drop("_shared", "_b", "_f")


def joined_files(plan: DataFrame, folder: str) -> DataFrame:
    """Write every bin of a plan below ``folder`` and give :data:`DONE` of them.

    A task streams the bytes of its bins, a few MB at a time. A bin is written under a hidden name of the attempt and then
    renamed, so an attempt that is lost leaves nothing to be read.
    """

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        attempt = TaskContext.get().taskAttemptId()
        for row in (r for batch in batches for r in batch.itertuples(index=False)):  # one row is one bin
            place = f"{folder}/topic={row.topic}/dt={row.dt}/hr={row.hr}"
            name = f"bin-{row.bin:05d}{row.suffix}"
            system, base = located(place)
            system.create_dir(base, recursive=True)
            hidden, written = f"{base}/_{name}-{attempt}", 0
            with system.open_output_stream(hidden, compression=None) as sink:
                for part in row.parts:
                    source, path = located(part["path"])
                    with source.open_input_stream(path, compression=None) as stream:
                        while data := stream.read(CHUNK_BYTES):
                            sink.write(data)
                            written += len(data)
            if written != row.size:
                raise OSError(f"{place}/{name}: {written} bytes instead of {row.size}")
            system.move(hidden, f"{base}/{name}")
            columns = [f"{place}/{name}", written, row.topic, row.dt, row.hr, row.suffix]
            yield pd.DataFrame([columns], columns=["path", "size", *KEYS, "suffix"])

    parts = F.sort_array(F.collect_list(F.struct("batch", "path"))).alias("parts")
    bins = plan.groupBy(*KEYS, "suffix", "bin").agg(F.sum("size").alias("size"), parts)
    total = plan.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()["size"]
    cores = plan.sparkSession.sparkContext.defaultParallelism
    tasks = min(MAX_TASKS, max(cores, total // TASK_BYTES + 1))
    return bins.repartition(tasks).mapInPandas(join, DONE)


def compact_hours(
    spark: SparkSession, out: str, run: str | int, before: str, since: str = "", target_bytes: int = TARGET_BYTES,
    newest: bool = False, delete: bool = True, max_files: int = MAX_FILES,
) -> None:
    """Pack the small files of the hours in ``since <= hr < before`` (``yyyyMMddHH``) of ``out/batch=/topic=/dt=/hr=``.

    The last batch is left alone unless ``newest``: the stream may still repeat and replace it. Bins of earlier
    runs take part again where late lines have come. A run that is repeated does only what it had not finished.
    Runs of one tree follow one another, each under its own name. Rows and the bytes of lines stay
    as they are; nothing to pack leaves nothing but an empty plan.
    """
    root = f"{out}.compacted"
    if str(run) not in _runs(spark, out, "done"):
        _remove(spark, f"{root}/files/run={run}")  # of an attempt that did not come to its end, which nobody reads
        chosen = hour_files(spark, out, newest, since).where(F.col("hr") < before)
        packed(chosen, target_bytes, max_files).write.mode("overwrite").parquet(f"{root}/plan/run={run}")
        plan = spark.read.schema(f"{PLAN}, batch bigint").parquet(f"{root}/plan/run={run}")
        _make_folder(spark, f"{root}/files/run={run}")
        joined_files(plan, f"{root}/files/run={run}").write.mode("overwrite").parquet(f"{root}/done/run={run}")
    if delete:
        delete_replaced(spark, out)


def delete_replaced(spark: SparkSession, out: str) -> None:
    """Delete the files that finished runs have replaced, and folders of batches that are empty then."""
    for run in sorted(_runs(spark, out, "done") - _runs(spark, out, "deleted")):
        plan = spark.read.schema(f"{PLAN}, batch bigint").parquet(f"{out}.compacted/plan/run={run}")
        gone = delete_files(plan.select("path"))
        gone.groupBy("deleted").count().write.mode("overwrite").parquet(f"{out}.compacted/deleted/run={run}")
        folders = _batch_folders(spark, out)
        last = max(folders, default=-1)
        for number in (r["batch"] for r in plan.where("batch >= 0").select("batch").distinct().collect()):
            if number != last and number in folders and not _has_files(spark, folders[number]):
                _remove(spark, folders[number])


def compaction_stream(
    lines: DataFrame, out: str, checkpoint: str, ts: str = "ts", late: str = "10 minutes",
    look_back: int = LOOK_BACK_HOURS, every: str | None = POLL, **options,
) -> StreamingQuery:
    """Compact hours as the watermark of ``lines`` passes them.

    ``lines`` are those the hourly stream writes, with their time ``ts``. An hour is closed ``late`` after its end.
    Each time hours close, all closed hours of the last ``look_back`` are looked at, so files that were written
    after their hour had closed are packed too. Options go to :func:`compact_hours`.
    """

    def compact(closed: DataFrame, batch_id: int) -> None:
        end = closed.agg(F.max("hour").alias("hour")).select(F.unix_seconds("hour").alias("s")).first()["s"]
        if end is None:
            return
        last = datetime.datetime.fromtimestamp(end, datetime.timezone.utc)
        before, since = (f"{last + datetime.timedelta(hours=h):%Y%m%d%H}" for h in (1, 1 - look_back))
        compact_hours(closed.sparkSession, out, batch_id, before, since, **options)

    return _for_each_batch(hourly_counts(lines, ts, late), compact, checkpoint, every)


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _remove(spark: SparkSession, path: str) -> None:
    system, place = _hadoop(spark, path)
    system.delete(place, True)


def _make_folder(spark: SparkSession, path: str) -> None:
    system, place = _hadoop(spark, path)
    system.mkdirs(place)


def _has_files(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds a file of lines; markers and checksums do not count."""
    system, place = _hadoop(spark, folder)
    found = system.listFiles(place, True)
    while found.hasNext():
        if not found.next().getPath().getName().startswith(("_", ".")):
            return True
    return False
