"""Text files as lines, with where in the file they were read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.ids import plain_path


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line as ``value``; a carriage return stays part of its line."""
    return spark.read.option("lineSep", "\n").text(path)


def read_placed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines as ``(file, file_size, block, seq, bytes, value)`` for ``line_offsets``.

    ``block`` is the byte the reading task's part of the file starts at and ``seq`` rises inside
    it, so large files are read in parts. For plain text: a compressed file has no byte
    positions of its lines.
    """
    return read_lines(spark, path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        (F.octet_length("value") + 1).cast("bigint").alias("bytes"),
        "value",
    )


def list_files(
    spark: SparkSession, path: str | list[str], pattern: str | None = None, deep: bool = False
) -> DataFrame:
    """``(path, size, mtime)`` of the files in directories or of globs, with ``deep`` in all folders below;
    their content is not read.

    Spark lists the folders, in parallel where there are many. Its reader passes over empty files, so those of the
    listing that it has not read are added: only they are looked up one by one.
    """
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if deep:
        reader = reader.option("recursiveFileLookup", True)
    read = reader.load(path)
    found = read.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    jvm = spark._jvm
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(read._jdf.inputFiles())  # stays in the JVM
    listed = DataFrame(spark._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING()).toDF(), spark)
    names_read = found.select(plain_path(F.col("path")).alias("value"))
    decoded = F.url_decode(F.replace("value", F.lit("+"), F.lit("%2B")))
    passed_over = listed.select(plain_path(decoded).alias("value")).join(names_read, "value", "left_anti")
    empty = [_status(spark, row["value"]) for row in passed_over.collect()]
    if not empty:
        return found
    rows = spark.createDataFrame(empty, "path string, mtime_ms bigint")
    zero = rows.select("path", F.lit(0).cast("bigint").alias("size"), F.timestamp_millis("mtime_ms").alias("mtime"))
    return found.unionByName(zero)


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """What a glob finds; nothing where it finds nothing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    return [status.getPath().toString() for status in found]


def _status(spark: SparkSession, path: str) -> tuple[str, int]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
    return status.getPath().toString(), status.getModificationTime()
