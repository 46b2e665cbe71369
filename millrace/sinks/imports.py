"""Put landed files under the dated tree and mark them done."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.ids import plain_path, split_dsid
from millrace.functions.timekeys import (
    DirFormat,
    NameParser,
    parse_file_name,
    partition_dir,
    remote_path,
)
from millrace.operators.joins import lookup_join
from millrace.operators.ledger import DONE, LedgerTable
from millrace.sources.lines import glob_paths, list_files, read_lines

# Fixed value: where imported files go unless told otherwise.
BASE_DIR = "/log/raw"
MAX_FILES = 10_000  # files imported at a time, whose names the driver hands to the reader
MAX_FOLDERS = 1000
MAX_KINDS = 100  # of directories with different keys


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def import_manifest(
    units: DataFrame,
    host: str,
    base: str = BASE_DIR,
    file_model: int = 1,
    dir_model: int = 1,
    file_models: Mapping[int, NameParser] | None = None,
    dir_models: Mapping[int, DirFormat] | None = None,
    name_of: Callable[[Column], Column] = file_name,
) -> DataFrame:
    """Units ``(ds, id)``, the id being a local path, with their place in the dated tree."""
    name = name_of(F.col("id"))
    named = units.select("ds", "id", name.alias("name"), parse_file_name(name, file_model, file_models).alias("_n"))
    directory = partition_dir(F.col("_n.date_hour"), dir_model, dir_models)
    return named.select(
        "ds",
        "id",
        "name",
        F.col("_n.type").alias("type"),
        directory.alias("dir"),
        F.col("_n.date_hour").alias("date_hour"),
        remote_path(F.lit(base), F.col("_n.type"), directory, F.lit(host), F.col("name")).alias("remote"),
        F.concat_ws("-", F.lit(host), F.col("name")).alias("src"),
    )


def readable() -> Column:
    """Whether a row of a manifest has a place: its name gave a type and a date, and its directory is
    of ``key=value`` parts. A unit without one is not imported, not marked and not deleted."""
    parts = F.split("dir", "/")
    return F.col("type").isNotNull() & F.coalesce(F.forall(parts, lambda p: p.contains("=")), F.lit(False))


def import_lines(lines: DataFrame, manifest: DataFrame, out: str, codec: str = "gzip") -> None:
    """Write lines ``(id, value)`` of landed files below ``out/type=/<directory>/src=host-name``.

    Each task writes the files it reads, nothing moves; Spark's committer shows no half-written
    file, and writing again replaces what was there. The directory is that of each file in the manifest: its
    ``key=value`` parts become partitions. Files whose directories have other keys (a model may
    make them of the type) are written one kind of directory after the other.
    """
    named = manifest.where(readable()).select(plain_path(F.col("id")).alias("id"), "type", "dir", "src")
    read = lines.select(plain_path(F.col("id")).alias("id"), "value")
    found = lookup_join(read, named, ["id"], "inner", ["value"])
    keys_of = F.transform(F.split("dir", "/"), lambda p: F.substring_index(p, "=", 1))
    kinds = [r["k"] for r in named.select(keys_of.alias("k")).distinct().orderBy("k").limit(MAX_KINDS + 1).collect()]
    if len(kinds) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} kinds of directories")
    for number, keys in enumerate(kinds):
        parts = F.str_to_map("dir", F.lit("/"), F.lit("="))
        mine = found.where(keys_of == F.array(*map(F.lit, keys)))
        placed = mine.select("value", "type", *[parts[k].alias(k) for k in keys], "src")
        writer = placed.write.mode("append" if number else "overwrite").partitionBy("type", *keys, "src")
        writer.option("compression", codec).text(out)


def import_files(
    spark: SparkSession,
    units: DataFrame,
    out: str,
    ledger: LedgerTable,
    batch: str,
    host: str,
    at: Column,
    landed: str | None = None,
    delete: bool = False,
    max_files: int = MAX_FILES,
    quarantine: str | None = None,
    **models,
) -> None:
    """Copy the files that are units below ``out/batch=``, mark the units done, and then delete
    the files if asked to. Only the files of units are read.

    One call imports all of them, ``max_files`` at a time by id: each portion is written to a folder of its own
    (``batch=<batch>``, the ones before the last ``batch=<batch>-<number>``) and marked done before the next is begun. A
    repeated batch does only what is left. A unit whose file is gone counts as done, unless
    ``landed`` is given: then the units are those whose file is in that folder, and the others wait.

    A unit whose name the file model cannot place stays in ``run`` and its file where it is; it is listed in
    ``quarantine/batch=`` (default: ``out`` with ``.quarantine`` after it). ``models`` go to :func:`import_manifest`.
    """
    name = f"done-{batch}"
    if not ledger.has(name):
        earlier = 0
        while ledger.has(f"{name}-{earlier}"):
            marked = split_dsid(F.col("dsid"))
            known = ledger.batch(f"{name}-{earlier}").select(marked["ds"].alias("ds"), marked["id"].alias("id"))
            units = units.join(known, ["ds", "id"], "left_anti")
            earlier += 1
        places = landed or _folders(units)
        listed = list_files(spark, places).select("path") if places else spark.createDataFrame([], "path string")
        there = listed.select(plain_path(F.col("path")).alias("_path")).distinct()
        here = units.join(there, plain_path(F.col("id")) == F.col("_path"), "left_semi")
        gone = units.join(here.select("id"), "id", "left_anti").select("ds", "id")
        manifest = import_manifest(here, host, **models).persist()  # the listing is gone through once, not once per portion
        try:
            unplaced = manifest.where(~F.coalesce(readable(), F.lit(False)))
            if unplaced.head(1):
                letters = quarantine or f"{out.rstrip('/')}.quarantine"
                unplaced.select("ds", "id", "name").write.mode("overwrite").parquet(f"{letters}/batch={batch}")
            ready, last = manifest.where(readable()).select("ds", "id"), None
            while True:
                rest = ready if last is None else ready.where(F.col("id") > last)
                chosen = rest.orderBy("id").limit(max_files).collect()
                more = len(chosen) == max_files and bool(rest.where(F.col("id") > chosen[-1]["id"]).head(1))
                part = f"{batch}-{earlier}" if more else batch
                taken = spark.createDataFrame(chosen, "ds string, id string")
                if chosen:
                    last = chosen[-1]["id"]
                    lines = read_lines(spark, sorted({r["id"] for r in chosen}))
                    lines = lines.select(F.col("_metadata.file_path").alias("id"), "value")
                    import_lines(lines, import_manifest(taken, host, **models), f"{out}/batch={part}")
                ledger.mark_done(taken if landed or more else taken.unionByName(gone), at, f"done-{part}")
                earlier += 1
                if not more:
                    break
        finally:
            manifest.unpersist()
    if delete:
        done = split_dsid(F.col("dsid"))["id"].alias("path")
        parts, number = [name], 0
        while ledger.has(f"{name}-{number}"):
            parts.append(f"{name}-{number}")
            number += 1
        for part in parts:
            delete_files(ledger.batch(part).where(F.col("status") == DONE).select(done)).count()


def _folders(units: DataFrame) -> list[str]:
    """The folders that the files of units are in."""
    folders = units.select(F.regexp_replace("id", "/[^/]*$", "").alias("f")).distinct().limit(MAX_FOLDERS + 1).collect()
    if len(folders) > MAX_FOLDERS:
        raise ValueError(f"units in more than {MAX_FOLDERS} folders: say where they landed")
    return [f for r in folders for f in glob_paths(units.sparkSession, r["f"])]


def missing_units(spark: SparkSession, landed: str, units: DataFrame) -> DataFrame:
    """Units whose file is not there (any more)."""
    there = list_files(spark, landed).select(plain_path(F.col("path")).alias("_path"))
    return units.join(there, plain_path(F.col("id")) == F.col("_path"), "left_anti")


def located(path: str) -> tuple:
    """The Arrow file system and name of a path as Spark lists it. That is no URI: it may hold a ``%``."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(quote(path, safe="/:=") if re.match(r"[A-Za-z][\w+.-]*:", path) else path)


def delete_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """Delete files from the tasks: ``(path, deleted)``. A file already gone counts as deleted."""

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileType

        for batch in batches:
            gone = []
            for listed in batch["path"]:
                files, name = located(listed)
                if files.get_file_info(name).type != FileType.NotFound:
                    files.delete_file(name)
                gone.append(True)
            yield pd.DataFrame({"path": batch["path"], "deleted": gone})

    return paths.select(F.col(path).alias("path")).mapInPandas(remove, "path string, deleted boolean")
