"""Unit ids (parts joined by U+0001), file range ids and slash paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEPARATOR = "\u0001"


def join_parts(*parts: Column) -> Column:
    return F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def split_parts(text: Column) -> Column:
    """Parts of an id; empty parts are left out."""
    return F.filter(F.split(text, SEPARATOR), lambda p: p != "")


def make_dsid(ds: Column, unit: Column) -> Column:
    return join_parts(ds, unit)


def split_dsid(dsid: Column) -> Column:
    """``struct<ds,id>``: the first part, and the rest joined again."""
    parts = split_parts(dsid)
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.struct(F.get(parts, F.lit(0)).alias("ds"), F.array_join(rest, SEPARATOR).alias("id"))


def ds_prefix(ds: str) -> str:
    """What every dsid of a data source starts with."""
    return ds + SEPARATOR


def file_range_id(ns: Column, file: Column, start: Column, end: Column) -> Column:
    return join_parts(ns, file, start, end)


def parse_file_range(unit: Column) -> Column:
    """``struct<ns,file,start,end>`` of a range id."""
    parts = split_parts(unit)
    return F.struct(
        F.get(parts, F.lit(0)).alias("ns"),
        F.get(parts, F.lit(1)).alias("file"),
        F.get(parts, F.lit(2)).try_cast("bigint").alias("start"),
        F.get(parts, F.lit(3)).try_cast("bigint").alias("end"),
    )


def clean_path(path: Column) -> Column:
    """A slash and the segments joined by single slashes; empty segments go."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.concat(F.lit("/"), F.array_join(segments, "/"))


def join_path(ns: Column, path: Column) -> Column:
    return clean_path(F.concat_ws("/", ns, path))


def plain_path(path: Column) -> Column:
    """A local path without its scheme, however that was written; other paths as they are."""
    return F.regexp_replace(path, "^file:/+", "/")
