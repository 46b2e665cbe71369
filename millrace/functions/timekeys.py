"""Event time, hour keys, file names and dated directories.

Times are epoch milliseconds (bigint) in UTC. Dates are formatted by arithmetic on them,
so the result does not depend on the session time zone.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F

from millrace.functions.payload import lookup

DAY_MS = 86_400_000
HOUR_MS = 3_600_000

TimeParser = Callable[[Column, Sequence[str]], Column]
NameParser = Callable[[Column], Column]
DirFormat = Callable[[Column], Column]

# Separators of a file name and the two ways it may hold its date and hour.
NAME_SPLIT = r"[_\.]"
DATE_HOUR = r"(\d{10})"
DASHED_DATE_HOUR = r"(\d{4}-\d{2}-\d{2}-\d{2})"


def epoch_millis(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp without time zone, read as UTC."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def floor_div(n: Column, size: int) -> Column:
    """Whole blocks of ``size`` below n, also for negative n."""
    return F.call_function("div", n - F.pmod(n, F.lit(size)), F.lit(size)).cast("bigint")


def date_text(ts_ms: Column) -> Column:
    """``yyyyMMdd``"""
    day = F.date_add(F.lit("1970-01-01").cast("date"), floor_div(ts_ms, DAY_MS).cast("int"))
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


def hour_text(ts_ms: Column) -> Column:
    """``yyyyMMddHH``"""
    hour = floor_div(F.pmod(ts_ms, F.lit(DAY_MS)), HOUR_MS).cast("string")
    return F.concat(date_text(ts_ms), F.lpad(hour, 2, "0"))


def hour_key(topic: Column, ts_ms: Column) -> Column:
    """``topic_yyyyMMddHH``"""
    return F.concat_ws("_", topic, hour_text(ts_ms))


def _from_record(record: Column, path: Sequence[str]) -> Column:
    return lookup(record, path, None).try_cast("bigint")


TIME_PARSERS: dict[str, TimeParser] = {"obj": _from_record}


def event_time(
    record: Column,
    parser: Column,
    now_ms: Column,
    path: Sequence[str] = ("ts",),
    custom: Mapping[str, TimeParser] | None = None,
) -> Column:
    """Epoch ms by parser name; ``now``, unknown names and missing values give ``now_ms``."""
    ts = F.lit(None).cast("bigint")
    for name, function in {**TIME_PARSERS, **(custom or {})}.items():
        ts = F.when(parser == name, function(record, path)).otherwise(ts)
    return F.coalesce(ts, now_ms)


def name_date_hour(name: Column) -> Column:
    digits = F.nullif(F.regexp_extract(name, DATE_HOUR, 1), F.lit(""))
    dashed = F.nullif(F.regexp_extract(name, DASHED_DATE_HOUR, 1), F.lit(""))
    return F.coalesce(digits, F.replace(dashed, F.lit("-"), F.lit("")))


def _name_parts(name: Column, kind: Column, ident: Column) -> Column:
    return F.struct(kind.alias("type"), ident.alias("id"), name_date_hour(name).alias("date_hour"))


def name_model(split_regex: str = NAME_SPLIT, with_id: bool = True) -> NameParser:
    """``type_id_hr_yyyyMMddHH.ext``, or without the id, which is then ``1``."""

    def parse(name: Column) -> Column:
        parts = F.split(name, split_regex)
        return _name_parts(name, F.get(parts, F.lit(0)), F.get(parts, F.lit(1)) if with_id else F.lit("1"))

    return parse


FILE_MODELS: dict[int, NameParser] = {1: name_model(), 2: name_model(with_id=False)}


def parse_file_name(
    name: Column, model: int = 1, custom: Mapping[int, NameParser] | None = None
) -> Column:
    """``struct<type,id,date_hour>`` of a file name by model number."""
    return {**FILE_MODELS, **(custom or {})}[model](name)


def _day_and_hour(d: Column) -> Column:
    return F.concat(F.lit("dt="), F.left(d, F.lit(8)), F.lit("/hr="), d)


def _calendar_fields(d: Column) -> Column:
    return F.concat(
        F.lit("year="), F.substring(d, 1, 4), F.lit("/month="), F.substring(d, 5, 2),
        F.lit("/day="), F.substring(d, 7, 2), F.lit("/hour="), F.substring(d, 9, 2),
    )


DIR_MODELS: dict[int, DirFormat] = {1: _day_and_hour, 2: _calendar_fields}


def partition_dir(
    date_hour: Column, model: int = 1, custom: Mapping[int, DirFormat] | None = None
) -> Column:
    """Directory of a ``yyyyMMddHH`` text by model number; NULL if it is no date and hour."""
    valid = F.try_to_timestamp(date_hour, F.lit("yyyyMMddHH")).isNotNull()
    return F.when(valid, {**DIR_MODELS, **(custom or {})}[model](date_hour))


def remote_path(base: Column, kind: Column, directory: Column, host: Column, name: Column) -> Column:
    """``base/type/directory/host-name``"""
    return F.concat_ws("/", base, kind, directory, F.concat_ws("-", host, name))
