"""Decode payloads, project records by definition, encode rows.

A decoded record is a ``map<string,string>``: each top-level key with its value as text,
nested values as JSON text. One parse serves every top-level column, a missing key stays
distinguishable from a JSON null, and numbers keep the form they were written in.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F

RECORD_TYPE = "map<string,string>"
DEFINITION_TYPE = "array<struct<path:array<string>,default:string>>"
LAYOUT_TYPE = "struct<parents:array<array<string>>,cells:array<struct<parent:int,key:string,default:string>>>"

Definitions = Sequence[tuple[Sequence[str], str | None]]
Decoder = Callable[[Column], Column]
Encoder = Callable[[Column, Column, "Column | Definitions"], Column]


def parse_record(value: Column) -> Column:
    """JSON object text or bytes to a record; NULL when it is not a JSON object."""
    return F.from_json(value.cast("string"), RECORD_TYPE)


# --- definitions -----------------------------------------------------------------------


def _as_text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value)


def definition_list(data: str | Sequence) -> list[tuple[list[str], str | None]]:
    """Definitions known when the plan is built, from JSON text or ``[[path, default], ...]``."""
    pairs = json.loads(data) if isinstance(data, str) else data
    return [([s for s in path.split("/") if s], _as_text(default)) for path, default in pairs]


def parse_definitions(data: Column) -> Column:
    """Definition JSON text to ``array<struct<path,default>>``; empty path segments go."""
    pairs = F.from_json(data, "array<array<string>>")
    return F.transform(
        pairs,
        lambda p: F.struct(
            F.filter(F.split(F.get(p, F.lit(0)), "/"), lambda s: s != "").alias("path"),
            F.get(p, F.lit(1)).alias("default"),
        ),
    )


def type_default(data_type: Column) -> Column:
    """Default text of a column by its declared type."""
    return F.when(data_type == "string", "").when(data_type == "boolean", "false").otherwise("-1")


# --- projection ------------------------------------------------------------------------


def lookup(record: Column, path: Sequence[str], default: str | None) -> Column:
    """Value at a fixed path; the default only when the key is missing or the path is empty."""
    fallback = F.lit(default).cast("string")
    if not path:
        return fallback
    for segment in path[:-1]:
        record = parse_record(record[segment])
    return _pick(record, F.lit(path[-1]), fallback)


def _pick(level: Column, key: Column, default: Column) -> Column:
    return F.when(F.map_contains_key(level, key), level[key]).otherwise(default)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def definition_layout(definitions: Column) -> Column:
    """Definitions as ``struct<parents,cells>``: every nested object they reach into, once, and
    for every cell the number of its object (0 is the record), its key and its default.

    Meant to be computed where the definitions are kept, one row per topic.
    """
    parents = F.array_distinct(
        F.transform(
            F.filter(definitions, lambda d: F.size(d["path"]) > 1),
            lambda d: F.slice(d["path"], F.lit(1), F.size(d["path"]) - 1),
        )
    )
    return _bind(
        parents,
        lambda p: F.struct(
            p.alias("parents"),
            F.transform(
                definitions,
                lambda d: F.struct(
                    F.when(F.size(d["path"]) < 2, 0)
                    .otherwise(F.array_position(p, F.slice(d["path"], F.lit(1), F.size(d["path"]) - 1)))
                    .cast("int")
                    .alias("parent"),
                    F.get(d["path"], F.size(d["path"]) - 1).alias("key"),
                    d["default"].alias("default"),
                ),
            ).alias("cells"),
        ),
    )


def _nested(record: Column, path: Column) -> Column:
    """The object at a path that is data."""
    rest = F.slice(path, F.lit(2), F.size(path) - 1)
    first = parse_record(record[F.get(path, F.lit(0))])
    return F.aggregate(rest, first, lambda level, key: parse_record(level[key]))


def laid_out_array(record: Column, layout: Column) -> Column:
    """Pick values by a :func:`definition_layout`; every nested object is parsed once."""
    levels = F.concat(F.array(record), F.transform(layout["parents"], lambda p: _nested(record, p)))
    return _bind(
        levels,
        lambda level: F.transform(
            layout["cells"], lambda c: _pick(F.get(level, c["parent"]), c["key"], c["default"])
        ),
    )


def _fixed_array(record: Column, definitions: Definitions) -> Column:
    parents = list(dict.fromkeys(tuple(path[:-1]) for path, _ in definitions if len(path) > 1))
    if not parents:
        return F.array(*[lookup(record, path, default) for path, default in definitions])

    def nested(path: Sequence[str]) -> Column:
        level = record
        for segment in path:
            level = parse_record(level[segment])
        return level

    def cell(levels: Column, path: Sequence[str], default: str | None) -> Column:
        if len(path) < 2:
            return lookup(record, path, default)
        level = F.get(levels, F.lit(parents.index(tuple(path[:-1]))))
        return _pick(level, F.lit(path[-1]), F.lit(default).cast("string"))

    return _bind(
        F.array(*[nested(p) for p in parents]),
        lambda levels: F.array(*[cell(levels, path, default) for path, default in definitions]),
    )


def json_to_array(record: Column, definitions: Column | Definitions) -> Column:
    """Pick values by definition, in order; a present JSON null stays NULL.

    Definitions are a list known now, or a column with their :func:`definition_layout`.
    """
    if not isinstance(definitions, Column):
        return _fixed_array(record, definitions)
    return laid_out_array(record, definitions)


def _quoted(cell: Column, separator: str) -> Column:
    plain = ~(cell.contains(separator) | cell.contains('"') | cell.contains("\n") | cell.contains("\r"))
    return F.when(cell.isNull() | plain, cell).otherwise(
        F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
    )


def json_to_csv(
    record: Column, definitions: Column | Definitions, separator: str = ",", quote: bool = False
) -> Column:
    """Values joined by the separator; NULL prints as empty. Not quoted unless asked for."""
    cells = json_to_array(record, definitions)
    if quote:
        cells = F.transform(cells, lambda c: _quoted(c, separator))
    return F.array_join(cells, separator, "")


def json_to_tsv(record: Column, definitions: Column | Definitions, quote: bool = False) -> Column:
    return json_to_csv(record, definitions, "\t", quote)


# --- decoders and encoders by name -----------------------------------------------------

DECODERS: dict[str, Decoder] = {"json": parse_record}

ENCODERS: dict[str, Encoder] = {
    # compact JSON text in the order of the document
    "json": lambda value, record, defs: F.get_json_object(value.cast("string"), "$"),
    "json-csv": lambda value, record, defs: json_to_csv(record, defs),
    "json-tsv": lambda value, record, defs: json_to_tsv(record, defs),
}


def decode_payload(
    value: Column, decoder: Column, custom: Mapping[str, Decoder] | None = None
) -> Column:
    """Record by decoder name. ``default`` and unknown names keep the bytes: record is NULL."""
    record = F.lit(None).cast(RECORD_TYPE)
    for name, function in {**DECODERS, **(custom or {})}.items():
        record = F.when(decoder == name, function(value)).otherwise(record)
    return record


def decode_failed(
    value: Column, record: Column, decoder: Column, custom: Mapping[str, Decoder] | None = None
) -> Column:
    """True where a decoder that makes records was given a payload and made none."""
    names = list({**DECODERS, **(custom or {})})
    return value.isNotNull() & F.coalesce(decoder.isin(names), F.lit(False)) & record.isNull()


def encode_payload(
    value: Column,
    record: Column,
    encoder: Column,
    definitions: Column | Definitions,
    custom: Mapping[str, Encoder] | None = None,
    decoder: Column | None = None,
) -> Column:
    """Output line by encoder name. ``default`` and unknown names give the original payload.

    ``json`` keeps the document of a JSON payload. A record that another ``decoder`` made is
    written out as a JSON object, nested JSON text as text.
    """
    line = value.cast("string")
    if decoder is not None and "json" not in (custom or {}):
        of_record = F.when(decoder == "json", ENCODERS["json"](value, record, definitions)).otherwise(F.to_json(record))
        custom = {"json": lambda *_: of_record, **(custom or {})}
    for name, function in {**ENCODERS, **(custom or {})}.items():
        line = F.when(encoder == name, function(value, record, definitions)).otherwise(line)
    return line
