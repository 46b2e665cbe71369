"""From raw messages to keyed output lines: decode, time, encode, key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.payload import (
    Decoder,
    Encoder,
    decode_failed,
    decode_payload,
    definition_layout,
    encode_payload,
)
from millrace.functions.timekeys import TimeParser, event_time, hour_key
from millrace.operators.joins import lookup_join
from millrace.operators.settings import DEFAULTS

SPREAD = ("partition", "offset")


def with_settings(messages: DataFrame, resolved: DataFrame, spread: Sequence[str] = SPREAD) -> DataFrame:
    """Messages with the settings of their topic; a topic without any gets the defaults.

    The definitions come along laid out, which is done once per topic.
    """
    ready = resolved.withColumn("layout", definition_layout(F.col("definitions"))).drop("definitions")
    joined = lookup_join(messages, ready, ["topic"], "left", spread)
    for name, value in DEFAULTS.items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return joined


def computed(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Rows with a costly column that is computed once, whatever is filtered or selected by it later.

    Catalyst moves a filter below a projection by repeating the projected expression in it; it
    does not move one below the list of one element that this makes.
    """
    kept = [c for c in rows.columns if c != name]
    return rows.select(*kept, F.explode_outer(F.array(value)).alias(name))


def decode_messages(messages: DataFrame, custom: Mapping[str, Decoder] | None = None) -> DataFrame:
    """Add ``record`` and ``failed`` by the ``decoder`` column."""
    value, decoder = F.col("value"), F.col("decoder")
    decoded = computed(messages, decode_payload(value, decoder, custom), "record")
    return decoded.withColumn("failed", decode_failed(value, F.col("record"), decoder, custom))


def drop_null_payload(decoded: DataFrame) -> DataFrame:
    """Rows that have a payload and, where they should, a record."""
    return decoded.where(F.col("value").isNotNull() & ~F.col("failed"))


def dead_letter(decoded: DataFrame) -> DataFrame:
    """Rows whose payload could not be decoded, as they came."""
    return decoded.where("failed").drop("record", "failed")


def key_and_encode(
    good: DataFrame,
    now_ms: Column,
    time_path: Sequence[str] = ("ts",),
    encoders: Mapping[str, Encoder] | None = None,
    time_parsers: Mapping[str, TimeParser] | None = None,
) -> DataFrame:
    """Add ``ts_ms``, the hour ``key`` and the output ``line``."""
    ts_ms = event_time(F.col("record"), F.col("time_parser"), now_ms, time_path, time_parsers)
    timed = good.withColumn("ts_ms", ts_ms)
    line = encode_payload(
        F.col("value"), F.col("record"), F.col("encoder"), F.col("layout"), encoders, F.col("decoder")
    )
    encoded = computed(timed, line, "line").withColumn("key", hour_key(F.col("topic"), F.col("ts_ms")))
    kept = [c for c in timed.columns if c not in ("record", "failed", "layout", "key", "line")]
    return encoded.select(*kept, "key", "line")


def process_messages(
    messages: DataFrame,
    resolved: DataFrame,
    now_ms: Column,
    time_path: Sequence[str] = ("ts",),
    decoders: Mapping[str, Decoder] | None = None,
    encoders: Mapping[str, Encoder] | None = None,
    time_parsers: Mapping[str, TimeParser] | None = None,
    spread: Sequence[str] = SPREAD,
) -> DataFrame:
    """The whole way for good messages, without a shuffle of the messages."""
    decoded = decode_messages(with_settings(messages, resolved, spread), decoders)
    return key_and_encode(drop_null_payload(decoded), now_ms, time_path, encoders, time_parsers)
