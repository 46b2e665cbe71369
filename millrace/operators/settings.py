"""Topics, encoders and columns from configuration tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.payload import (
    DECODERS,
    DEFINITION_TYPE,
    ENCODERS,
    parse_definitions,
    type_default,
)
from millrace.functions.timekeys import TIME_PARSERS

# What a topic gets when nothing is configured.
DEFAULTS = {"encoder": "default", "decoder": "default", "time_parser": "now"}


def sub_settings(settings: DataFrame, parent: str) -> DataFrame:
    """Settings below ``parent.``, with that prefix taken off."""
    prefix = parent + "."
    rest = F.expr(f"substring(key, {len(prefix) + 1})")
    return settings.where(F.col("key").startswith(prefix)).withColumn("key", rest)


def enabled_topics(logs: DataFrame, host: str, kind: str = "hdfs") -> DataFrame:
    """Topics this host shall read."""
    return logs.where((F.col("type") == kind) & (F.col("host") == host) & (F.col("enabled") == 1)).select("log")


def topics_to_add(wanted: DataFrame, active: DataFrame) -> DataFrame:
    return wanted.distinct().join(active.distinct(), wanted.columns, "left_anti")


def topics_to_remove(wanted: DataFrame, active: DataFrame) -> DataFrame:
    return topics_to_add(active, wanted)


def log_columns(encoders: DataFrame, source_logs: DataFrame, source_log_fields: DataFrame) -> DataFrame:
    """Columns ``(log, field_id, path, default)`` of the logs whose encoder brings no definition."""
    undefined = encoders.where(F.coalesce(F.col("data"), F.lit("")) == "").select("log")
    named = source_logs.select("log_id", F.col("log_name").alias("log")).join(undefined, "log", "left_semi")
    return source_log_fields.join(named, "log_id").select(
        "log", "field_id", F.col("field_name").alias("path"), type_default(F.col("data_type")).alias("default")
    )


def encoder_definitions(
    encoders: DataFrame, source_logs: DataFrame, source_log_fields: DataFrame
) -> DataFrame:
    """Encoder and column definitions of every log in the encoder table.

    The definition is one list because every output line of the log has all its columns.
    """
    fields = F.sort_array(
        F.collect_list(
            F.struct(
                "field_id",
                F.struct(
                    F.filter(F.split("path", "/"), lambda s: s != "").alias("path"),
                    F.col("default").alias("default"),
                ).alias("column"),
            )
        )
    )
    listed = (
        log_columns(encoders, source_logs, source_log_fields)
        .groupBy("log")
        .agg(F.transform(fields, lambda f: f["column"]).alias("_listed"))
    )
    given = F.when(F.coalesce(F.col("data"), F.lit("")) != "", parse_definitions(F.col("data")))
    return encoders.join(listed, "log", "left").select(
        F.col("log").alias("topic"),
        F.col("type").alias("encoder"),
        F.coalesce(given, F.col("_listed"), F.array().cast(DEFINITION_TYPE)).alias("definitions"),
    )


def _known(name: Column, known: Iterable[str], otherwise: str) -> Column:
    return F.when(name.isin(list(known)), name).otherwise(otherwise)


def resolve_settings(
    topics: DataFrame,
    encoders: DataFrame,
    properties: DataFrame,
    defaults: Mapping[str, str] | None = None,
    decoders: Iterable[str] = (),
    custom_encoders: Iterable[str] = (),
    time_parsers: Iterable[str] = (),
) -> DataFrame:
    """Encoder, decoder and time parser of every topic.

    ``encoders`` (topic, encoder, definitions) wins over ``properties`` (topic, name, value),
    those over ``defaults``; a name nobody knows falls back as if nothing were set. Of several
    encoders of a topic the first in the order of their names and definitions counts.
    """
    pair = F.min(F.struct("encoder", "definitions")).alias("_e")
    encoders = encoders.groupBy("topic").agg(pair).select("topic", "_e.*")
    base = {**DEFAULTS, **(defaults or {})}
    named = properties.groupBy("topic").agg(
        *[F.max(F.when(F.col("name") == n, F.col("value"))).alias(f"_{n}") for n in DEFAULTS]
    )
    chosen = topics.select("topic").distinct().join(encoders, "topic", "left").join(named, "topic", "left")
    encoder = F.coalesce("encoder", "_encoder", F.lit(base["encoder"]))
    decoder = F.coalesce("_decoder", F.lit(base["decoder"]))
    parser = F.coalesce("_time_parser", F.lit(base["time_parser"]))
    return chosen.select(
        "topic",
        _known(encoder, [*ENCODERS, *custom_encoders], DEFAULTS["encoder"]).alias("encoder"),
        F.coalesce("definitions", F.array().cast(DEFINITION_TYPE)).alias("definitions"),
        _known(decoder, [*DECODERS, *decoders], DEFAULTS["decoder"]).alias("decoder"),
        _known(parser, [*TIME_PARSERS, *time_parsers], DEFAULTS["time_parser"]).alias("time_parser"),
    )
