"""Send messages to the processor named for their topic."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators.joins import lookup_join

SPREAD = ("partition", "offset")


def route(messages: DataFrame, routes: DataFrame, spread: Sequence[str] = SPREAD) -> DataFrame:
    """Messages with their ``processor``; ``routes`` has one row per topic."""
    return lookup_join(messages, routes, ["topic"], "inner", spread)


def route_all(messages: DataFrame, routes: DataFrame, spread: Sequence[str] = SPREAD) -> DataFrame:
    """As :func:`route`, and messages without a route with a NULL ``processor``."""
    return lookup_join(messages, routes, ["topic"], "left", spread)


def unroutable(messages: DataFrame, routes: DataFrame, spread: Sequence[str] = SPREAD) -> DataFrame:
    """Messages whose topic no processor takes."""
    return lookup_join(messages, routes.select("topic"), ["topic"], "left_anti", spread)


def route_or_fail(messages: DataFrame, routes: DataFrame, spread: Sequence[str] = SPREAD) -> DataFrame:
    """As :func:`route`, but the job stops at a message without processor."""
    routed = lookup_join(messages, routes, ["topic"], "left", spread)
    missing = F.raise_error(F.concat(F.lit("no processor for topic "), F.coalesce("topic", F.lit("NULL"))))
    return routed.withColumn(
        "processor", F.when(F.col("processor").isNull(), missing).otherwise(F.col("processor"))
    )


def dispatch(routed: DataFrame, processors: Mapping[str, Callable[[DataFrame], None]]) -> None:
    """Run each processor on its share. Routes are few; every share is a distributed job."""
    for name, process in processors.items():
        process(routed.where(F.col("processor") == name).drop("processor"))
