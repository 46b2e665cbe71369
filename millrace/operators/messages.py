"""Messages: build, flatten, pack, batch, order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from millrace.operators.blocks import BLOCK_ROWS, present, running_totals, seq_block
from millrace.functions.timekeys import floor_div


def _as_list(df: DataFrame, name: str, item_type: str) -> Column:
    if isinstance(df.schema[name].dataType, ArrayType):
        return F.col(name).cast(f"array<{item_type}>")
    return F.array(F.col(name).cast(item_type))


def make_message(
    df: DataFrame,
    payload: str = "value",
    ds: str = "ds",
    ids: str = "ids",
    topic: str = "topic",
    accept: str = "accept",
    ts: str = "ts",
    priority: str = "priority",
) -> DataFrame:
    """The message layout; a single payload or id becomes a list of one."""
    return df.select(
        _as_list(df, payload, "binary").alias("payloads"),
        F.col(ds).cast("string").alias("ds"),
        _as_list(df, ids, "string").alias("ids"),
        F.col(topic).cast("string").alias("topic"),
        F.col(accept).cast("boolean").alias("accept"),
        F.col(ts).alias("ts"),
        F.col(priority).cast("bigint").alias("priority"),
    )


def change_payload(messages: DataFrame, payloads: Column) -> DataFrame:
    """New payloads, everything else kept."""
    return messages.withColumn("payloads", payloads)


def explode_payloads(messages: DataFrame, payloads: str = "payloads") -> DataFrame:
    """One row per payload, with its position; nested lists are flattened first."""
    items = F.col(payloads)
    kind = messages.schema[payloads].dataType
    while isinstance(kind, ArrayType) and isinstance(kind.elementType, ArrayType):
        items, kind = F.flatten(items), kind.elementType
    others = [c for c in messages.columns if c != payloads]
    return messages.select(*others, F.posexplode(items).alias("pos", "value"))


def explode_ids(messages: DataFrame, ids: str = "ids") -> DataFrame:
    others = [c for c in messages.columns if c != ids]
    return messages.select(*others, F.explode(ids).alias("id"))


def batch_messages(
    messages: DataFrame,
    size: int,
    keys: Sequence[str] = ("topic",),
    seq: str = "offset",
    stop_at_null: str | None = None,
    block_rows: int = BLOCK_ROWS,
    within: Sequence[str] = ("partition",),
) -> DataFrame:
    """Add ``batch``: consecutive messages of a key in groups of ``size``.

    Offsets repeat in every partition of a topic, so the messages of a key are taken partition by
    partition (the columns ``within`` that there are), and no block has more than ``block_rows`` of
    them. With ``stop_at_null`` a key ends at its first message where that column is NULL.
    """
    within = present(messages, within, keys)
    measures = {"_row": F.lit(1)}
    if stop_at_null:
        measures["_nulls"] = F.col(stop_at_null).isNull().cast("int")
    numbered = running_totals(messages, keys, [*within, seq], seq_block(seq, block_rows, within), measures)
    if stop_at_null:
        numbered = numbered.where((F.col("_nulls") == 0) & F.col(stop_at_null).isNotNull())
    return numbered.withColumn("batch", floor_div(F.col("_row"), size)).drop(*measures)


def pack_messages(
    batched: DataFrame,
    keys: Sequence[str] = ("topic", "batch"),
    seq: str = "offset",
    value: str = "value",
    unit: str = "id",
) -> DataFrame:
    """One message per batch with its payloads and ids in order; a batch bounds the lists."""
    order = [*present(batched, ("partition",), keys), seq]
    items = F.sort_array(F.collect_list(F.struct(*order, value, unit)))
    return batched.groupBy(*keys).agg(items.alias("_items")).select(
        *keys,
        F.transform("_items", lambda i: i[value]).alias("payloads"),
        F.transform("_items", lambda i: i[unit]).alias("ids"),
    )


def group_by_key(
    messages: DataFrame,
    keys: Sequence[str],
    seq: str = "offset",
    value: str = "line",
    group_rows: int = 4096,
    within: Sequence[str] = ("partition",),
) -> DataFrame:
    """Lines of a key in order, ready to be written in one go.

    A key comes in parts of at most ``group_rows`` values of ``seq`` in a partition (the columns
    ``within`` that there are; ``part`` rises with ``seq``), so a key of any size is never gathered
    in one place.
    """
    within = present(messages, within, keys)
    items = F.sort_array(F.collect_list(F.struct(seq, value)))
    parts = messages.groupBy(*keys, *within, seq_block(seq, group_rows).alias("part")).agg(
        F.count("*").alias("n"), items.alias("_items")
    )
    return parts.withColumn("lines", F.transform("_items", lambda i: i[value])).drop("_items")


def priority_order(messages: DataFrame, ties: Sequence[str] = ("ts", "topic", "partition", "offset")) -> DataFrame:
    """Lowest priority number first. The ties keep equal priorities divisible between tasks."""
    return messages.orderBy("priority", *ties)
