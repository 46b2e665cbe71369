"""Where files of a key roll over: by size, and by time without writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.timekeys import floor_div
from millrace.operators.blocks import BLOCK_ROWS, present, previous, running_since, running_totals, seq_block

# The default roll size in bytes and the default idle time in milliseconds.
ROLL_BYTES = 134_217_728
IDLE_MS = 60_000
SLOT_MS = 60_000


def line_bytes(line: Column) -> Column:
    """Bytes a line takes in a file, newline included."""
    return F.octet_length(line) + 1


def size_rolls(
    lines: DataFrame,
    keys: Sequence[str] = ("key",),
    seq: str = "offset",
    line: str = "line",
    roll_bytes: int = ROLL_BYTES,
    block_rows: int = BLOCK_ROWS,
    within: Sequence[str] = ("partition",),
) -> DataFrame:
    """Add ``roll``: the number of whole roll sizes written to the key before the line.

    A file therefore passes the roll size by less than the one line that crosses it. A key that
    spans several partitions of a topic is written partition by partition (the columns
    ``within`` that there are).
    """
    within = present(lines, within, keys)
    placed = running_totals(
        lines, keys, [*within, seq], seq_block(seq, block_rows, within), {"_bytes": line_bytes(F.col(line))}
    )
    return placed.withColumn("roll", floor_div(F.col("_bytes"), roll_bytes)).drop("_bytes")


def idle_rolls(
    lines: DataFrame,
    keys: Sequence[str] = ("key",),
    ts_ms: str = "ts_ms",
    line: str = "line",
    idle_ms: int = IDLE_MS,
) -> DataFrame:
    """Files of a key closed by ``idle_ms`` without a write: times, lines and bytes of each.

    Lines are first summed per idle-time slot on the map side. Lines of one slot are always in
    the same file, so a key costs one row per slot, however many lines it has.
    """
    slots = lines.groupBy(*keys, floor_div(F.col(ts_ms), idle_ms).alias("_slot")).agg(
        F.min(ts_ms).alias("first_ms"),
        F.max(ts_ms).alias("last_ms"),
        F.count("*").alias("n"),
        F.sum(line_bytes(F.col(line))).alias("bytes"),
    )
    in_order = Window.partitionBy(*keys).orderBy("_slot")
    idle = F.col("first_ms") - F.lag("last_ms").over(in_order) >= idle_ms
    opened = slots.withColumn("_new", F.coalesce(idle, F.lit(False)).cast("int"))
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        opened.withColumn("roll", F.sum("_new").over(so_far))
        .groupBy(*keys, "roll")
        .agg(
            F.min("first_ms").alias("first_ms"),
            F.max("last_ms").alias("last_ms"),
            F.sum("n").alias("n"),
            F.sum("bytes").alias("bytes"),
        )
    )


def size_and_idle_rolls(
    lines: DataFrame,
    keys: Sequence[str] = ("key",),
    ts_ms: str = "ts_ms",
    line: str = "line",
    roll_bytes: int = ROLL_BYTES,
    idle_ms: int = IDLE_MS,
    seq: Sequence[str] = ("partition", "offset"),
    slot_ms: int = SLOT_MS,
) -> DataFrame:
    """Add ``idle_no`` and ``roll``: a file ends after ``idle_ms`` without a line, or with the line that
    fills it, whichever is first; the bytes are counted anew after an idle time.

    Lines of a key are in order of time, then ``seq``. They are placed block by block, a block being
    ``slot_ms`` of a key: what a key gets in that time has to fit in a task, the key has not.
    """
    order = [ts_ms, *seq]
    blocked = lines.withColumn("_block", floor_div(F.col(ts_ms), slot_ms)).withColumn("_size", line_bytes(F.col(line)).cast("bigint"))
    blocked = blocked.repartition(*keys, "_block")  # the rows move once, all steps read them from here
    timed = previous(blocked, keys, order, ts_ms, "_prev")
    idle = F.coalesce(F.col(ts_ms) - F.col("_prev") >= idle_ms, F.lit(False))
    placed = running_since(timed.withColumn("_idle", idle), keys, order, "_size", "_idle", "_since", "idle_no")
    return placed.select(*lines.columns, "idle_no", floor_div(F.col("_since"), roll_bytes).alias("roll"))


def idle_rolls_stream(
    lines: DataFrame, keys: Sequence[str], ts: str, late: str, idle_ms: int = IDLE_MS
) -> DataFrame:
    """The same on a stream: a file is emitted once the watermark has passed its idle time.

    Sessions that touch are one session to Spark, so the gap is one microsecond short of the
    idle time.
    """
    gap = f"{idle_ms * 1000 - 1} microseconds"
    return (
        lines.withWatermark(ts, late)
        .groupBy(*keys, F.session_window(ts, gap))
        .agg(F.count("*").alias("n"), F.max(ts).alias("last_ts"))
        .select(*keys, F.col("session_window.start").alias("first_ts"), "last_ts", "n")
    )
