"""Running totals per key that never put a whole key into one task.

Rows of a key are cut into consecutive blocks of bounded size. Block totals are summed on
the map side, their prefix sums are taken over the few blocks of each key, and every row
adds the total of its block's predecessors to the running total inside the block. A key
with a third of all rows is then many blocks on many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.timekeys import floor_div
from millrace.session import shared_dir

BLOCK_ROWS = 1 << 18


def seq_block(seq: str, block_rows: int = BLOCK_ROWS, within: Sequence[str] = ()) -> Column:
    """Block of a row by a bigint that is unique in its key, or in its key and the columns
    ``within``, which come first in the order: at most ``block_rows`` rows each."""
    block = floor_div(F.col(seq), block_rows)
    return F.struct(*within, block.alias("block")) if within else block


def present(rows: DataFrame, within: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Those of the columns that the rows have and that are no keys already."""
    return [c for c in within if c in rows.columns and c not in keys]


def block_totals(
    rows: DataFrame,
    keys: Sequence[str],
    block: Column,
    measures: Mapping[str, Column],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per key and block: each measure's total and, as ``<name>_before``, the total
    of the blocks before it. ``extra`` are further aggregates of the block."""
    totals = rows.groupBy(*keys, block.alias("_block")).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(n) for n, m in measures.items()], *extra
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "*",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in measures],
    )


def running_totals(
    rows: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    block: Column,
    measures: Mapping[str, Column],
    totals: DataFrame | None = None,
) -> DataFrame:
    """Add, per measure, its sum over the earlier rows of the same key.

    ``block`` must not fall as ``seq`` rises, and has to bound the rows of a block. The block
    heads travel through the same shuffle as the rows, so rows are shuffled once and NULL
    keys need no special join. ``totals`` may bring a corrected :func:`block_totals`.
    """
    if totals is None:
        totals = block_totals(rows, keys, block, measures)
    body = rows.select(
        "*",
        block.alias("_block"),
        F.lit(1).alias("_body"),
        *[F.coalesce(m, F.lit(0)).cast("bigint").alias(f"_m_{n}") for n, m in measures.items()],
    )
    heads = totals.select(
        *keys,
        "_block",
        F.lit(0).alias("_body"),
        *[F.col(f"{n}_before").alias(f"_m_{n}") for n in measures],
    )
    inside = (
        Window.partitionBy(*keys, "_block")
        .orderBy("_body", *seq)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = body.unionByName(heads, allowMissingColumns=True).select(
        *rows.columns, "_body", *[F.sum(f"_m_{n}").over(inside).alias(n) for n in measures]
    )
    return summed.where("_body = 1").drop("_body")


def running_from(
    rows: DataFrame, keys: Sequence[str], seq: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """As :func:`running_totals` for rows that were joined to their block's totals and carry
    ``_block`` and ``<name>_before``. The window is partitioned as that join is."""
    earlier = Window.partitionBy(*keys, "_block").orderBy(*seq).rowsBetween(Window.unboundedPreceding, -1)
    sums = [
        (F.col(f"{n}_before") + F.coalesce(F.sum(m).over(earlier), F.lit(0))).cast("bigint").alias(n)
        for n, m in measures.items()
    ]
    carried = {"_block", *[f"{n}_before" for n in measures]}
    return rows.select(*[c for c in rows.columns if c not in carried], *sums)


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of columns, NULL being equal to NULL."""
    test = F.lit(True)
    for a, b in zip(left, right):
        test = test & F.col(a).eqNullSafe(F.col(b))
    return test


def with_block_values(rows: DataFrame, keys: Sequence[str], values: DataFrame) -> DataFrame:
    """Rows that carry ``_block`` with a few values of their block, found by key and block."""
    names = [f"_v_{k}" for k in (*keys, "_block")]
    named = values.select(*[F.col(k).alias(n) for k, n in zip((*keys, "_block"), names)], *[c for c in values.columns if c not in (*keys, "_block")])
    return rows.join(named, same([*keys, "_block"], names), "left").drop(*names)


def previous(rows: DataFrame, keys: Sequence[str], seq: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the value of the row before, of the same key, to rows that carry ``_block``.

    The last value of each block is all that leaves it.
    """
    lasts = rows.groupBy(*keys, "_block").agg(F.max_by(value, F.struct(*seq)).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_block")
    lasts = lasts.select(*keys, "_block", F.lag("_last").over(before).alias("_before"))
    inside = Window.partitionBy(*keys, "_block").orderBy(*seq)
    found = with_block_values(rows, keys, lasts)
    return found.withColumn(name, F.coalesce(F.lag(value).over(inside), "_before")).drop("_before")


def running_since(
    rows: DataFrame, keys: Sequence[str], seq: Sequence[str], measure: str, reset: str, name: str, resets: str
) -> DataFrame:
    """Add to rows that carry ``_block`` the sum of a measure over the earlier rows of the key since the last
    row with ``reset``, and as ``resets`` how many of those there were, the row itself included.

    What a block hands on is whether it has a reset, and its sum since the last one: combining two of these is
    associative, so blocks are scanned one by one on all tasks and joined by a scan over the few blocks of a key.
    """
    order = Window.partitionBy(*keys, "_block").orderBy(*seq)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = rows.withColumn("_cut", F.sum(F.col(reset).cast("bigint")).over(upto))
    since = Window.partitionBy(*keys, "_block", "_cut").orderBy(*seq).rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.withColumn("_in", F.coalesce(F.sum(measure).over(since), F.lit(0)))
    ends = inside.groupBy(*keys, "_block").agg(
        F.max("_cut").alias("_cuts"), F.max_by(F.col("_in") + F.col(measure), F.struct(*seq)).alias("_tail")
    )
    blocks = Window.partitionBy(*keys).orderBy("_block")
    far = blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("_epoch", F.sum(F.when(F.col("_cuts") > 0, 1).otherwise(0)).over(far))
    ends = ends.withColumn("_all", F.sum("_cuts").over(far))
    epoch = Window.partitionBy(*keys, "_epoch").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("_sum", F.sum("_tail").over(epoch))
    carried = ends.select(
        *keys, "_block", F.coalesce(F.lag("_sum").over(blocks), F.lit(0)).alias("_carry"),
        F.coalesce(F.lag("_all").over(blocks), F.lit(0)).alias("_earlier"),
    )
    found = with_block_values(inside, keys, carried)
    total = F.col("_in") + F.when(F.col("_cut") == 0, F.col("_carry")).otherwise(0)
    return found.select(*rows.columns, total.cast("bigint").alias(name), (F.col("_earlier") + F.col("_cut")).cast("bigint").alias(resets))


def number_rows(rows: DataFrame, order: Sequence[str], name: str = "rownum") -> DataFrame:
    """Number all rows from 1 in an order that may have no dense key.

    A distributed sort is kept by a checkpoint, which fixes the rows of every partition; the
    number is the count of the partitions before plus the place inside. Only one count per
    partition is summed in one place.
    """
    shared_dir(rows.sparkSession)
    place = F.monotonically_increasing_id()
    kept = rows.orderBy(*order).checkpoint().select("*", place.alias("_place"))
    kept = kept.select("*", F.shiftright("_place", 33).alias("_part"))
    counts = kept.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    # one row per partition of the sort, so its size is that of the task list
    numbered = kept.join(F.broadcast(starts), "_part")
    return numbered.select(
        *rows.columns, (F.col("_before") + F.col("_place") - F.col("_first") + 1).alias(name)
    )
