"""Rates, counters and value distributions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.timekeys import floor_div
from millrace.operators.joins import lookup_join

# Fixed values of moving rates: their lengths in minutes, a tick of five seconds, twelve of them a minute.
MINUTES, TICK_MS, TICKS = (1, 5, 15), 5000, 12
QUANTILES = (0.5, 0.75, 0.95, 0.98, 0.99, 0.999)
SKETCH_K = 200


def windowed_rate(
    rows: DataFrame, label: str, ts_ms: str, window_ms: int, size: Column | None = None
) -> DataFrame:
    """Rows (and bytes) per second by label and window, and a ``total`` per window, where ``whole`` is true.

    The total is taken from the sums of the labels, so the rows are read and shuffled once. A label
    that is called ``total`` has rows of its own.
    """
    size = F.lit(0) if size is None else size
    per_label = rows.groupBy(floor_div(F.col(ts_ms), window_ms).alias("_w"), F.col(label).alias("_label")).agg(
        F.count("*").alias("n"), F.sum(size).alias("bytes")
    )
    one = F.struct(F.col("_label").alias("l"), F.lit(False).alias("whole"))
    both = per_label.select("_w", "n", "bytes", F.explode(F.array(one, F.struct(F.lit("total").alias("l"), F.lit(True).alias("whole")))).alias("_of"))
    both = both.select("_w", "n", "bytes", F.col("_of.l").alias(label), F.col("_of.whole").alias("whole"))
    seconds = window_ms / 1000.0
    return (
        both.groupBy("_w", label, "whole")
        .agg(F.sum("n").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
        .select(
            label,
            "whole",
            (F.col("_w") * window_ms).alias("window_ms"),
            "n",
            "bytes",
            (F.col("n") / F.lit(seconds)).alias("n_per_sec"),
            (F.col("bytes") / F.lit(seconds)).alias("bytes_per_sec"),
        )
    )


def topic_throughput(
    messages: DataFrame, ts_ms: str = "ts_ms", line: str = "line", window_ms: int = 1000
) -> DataFrame:
    """Messages and bytes written per second by topic; NULL lines are not written."""
    written = messages.where(F.col(line).isNotNull())
    return windowed_rate(written, "topic", ts_ms, window_ms, F.octet_length(line))


def publish_rate(
    messages: DataFrame, destination: str = "processor", ts_ms: str = "ts_ms", window_ms: int = 1000
) -> DataFrame:
    """Messages published per second by destination."""
    return windowed_rate(messages, destination, ts_ms, window_ms).drop("bytes", "bytes_per_sec")


def moving_rates(
    events: DataFrame, label: str, ts_ms: str = "ts_ms", minutes: Sequence[int] = MINUTES, tick_ms: int = TICK_MS
) -> DataFrame:
    """Exponentially weighted moving rates per second, as of the end of every minute in which a label has rows.

    Every tick a rate moves towards the rate of the tick by the part 1 - exp(-tick / minutes); the first
    tick of a label sets it. Returned are ``label, minute_ms`` and ``rate_<minutes>`` for each. (A minute is twelve ticks,
    whatever their length.)

    The rate is a linear recurrence, so what came before acts by one number, which fades by a power. Ticks are
    summed into minutes on the map side, minutes are scanned in spans in which no weight overflows, and each span takes over what is
    left of the two before it; what is older has a weight below exp(-80). Ticks without rows cost nothing.
    """
    counts = events.groupBy(label, floor_div(F.col(ts_ms), tick_ms).alias("_t")).agg(F.count("*").alias("_n"))
    firsts = counts.groupBy(label).agg(F.min("_t").alias("_t0")).withColumnRenamed(label, "_of")
    counts = lookup_join(counts.withColumn("_of", F.coalesce(F.col(label).cast("string"), F.lit("\x01"))),
                         firsts.withColumn("_of", F.coalesce(F.col("_of").cast("string"), F.lit("\x01"))), ["_of"], "left", ["_t"])
    minute, span = floor_div(F.col("_t"), TICKS), 40 * max(minutes)
    if span > 600 * min(minutes):
        raise ValueError("the longest rate may be 15 times the shortest")
    per_second = F.col("_n") * (1000.0 / tick_ms)
    fade = {m: 1.0 / m for m in minutes}  # by a minute, as an exponent
    local = []
    for m in minutes:
        part = 1 - math.exp(-fade[m] / TICKS)
        weight = F.when(F.col("_t") == F.col("_t0"), 1.0).otherwise(part)
        left = (minute + 1) * TICKS - 1 - F.col("_t")  # ticks to the end of the minute
        local.append(F.sum(per_second * weight * F.exp(left * (-fade[m] / TICKS))).alias(f"_l{m}"))
    blocks = counts.groupBy(label, minute.alias("_m")).agg(*local).withColumn("_s", floor_div(F.col("_m"), span))
    place = F.col("_m") - F.col("_s") * span
    inside = Window.partitionBy(label, "_s").orderBy("_m").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = blocks.select("*", *[F.sum(F.col(f"_l{m}") * F.exp(place * fade[m])).over(inside).alias(f"_p{m}") for m in minutes])
    ends = sums.groupBy(label, "_s").agg(*[(F.max_by(f"_p{m}", "_m") * math.exp(-(span - 1) * fade[m])).alias(f"_e{m}") for m in minutes])
    later = ends.select(label, F.explode(F.array(F.struct((F.col("_s") + 1).alias("s"), F.lit(1).alias("k")), F.struct((F.col("_s") + 2).alias("s"), F.lit(2).alias("k")))).alias("_to"), *[f"_e{m}" for m in minutes])
    carried = later.groupBy(F.col(label).alias("_of"), F.col("_to.s").alias("_in")).agg(
        *[F.sum(F.col(f"_e{m}") * F.exp((F.col("_to.k") - 1) * (-span * fade[m]))).alias(f"_c{m}") for m in minutes]
    )
    found = sums.join(carried, F.col(label).eqNullSafe(F.col("_of")) & (F.col("_s") == F.col("_in")), "left")
    place = F.col("_m") - F.col("_s") * span
    return found.select(
        label, (F.col("_m") * TICKS * tick_ms).alias("minute_ms"),
        *[(F.col(f"_p{m}") * F.exp(place * -fade[m]) + F.coalesce(f"_c{m}", F.lit(0.0)) * F.exp((place + 1) * -fade[m])).alias(f"rate_{m}") for m in minutes],
    )


def value_sketches(
    values: DataFrame, name: str = "name", value: str = "value", ts_ms: str = "ts_ms", width_ms: int = 60_000, k: int = SKETCH_K
) -> DataFrame:
    """Mergeable quantile sketches of any numbers by name and time: ``name, window_ms, n, min, max, sketch``.

    A row per name and window, built on the map side, whatever the number of values; NULL values are left out.
    """
    rows = values.where(F.col(value).isNotNull()).select(name, floor_div(F.col(ts_ms), width_ms).alias("_w"), F.col(value).cast("double").alias("_v"))
    return rows.groupBy(name, "_w").agg(
        F.count("*").alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"), F.kll_sketch_agg_double("_v", F.lit(k)).alias("sketch")
    ).select(name, (F.col("_w") * width_ms).alias("window_ms"), "n", "min", "max", "sketch")


def sketched_quantiles(sketches: DataFrame, by: Sequence[str], quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Quantiles over the sketches of a group, merged: ``by, n, min, max, q, value``.

    The share of values at or below ``value`` is within about 0.014 of ``q`` for sketches of the default size
    (with 99 % certainty); :func:`value_distribution` gives exact ones of whole numbers.
    """
    merged = sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    each = [
        F.struct(F.lit(float(q)).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("value")) for q in quantiles
    ]
    return merged.select(*by, "n", "min", "max", F.explode(F.array(*each)).alias("_q")).select(*by, "n", "min", "max", "_q.*")


def counter_totals(changes: DataFrame, name: str = "name", delta: str = "delta") -> DataFrame:
    """Value of each named counter after all its increments and decrements."""
    return changes.groupBy(name).agg(F.sum(delta).alias("value"))


def offset_ranges(
    messages: DataFrame, batch: Column, keys: Sequence[str] = ("topic", "partition"), offset: str = "offset"
) -> DataFrame:
    """Smallest and largest offset of every fetched group: the unit that is tracked."""
    return messages.groupBy(*keys, batch.alias("batch")).agg(
        F.min(offset).alias("min_offset"), F.max(offset).alias("max_offset"), F.count("*").alias("n")
    )


def value_distribution(
    values: DataFrame,
    name: str = "name",
    value: str = "value",
    quantiles: Sequence[float] = QUANTILES,
    block: int = 1 << 16,
) -> DataFrame:
    """Count, min, max, mean, standard deviation and exact quantiles of a bigint by name.

    A quantile is the smallest value with at least that share of the values at or below it.
    Values are cut into blocks of ``block`` neighbours, which are summed on the map side; only
    the blocks that hold a wanted rank are looked into, where equal values are counted on the
    map side again. No name has to fit in one task, whatever its number of values. Values have to be
    whole numbers; others are refused, for their fractions would be lost.
    """
    kind = values.schema[value].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{value} has to be of whole numbers, not {kind}")
    rows = values.where(F.col(name).isNotNull() & F.col(value).isNotNull()).select(
        name, F.col(value).cast("bigint").alias("_v"), floor_div(F.col(value).cast("bigint"), block).alias("_block")
    )
    # values enter the sums by their place in the block, which keeps the sums exact
    place = (F.col("_v") - F.col("_block") * block).cast("double")
    blocks = rows.groupBy(name, "_block").agg(
        F.count("*").alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.sum(place).alias("_sum"),
        F.sum(place * place).alias("_squares"),
    )
    every = Window.partitionBy(name)
    before = every.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    origin = F.min("_block").over(every) * block
    placed = (
        blocks.withColumn("_origin", origin)
        .withColumn("_mean", F.col("_block") * block - F.col("_origin") + F.col("_sum") / F.col("_n"))
        .select(
            "*",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(every).alias("_total"),
            (F.sum(F.col("_mean") * F.col("_n")).over(every) / F.sum("_n").over(every)).alias("_center"),
        )
    )
    ranks = F.array(
        *[
            F.struct(
                F.lit(str(q)).alias("q"),
                F.greatest(F.ceil(F.lit(Decimal(str(q))) * F.col("_total")).cast("bigint"), F.lit(1)).alias("rank"),
            )
            for q in quantiles
        ]
    )
    wanted = (
        placed.select("*", F.inline(ranks))
        .where("rank > _before and rank <= _before + _n")
        .select(name, "_block", "q", F.expr("rank - _before").alias("rank"))
    )
    inside = Window.partitionBy(name, "_block").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    looked_into = rows.join(wanted.select(name, "_block").distinct(), [name, "_block"], "left_semi")
    counts = looked_into.groupBy(name, "_block", "_v").agg(F.count("*").alias("_n"))
    reached = counts.select(name, "_block", "_v", "_n", F.sum("_n").over(inside).alias("_cum"))
    picked = (
        wanted.join(reached, [name, "_block"])
        .where("rank <= _cum and rank > _cum - _n")
        .groupBy(name)
        .agg(*[F.max(F.when(F.col("q") == str(q), F.col("_v"))).alias(quantile_name(q)) for q in quantiles])
    )
    n = F.sum("_n")
    # spread inside the blocks and of the blocks around the common mean
    away = F.col("_mean") - F.col("_center")
    spread = F.sum(F.col("_squares") - F.col("_sum") * F.col("_sum") / F.col("_n")) + F.sum(away * away * F.col("_n"))
    stats = placed.groupBy(name).agg(
        n.alias("n"),
        F.min("_min").alias("min"),
        F.max("_max").alias("max"),
        F.max(F.col("_origin") + F.col("_center")).alias("mean"),
        F.sqrt(F.greatest(spread, F.lit(0.0)) / F.when(n > 1, n - 1)).alias("stddev"),
    )
    return stats.join(picked, name)


def quantile_name(q: float) -> str:
    return "p" + f"{q * 100:g}".replace(".", "_")
