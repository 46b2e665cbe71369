"""Text output: plain lines, hourly files, imported files, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.timekeys import date_text, hour_text


def write_lines(lines: DataFrame, path: str, line: str = "value", codec: str = "none", mode: str = "error") -> None:
    """One line per row. Rows without payload are not written; :func:`null_lines` reports them."""
    written = lines.where(F.col(line).isNotNull()).select(F.col(line).cast("string").alias("value"))
    written.write.mode(mode).option("compression", codec).text(path)


def null_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    return lines.where(F.col(line).isNull())


def clustered(rows: DataFrame, keys: Sequence[str], salt: Column | None = None, salts: int = 1) -> DataFrame:
    """Rows of a key together, without one task per key.

    By default Spark rebalances: small keys share a task and a heavy key is split at the
    advisory size. Where adaptive execution is off, give a salt to split by.
    """
    if salt is None:
        return rows.hint("rebalance", *[F.col(k) for k in keys])
    return rows.repartition(*[F.col(k) for k in keys], F.pmod(F.xxhash64(salt), F.lit(salts)))


def hourly(lines: DataFrame, *others: str) -> DataFrame:
    """``(topic, dt, hr, value)`` of the lines to be written, and what else is asked for."""
    return lines.where(F.col("line").isNotNull()).select(
        "topic",
        date_text(F.col("ts_ms")).alias("dt"),
        hour_text(F.col("ts_ms")).alias("hr"),
        F.col("line").alias("value"),
        *others,
    )


def write_hourly(
    lines: DataFrame,
    path: str,
    codec: str = "gzip",
    mode: str = "append",
    max_rows: int = 0,
    salt: str | None = None,
    salts: int = 8,
) -> None:
    """Lines ``(topic, ts_ms, line)`` below ``topic=/dt=/hr=``, compressed, one line per row.

    ``max_rows`` rolls a file after so many lines.
    """
    rows = hourly(lines, *([salt] if salt else []))
    spread = clustered(rows, ["topic", "dt", "hr"], F.col(salt) if salt else None, salts)
    writer = spread.select("topic", "dt", "hr", "value").write.mode(mode).partitionBy("topic", "dt", "hr")
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    writer.option("compression", codec).text(path)


def write_report(report: DataFrame, path: str, mode: str = "append") -> None:
    """A throughput report as CSV with a header."""
    report.write.mode(mode).option("header", True).csv(path)
