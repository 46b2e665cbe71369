"""Join many rows to a lookup table whose size is checked, not assumed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.session import new_folder

SALTS = 32


def broadcast_limit(table: DataFrame) -> int:
    return table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def fits_broadcast(table: DataFrame) -> bool:
    """Whether Catalyst's upper estimate of the table is within the session's broadcast limit."""
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= broadcast_limit(table)


def settled(table: DataFrame) -> DataFrame:
    """The table with a size that is known.

    The estimate of a derived table is that of all it is derived from: the few topics of a
    very large stream look as large as the stream. Such a table is written once to the shared
    folder, which gives its true size and spares computing it again.
    """
    if broadcast_limit(table) < 0 or fits_broadcast(table):
        return table
    folder = new_folder(table.sparkSession, "lookup")
    table.write.parquet(folder)
    return table.sparkSession.read.schema(table.schema).parquet(folder)


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread: Sequence[str] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows``, whose keys may be very uneven, to ``table``.

    A table within the broadcast limit is broadcast and the rows stay where they are. A larger
    one is copied once per salt, and the rows of one key are spread over the salts by the
    ``spread`` columns, so that no key fills one task.
    """
    on, table = list(on), settled(table)
    if fits_broadcast(table):
        return rows.join(F.broadcast(table), on, how)
    if not spread:
        return rows.join(table, on, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
