"""The run/done ledger.

Changes are appended as events ``(dsid, status, ts, at)``: ``ts`` is the time of the unit,
``at`` the time of the change, and a NULL status is a removal. The current state, one row
``(dsid, status, ts)`` per unit, is derived by an aggregation with map-side combine.
"""

from __future__ import annotations

import bisect
import functools
import itertools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.functions.ids import SEPARATOR, ds_prefix, make_dsid, split_dsid

RUN, DONE = "run", "done"
PAGE_ROWS = 100
# A page is taken from the first so many rows of a range; ranges are cut by so many sampled ids.
RANGE_ROWS = 10_000
SPLITS = 256
BUCKETS = 16
MAX_TOUCHED = 1000
STATE = ("dsid", "status", "ts")
EVENT = (*STATE, "at")


def last_events(events: DataFrame) -> DataFrame:
    """The last change of every unit. Of changes at the same instant a removal counts most, then done."""
    rank = F.struct("at", F.col("status").isNull().alias("gone"), (F.col("status") == DONE).alias("done"), "ts")
    newest = F.max_by(F.struct("status", "ts", "at"), rank)
    return events.groupBy("dsid").agg(newest.alias("_last")).select("dsid", "_last.*")


def latest_state(events: DataFrame) -> DataFrame:
    """Status and time of every unit after its last change; removed units have none."""
    return last_events(events).where(F.col("status").isNotNull()).select(*STATE)


# --- reading -----------------------------------------------------------------------------


def deserialized(state: DataFrame) -> DataFrame:
    """State rows with the dsid taken apart: ds, ids, status, ts."""
    parts = split_dsid(F.col("dsid"))
    return state.select(parts["ds"].alias("ds"), parts["id"].alias("ids"), "status", "ts")


def of_source(state: DataFrame, ds: str) -> DataFrame:
    return state.where(F.col("dsid").startswith(ds_prefix(ds)))


def _range_of(column: Column, splits: list[str], first: int = 0) -> Column:
    """How many of the sorted split keys are not above a value, by halving."""
    if not splits:
        return F.lit(first)
    middle = len(splits) // 2
    return F.when(column < splits[middle], _range_of(column, splits[:middle], first)).otherwise(
        _range_of(column, splits[middle + 1 :], first + middle + 1)
    )


def page(state: DataFrame, start: int = 0, rows: int = PAGE_ROWS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows ``start+1 .. start+rows`` in the order dsid, ts, status.

    The page is found by rank: units are counted by ranges between sampled ids, and only the ranges
    that hold the page are looked at further, until the page is among the first ``range_rows`` rows. Each
    round leaves about one range of ``SPLITS``, and nothing but the last one is sorted, so a page
    costs a few scans, however far down it is.
    """
    key, here, skip = F.col("dsid"), state, start
    while skip + rows > range_rows:
        sampled = here.select("dsid").orderBy(F.xxhash64("dsid"), "dsid").limit(SPLITS - 1).collect()
        splits = sorted({r["dsid"] for r in sampled})
        counted = here.groupBy(_range_of(key, splits).alias("r")).agg(F.count("*").alias("n")).collect()
        counts = {r["r"]: r["n"] for r in counted}
        ends = list(itertools.accumulate(counts.get(k, 0) for k in range(len(splits) + 1)))
        if skip >= ends[-1]:
            return state.limit(0)
        first, last = (bisect.bisect_right(ends, place) for place in (skip, min(skip + rows, ends[-1]) - 1))
        if first == 0 and last == len(splits):
            break
        skip -= ends[first - 1] if first else 0
        if first:
            here = here.where(key >= splits[first - 1])
        if last < len(splits):
            here = here.where(key < splits[last])
        if sum(counts.get(k, 0) for k in range(first, last + 1)) == ends[-1]:
            break  # one id has all the rows
    return here.orderBy("dsid", "ts", "status").offset(skip).limit(rows)


def select_messages(
    state: DataFrame, where: str | Column | None = None, start: int = 0, rows: int = PAGE_ROWS
) -> DataFrame:
    """A page of the units that meet a condition in SQL text or as a column."""
    return page(state if where is None else state.where(where), start, rows)


def get_message(state: DataFrame, dsid: str) -> DataFrame:
    return state.where(F.col("dsid") == dsid)


def select_ds_messages(
    state: DataFrame, ds: str, status: str = RUN, rows: int = PAGE_ROWS
) -> DataFrame:
    """The first units of one source in one status."""
    return page(of_source(state, ds).where(F.col("status") == status), 0, rows)


def replay_run(state: DataFrame, ds: str) -> DataFrame:
    """Every unit of a source still in ``run``, to be sent again after a restart."""
    return deserialized(of_source(state, ds).where(F.col("status") == RUN))


def processor_replay(state: DataFrame, ds: str, listing: DataFrame, path: str = "path") -> DataFrame:
    """Rolled files of a source still in ``run`` that are there to be sent."""
    waiting = replay_run(state, ds)
    return waiting.join(listing.select(F.col(path).alias("ids")), "ids", "left_semi")


def status_counts(state: DataFrame, ds: str) -> DataFrame:
    return of_source(state, ds).groupBy("status").agg(F.count("*").alias("n"))


# --- changes -----------------------------------------------------------------------------


def _dsids(units: DataFrame) -> DataFrame:
    """``units(ds, id)`` or ``units(dsid)`` as dsids."""
    if "dsid" in units.columns:
        return units.select("dsid")
    return units.select(make_dsid(F.col("ds"), F.col("id")).alias("dsid"))


def mark_run(state: DataFrame, units: DataFrame, ts: Column, at: Column | None = None) -> DataFrame:
    """Events that put new units into ``run``; units the ledger knows give none."""
    fresh = _dsids(units).distinct().join(state.select("dsid"), "dsid", "left_anti")
    return fresh.select("dsid", F.lit(RUN).alias("status"), ts.alias("ts"), (ts if at is None else at).alias("at"))


def duplicate_units(state: DataFrame, units: DataFrame) -> DataFrame:
    """Units that cannot be put into ``run``: known already, or wanted more than once."""
    wanted = _dsids(units).groupBy("dsid").agg(F.count("*").alias("n"))
    known = state.select("dsid", F.lit(True).alias("known"))
    marked = wanted.join(known, "dsid", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return marked.where("known or n > 1")


def dedup_units(units: DataFrame) -> DataFrame:
    """The same unit once."""
    return _dsids(units).dropDuplicates(["dsid"])


def dedup_units_stream(units: DataFrame, ts: str = "ts", within: str = "1 hour") -> DataFrame:
    """The same unit once on an endless stream, if its repeats come within a time of each other.

    ``units(ds, id, ts)`` or ``units(dsid, ts)``. The state holds a unit for that time after its first ``ts`` only,
    so its size is what arrives in that time, not all that ever came. A unit that comes again later
    is known to the ledger by then (:func:`mark_run`).
    """
    dsid = F.col("dsid") if "dsid" in units.columns else make_dsid(F.col("ds"), F.col("id"))
    timed = units.select(dsid.alias("dsid"), F.col(ts).alias(ts)).withWatermark(ts, within)
    return timed.dropDuplicatesWithinWatermark(["dsid"])


def mark_done(state: DataFrame, units: DataFrame, at: Column, strict: bool = False) -> DataFrame:
    """Events that take units from ``run`` to ``done``; the time of the unit stays.

    Units in any other state give no event, or with ``strict`` stop the job.
    """
    wanted = _dsids(units).distinct()
    found = wanted.join(state, "dsid", "left" if strict else "inner")
    running = F.coalesce(F.col("status") == RUN, F.lit(False))
    if strict:
        bad = F.raise_error(F.concat(F.lit("cannot be marked done, it is not in run: "), F.col("dsid")))
        running = F.when(running, True).otherwise(bad.cast("boolean"))
    return found.where(running).select("dsid", F.lit(DONE).alias("status"), "ts", at.alias("at"))


def invalid_transitions(state: DataFrame, units: DataFrame) -> DataFrame:
    """Units that cannot be marked done, with the state they are in (NULL: unknown)."""
    found = _dsids(units).distinct().join(state.select("dsid", "status"), "dsid", "left")
    return found.where(F.col("status").isNull() | (F.col("status") != RUN))


def update_message(state: DataFrame, units: DataFrame, at: Column, **values: Column) -> DataFrame:
    """Events that set fields of units without looking at their state."""
    changed = state.join(_dsids(units).distinct(), "dsid", "left_semi")
    fields = [values.get(c, F.col(c)).alias(c) for c in ("status", "ts")]
    return changed.select("dsid", *fields, at.alias("at"))


def delete_message(state: DataFrame, units: DataFrame, at: Column) -> DataFrame:
    """Events that remove units."""
    removed = state.join(_dsids(units).distinct(), "dsid", "left_semi")
    return removed.select("dsid", F.lit(None).cast("string").alias("status"), "ts", at.alias("at"))


def apply_events(state: DataFrame, events: DataFrame, before: Column) -> DataFrame:
    """State after events; ``before`` is an instant ahead of all of them."""
    known = state.select(*STATE, before.alias("at"))
    return latest_state(known.unionByName(events.select(*EVENT)))


def expire(state: DataFrame, cutoff: Column) -> DataFrame:
    """State without the units whose time is at or before the cutoff."""
    return state.where(F.col("ts") > cutoff)


def expire_after(state: DataFrame, now: Column, retention: str = "INTERVAL 28 DAYS") -> DataFrame:
    """State without the units as old as the retention or older."""
    return expire(state, now - F.expr(retention))


# --- storage -----------------------------------------------------------------------------


class LedgerTable:
    """Events in a shared folder: ``<path>/v=<version>/batch=<name>``.

    A batch is written under its own name and replaced when it is written again, so a retried
    job leaves the ledger as one run would. ``compact`` and ``expire`` write the state as the
    next version and are for one owner at a time; readers take the newest finished version. An
    owner may have the table compacted after every ``compact_every`` batches, which bounds the
    folders that are listed and the events that are read; a batch that is repeated after that
    finds its units changed already and adds nothing.

    What a compaction writes, ``batch=base``, is laid out by source and by ``buckets`` of the unit's hash. Marking
    units reads only the folders of their own sources and buckets, and the batches since; so does the
    state of one source.
    """

    SCHEMA = "dsid string, status string, ts timestamp, at timestamp"
    PLACE = "src string, bucket int"

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 0, buckets: int = BUCKETS):
        self.spark, self.path, self.compact_every, self.buckets = spark, path.rstrip("/"), compact_every, buckets

    def _place(self, rows: DataFrame) -> DataFrame:
        """Rows with the source of their unit (a partition has no empty name) and its bucket."""
        bucket = F.pmod(F.xxhash64("dsid"), F.lit(self.buckets)).cast("int")
        return rows.withColumn("src", F.nullif(F.substring_index("dsid", SEPARATOR, 1), F.lit(""))).withColumn("bucket", bucket)

    def _glob(self, pattern: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return [status.getPath() for status in found]

    def _version(self) -> int:
        marks = self._glob("v=*/batch=base/_SUCCESS")
        names = [m.getParent().getParent().getName() for m in marks]
        return max((int(n.removeprefix("v=")) for n in names), default=0)

    def append(self, events: DataFrame, batch: str) -> None:
        fields = StructType.fromDDL(self.SCHEMA)
        rows = events.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        version = self._version()
        rows.write.mode("overwrite").parquet(f"{self.path}/v={version}/batch={batch}")
        if self.compact_every and len(self._glob(f"v={version}/batch=*/_SUCCESS")) > self.compact_every:
            self.compact()

    def events(self, without: str | None = None, where: Column | None = None) -> DataFrame:
        """All events, or those of the other batches when one is about to be written again. ``where`` is a
        condition on ``src`` and ``bucket`` that picks the folders of the base to read."""
        version = self._version()
        folders = [f.getParent() for f in self._glob(f"v={version}/batch=*/_SUCCESS")]
        names = {f.getName(): f.toString() for f in folders if f.getName() != f"batch={without}"}
        base = names.pop("batch=base", None)
        reader = self.spark.read
        parts = [reader.schema(self.SCHEMA).parquet(*names.values())] if names else []
        if base:
            if not self._glob(f"v={version}/batch=base/src=*"):  # empty, or of a table without this layout
                parts.append(reader.schema(self.SCHEMA).parquet(base))
            else:
                laid = reader.schema(f"{self.SCHEMA}, {self.PLACE}").parquet(base)
                parts.append((laid if where is None else laid.where(where)).select(*EVENT))
        if not parts:
            return self.spark.createDataFrame([], self.SCHEMA)
        return functools.reduce(DataFrame.unionByName, parts)

    def _touched(self, units: DataFrame) -> Column | None:
        """The folders of the base that units are in; None where they are too many to name."""
        placed = self._place(_dsids(units)).select("src", "bucket").distinct().limit(MAX_TOUCHED + 1).collect()
        if len(placed) > MAX_TOUCHED:
            return None
        by_source: dict[str | None, list[int]] = {}
        for row in placed:
            by_source.setdefault(row["src"], []).append(row["bucket"])
        tests = [F.col("src").eqNullSafe(F.lit(s)) & F.col("bucket").isin(b) for s, b in sorted(by_source.items(), key=str)]
        return functools.reduce(Column.__or__, tests, F.lit(False))

    def _batch_folders(self, batch: str) -> list[str]:
        return [f.getParent().toString() for f in self._glob(f"v=*/batch={batch}/_SUCCESS")]

    def has(self, batch: str) -> bool:
        """Whether a batch was written, in this version or before a compaction."""
        return bool(self._batch_folders(batch))

    def batch(self, batch: str) -> DataFrame:
        """The events of one batch."""
        folders = self._batch_folders(batch)
        if not folders:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*folders)

    def state(self, without: str | None = None, ds: str | None = None) -> DataFrame:
        """The state of all units, or of those of one source."""
        if ds is None:
            return latest_state(self.events(without))
        return of_source(latest_state(self.events(without, F.col("src").eqNullSafe(F.nullif(F.lit(ds), F.lit(""))))), ds)

    def _state_of(self, units: DataFrame, batch: str) -> DataFrame:
        return latest_state(self.events(batch, self._touched(units)))

    def mark_run(self, units: DataFrame, at: Column, batch: str) -> None:
        self.append(mark_run(self._state_of(units, batch), units, at), batch)

    def mark_done(self, units: DataFrame, at: Column, batch: str) -> None:
        self.append(mark_done(self._state_of(units, batch), units, at), batch)

    def _next_version(self, keep: Column) -> None:
        """The last change of every unit that is kept, with its moment, as the next version."""
        live = last_events(self.events()).where(F.col("status").isNotNull() & keep)
        placed = self._place(live.select(*EVENT)).hint("rebalance", F.col("src"), F.col("bucket"))
        writer = placed.write.mode("overwrite").partitionBy("src", "bucket")
        writer.parquet(f"{self.path}/v={self._version() + 1}/batch=base")

    def compact(self) -> None:
        """Start a version that holds the last event of every unit in place of all its events."""
        self._next_version(F.lit(True))

    def expire(self, cutoff: Column) -> None:
        self._next_version(F.col("ts") > cutoff)
