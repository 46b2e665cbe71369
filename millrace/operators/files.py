"""Growing text files read line by line with byte positions.

Positions count bytes and lines keep a carriage return, so positions add up to file sizes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.ids import file_range_id, split_dsid, parse_file_range
from millrace.functions.timekeys import floor_div
from millrace.operators.blocks import block_totals, running_from, running_totals
from millrace.operators.joins import lookup_join
from millrace.operators.ledger import DONE, RUN

# Width in bytes of the cells that lines and ranges of a file are matched in.
RANGE_CELL = 1 << 20
# A range is cut into spans of so many cells first, which keeps the lists short for any range.
SPAN_CELLS = 4096
# Bytes of a UTF-8 mark at the head of a file, which the text reader leaves out.
BYTE_MARK = 3
# Lines are placed in pieces of so many (a power of two) of the part of a file they were read from.
PIECE_BITS = 16

# --- listings and progress ---------------------------------------------------------------


def _on(left: DataFrame, right: DataFrame) -> list[str]:
    """Files are told apart by name space and path, where both tables have a name space."""
    return [c for c in ("ns", "file") if c in left.columns and c in right.columns]


def filter_files(listing: DataFrame, wanted: Callable[[Column], Column], path: str = "path") -> DataFrame:
    return listing.where(wanted(F.col(path)))


def sent_size(progress: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """Position of every file: its read increments added up, never above the listed size."""
    sent = progress.groupBy("ns", "file").agg(F.sum("delta").cast("bigint").alias("sent_size"))
    if listing is None:
        return sent
    on = _on(sent, listing)
    capped = F.least("sent_size", "size")  # least leaves out a NULL size
    return sent.join(listing.select(*on, "size"), on, "left").select("ns", "file", capped.alias("sent_size"))


def file_progress(listing: DataFrame, positions: DataFrame) -> DataFrame:
    """The listing with the recorded position of each file, 0 where there is none.

    A listing without ``ns`` is of one name space, and so have the positions to be.
    """
    on = _on(listing, positions)
    return listing.join(positions.select(*on, "sent_size"), on, "left").withColumn("sent_size", F.coalesce("sent_size", F.lit(0)))


def not_done_files(progress: DataFrame) -> DataFrame:
    return progress.where("size <> sent_size")


def done_files(progress: DataFrame) -> DataFrame:
    return progress.where("sent_size >= size")


def merge_distinct(new_files: DataFrame, recovery_files: DataFrame) -> DataFrame:
    """New files and files to recover, each once."""
    return new_files.union(recovery_files).distinct()


def files_to_read(progress: DataFrame, ranges: DataFrame, wanted: Callable[[Column], Column]) -> DataFrame:
    """Unfinished files that are wanted, and files with ranges to recover."""
    new = filter_files(not_done_files(progress), wanted, "file").select("file")
    return merge_distinct(new, ranges.select("file"))


# --- lines and positions -----------------------------------------------------------------


def _measures() -> dict[str, Column]:
    return {"start": F.col("bytes"), "line_no": F.lit(1)}


def _piece() -> Column:
    """A bounded piece of the part a line was read from: a part has as many lines as the reader's split has."""
    return F.struct("block", F.shiftright("seq", PIECE_BITS).alias("piece"))


def line_totals(lines: DataFrame) -> DataFrame:
    """Bytes and lines of every piece of a file, and those before it.

    Where the file size is known, a file that is three bytes longer than its lines has a byte
    mark at its head, which moves all its lines.
    """
    if "file_size" not in lines.columns:
        return block_totals(lines, ["file"], _piece(), _measures())
    size = F.max("file_size").alias("_size")
    totals = block_totals(lines, ["file"], _piece(), _measures(), [size])
    counted = F.sum("start").over(Window.partitionBy("file"))
    mark = F.when(F.col("_size") - counted >= BYTE_MARK - 1, BYTE_MARK).otherwise(0)
    return totals.withColumn("start_before", F.col("start_before") + mark)


def _with_end(placed: DataFrame) -> DataFrame:
    end = F.col("start") + F.col("bytes")
    if "file_size" in placed.columns:
        end = F.least(end, F.col("file_size"))  # the last line may lack its newline
    return placed.withColumn("end", end)


def line_offsets(lines: DataFrame) -> DataFrame:
    """Add ``start``, ``end`` and ``line_no`` (from 0) to lines ``(file, block, seq, bytes, ...)``.

    ``block`` is the start of the part of the file a line was read from, in which ``seq`` rises. Pieces of parts are
    summed first and each line is placed inside its piece, so no task has to hold a part.
    """
    totals = line_totals(lines)
    return _with_end(running_totals(lines, ["file"], ["seq"], _piece(), _measures(), totals))


def read_new_lines(lines: DataFrame, positions: DataFrame, closed: bool = False) -> DataFrame:
    """Whole lines at or after the recorded position of their file.

    Parts of a file that lie wholly before the position are dropped before any line moves. A last
    line without newline may still grow: it is held back, and read whole once its newline is
    there. ``closed`` files grow no more, and their last line is read as it is.
    """
    open_parts = (
        line_totals(lines)
        .join(positions.select("file", "sent_size"), "file", "left")
        .withColumn("sent_size", F.coalesce("sent_size", F.lit(0)))
        .where("start_before + start > sent_size")
        .select("file", "_block", "sent_size", "start_before", "line_no_before")
    )
    # file and part are unique together, so this join has no heavy key
    unread = lines.withColumn("_block", _piece()).join(open_parts, ["file", "_block"])
    placed = running_from(unread, ["file"], ["seq"], _measures())
    if "file_size" in lines.columns and not closed:
        placed = placed.where("start + bytes <= file_size")
    return _with_end(placed).where("start >= sent_size").drop("sent_size")


def batch_lines(placed: DataFrame, size: int, first: Column | None = None) -> DataFrame:
    """Consecutive lines of a file in groups of ``size``: start, end and the lines in order.

    ``first`` is the line number that opens the first batch of the file (0 by default).
    """
    number = F.col("line_no") if first is None else F.col("line_no") - first
    items = F.sort_array(F.collect_list(F.struct("line_no", "value")))
    return (
        placed.groupBy("file", floor_div(number, size).alias("batch"))
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.count("*").alias("n"),
            items.alias("_items"),
        )
        .withColumn("lines", F.transform("_items", lambda i: i["value"]))
        .drop("_items")
    )


def read_ranges(placed: DataFrame, ranges: DataFrame, cell: int = RANGE_CELL) -> DataFrame:
    """Lines inside the given ``[start,end)`` ranges of their file, once per range.

    Lines and ranges meet in cells of the file, so even a file with very many of both is
    matched cell by cell on many tasks.
    """
    span = SPAN_CELLS * cell
    spans = F.sequence(floor_div(F.col("start"), span), floor_div(F.col("end") - 1, span))
    first = F.greatest(floor_div(F.col("range_start"), cell), F.col("_span") * SPAN_CELLS)
    last = F.least(floor_div(F.col("range_end") - 1, cell), F.col("_span") * SPAN_CELLS + SPAN_CELLS - 1)
    wanted = (
        ranges.where("end > start")
        .select(
            "file",
            F.col("start").alias("range_start"),
            F.col("end").alias("range_end"),
            F.explode(spans).alias("_span"),
        )
        .select("file", "range_start", "range_end", F.explode(F.sequence(first, last)).alias("_cell"))
    )
    held = placed.withColumn("_cell", floor_div(F.col("start"), cell))
    return held.join(wanted, ["file", "_cell"]).where("start >= range_start and end <= range_end").drop("_cell")


# --- ranges kept in the ledger -----------------------------------------------------------


def range_units(batches: DataFrame, ns: str) -> DataFrame:
    """Line batches as units ``(ds, id)`` of the ledger."""
    unit = file_range_id(F.lit(ns), F.col("file"), F.col("start"), F.col("end"))
    return batches.select(F.lit(ns).alias("ds"), unit.alias("id"))


def tracked_ranges(state: DataFrame) -> DataFrame:
    """Units of the ledger as file ranges ``(ns, file, start, end, status)``."""
    part = parse_file_range(split_dsid(F.col("dsid"))["id"])
    return state.select(part.alias("_r"), "status").select("_r.*", "status")


def recoverable_ranges(tracked: DataFrame, listing: DataFrame) -> DataFrame:
    """Ranges left in ``run`` whose file is still there, to be read before anything new."""
    left = tracked.where(F.col("status") == RUN)
    on = _on(left, listing)
    return lookup_join(left, listing.select(*on), on, "left_semi", ["start", "end"])


def ranges_by_file(ranges: DataFrame, cell: int = RANGE_CELL) -> DataFrame:
    """Ranges of a file in order, one row per cell of the file so that no list is unbounded."""
    items = F.sort_array(F.collect_list(F.struct("start", "end")))
    return ranges.groupBy("file", floor_div(F.col("start"), cell).alias("part")).agg(
        F.count("*").alias("n"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        items.alias("ranges"),
    )


def deletable_files(progress: DataFrame, tracked: DataFrame) -> DataFrame:
    """Files that are fully sent, have a ``done`` range and none left in ``run``."""
    on = _on(progress, tracked)
    seen = tracked.groupBy(*on).agg(
        F.max(F.col("status") == RUN).alias("_open"), F.max(F.col("status") == DONE).alias("_closed")
    )
    finished = seen.where("_closed and not _open").select(*on)
    return done_files(progress).join(finished, on, "left_semi")
