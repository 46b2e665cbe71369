"""Queries on growing files, with documents as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import ids
from millrace.operators import files as ops, trees
from millrace.plans.inputs import (
    BATCH_LINES,
    NS,
    ON_LINES,
    ON_PROGRESS,
    ON_RANGES,
    increments,
    lines,
    listing,
    listing_of_both,
)
from millrace.plans.registry import query, table


def positions(spark, sf_dir) -> DataFrame:
    return ops.sent_size(increments(spark, sf_dir), listing(spark, sf_dir))


def progress(spark, sf_dir) -> DataFrame:
    return ops.file_progress(listing_of_both(spark, sf_dir), positions(spark, sf_dir))


def placed(spark, sf_dir) -> DataFrame:
    return ops.line_offsets(lines(spark, sf_dir))


def batches(spark, sf_dir) -> DataFrame:
    return ops.batch_lines(placed(spark, sf_dir), BATCH_LINES)


def tracked(spark, sf_dir) -> DataFrame:
    """The ranges of all line batches, kept in the ledger and read back from their ids."""
    held = (F.col("file").cast("bigint") % 4 == 0) & (F.col("batch") % 2 == 0)
    status = F.when(held, "run").otherwise("done")
    unit = ids.file_range_id(F.lit(NS), F.col("file"), F.col("start"), F.col("end"))
    state = batches(spark, sf_dir).select(ids.make_dsid(F.lit(NS), unit).alias("dsid"), status.alias("status"))
    return ops.tracked_ranges(state)


def left_ranges(spark, sf_dir) -> DataFrame:
    """Open ranges to recover; beside those of the listed files there are some of a file that vanished."""
    known = tracked(spark, sf_dir)
    vanished = known.withColumn("file", F.concat(F.lit("gone-"), "file")).withColumn("status", F.lit("run"))
    ranges = ops.recoverable_ranges(known.unionByName(vanished), listing_of_both(spark, sf_dir))
    return ranges.select("file", "start", "end")


@query(ON_LINES + 'SELECT file, line_no, start, "end", value FROM lines')
def line_offsets(spark, sf_dir):
    return placed(spark, sf_dir).select("file", "line_no", "start", "end", "value")


@query(ON_PROGRESS + """
SELECT l.file, l.start, l."end", l.value FROM lines l JOIN progress p USING (file) WHERE l.start >= p.sent_size
""")
def read_new_lines(spark, sf_dir):
    new = ops.read_new_lines(lines(spark, sf_dir), positions(spark, sf_dir), closed=True)
    return new.select("file", "start", "end", "value")


@query(ON_RANGES + """
SELECT r.file, r.start AS range_start, r."end" AS range_end, l.start, l."end", l.value
FROM ranges r JOIN lines l ON l.file = r.file AND l.start >= r.start AND l."end" <= r."end" WHERE r.status = 'run'
""")
def read_ranges(spark, sf_dir):
    found = ops.read_ranges(placed(spark, sf_dir), left_ranges(spark, sf_dir), cell=4096)
    return found.select("file", "range_start", "range_end", "start", "end", "value")


@query(ON_RANGES + 'SELECT file, batch, start, "end", n, body FROM ranges')
def batch_lines(spark, sf_dir):
    return batches(spark, sf_dir).select(
        "file", "batch", "start", "end", "n", F.array_join("lines", "\n").alias("body")
    )


@query(ON_RANGES + """
SELECT 'documents' || chr(1) || file || chr(1) || start || chr(1) || "end" AS id, 'documents' AS ns, file, start, "end" FROM ranges
""")
def file_range_id(spark, sf_dir):
    unit = ids.file_range_id(F.lit(NS), F.col("file"), F.col("start"), F.col("end"))
    rows = batches(spark, sf_dir).select(unit.alias("id"))
    return rows.select("id", ids.parse_file_range(F.col("id")).alias("r")).select("id", "r.*")


@query(ON_PROGRESS + "SELECT 'documents' AS ns, file, sent_size FROM progress WHERE doc_id % 3 < 2")
def sent_size(spark, sf_dir):
    return positions(spark, sf_dir)


@query(ON_PROGRESS + "SELECT ns, file, size, sent_size FROM spaces")
def file_progress(spark, sf_dir):
    return progress(spark, sf_dir).select("ns", "file", "size", "sent_size")


@query(ON_PROGRESS + "SELECT ns, file, size, sent_size FROM spaces WHERE sent_size >= size")
def done_files(spark, sf_dir):
    return ops.done_files(progress(spark, sf_dir)).select("ns", "file", "size", "sent_size")


@query(ON_PROGRESS + "SELECT ns, file, size, sent_size FROM spaces WHERE sent_size <> size")
def not_done_files(spark, sf_dir):
    return ops.not_done_files(progress(spark, sf_dir)).select("ns", "file", "size", "sent_size")


@query(ON_RANGES + """SELECT file, start, "end" FROM ranges WHERE status = 'run'""")
def recoverable_ranges(spark, sf_dir):
    return left_ranges(spark, sf_dir)


@query(ON_RANGES + """
SELECT file, start // 4096 AS part, count(*) AS n, min(start) AS start, max("end") AS "end",
  string_agg(start || '-' || "end", ',' ORDER BY start) AS ranges
FROM ranges WHERE status = 'run' GROUP BY file, start // 4096
""")
def ranges_by_file(spark, sf_dir):
    grouped = ops.ranges_by_file(left_ranges(spark, sf_dir), cell=4096)
    pairs = F.transform("ranges", lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string")))
    return grouped.withColumn("ranges", F.array_join(pairs, ","))


@query(ON_RANGES + """
SELECT ns, file, size FROM spaces WHERE sent_size >= size AND ns = 'documents'
  AND file IN (SELECT file FROM ranges WHERE status = 'done') AND file NOT IN (SELECT file FROM ranges WHERE status = 'run')
""")
def deletable_files(spark, sf_dir):
    return ops.deletable_files(progress(spark, sf_dir), tracked(spark, sf_dir)).select("ns", "file", "size")


@query(ON_RANGES + """
SELECT file FROM spaces WHERE sent_size <> size
UNION SELECT file FROM ranges WHERE status = 'run'
""")
def merge_distinct(spark, sf_dir):
    wanted = lambda file: ~file.startswith("gone-")
    return ops.files_to_read(progress(spark, sf_dir), left_ranges(spark, sf_dir), wanted)


# --- paths ---------------------------------------------------------------------------------

PATHS = """WITH paths AS (
  SELECT CAST(page_id AS VARCHAR) AS value,
    '/' || array_to_string(list_filter(string_split('urls/' || url, '/'), lambda s: s <> ''), '/') AS path
  FROM pages)
"""


def paths(spark, sf_dir) -> DataFrame:
    path = ids.join_path(F.lit("urls/"), F.col("url"))
    return table(spark, sf_dir, "pages").select(path.alias("path"), F.col("page_id").cast("string").alias("value"))


@query(PATHS + "SELECT path, value FROM paths")
def clean_path(spark, sf_dir):
    return paths(spark, sf_dir)


@query(PATHS + """
SELECT DISTINCT split_part(path, '/', 4) AS child FROM paths WHERE starts_with(path, '/urls/https:/')
""")
def list_children(spark, sf_dir):
    return trees.list_children(paths(spark, sf_dir), "/urls/https:")


@query(PATHS + """, steps AS (
  SELECT list_filter(string_split(path, '/'), lambda s: s <> '') AS s, value FROM paths),
nodes AS (
  SELECT '/' || array_to_string(s[1:1 + level], '/') AS path, level, s[1 + level] AS name,
    max(CASE WHEN level = len(s) - 1 THEN value END) AS value, max(CASE WHEN level < len(s) - 1 THEN 1 ELSE 0 END) AS has_children
  FROM steps, (SELECT unnest([1, 2, 3]) AS level) WHERE level <= len(s) - 1 GROUP BY 1, 2, 3)
SELECT path, level, name, has_children, CASE WHEN has_children = 0 OR level = 3 THEN value END AS value FROM nodes
""")
def path_tree(spark, sf_dir):
    tree = trees.path_tree(paths(spark, sf_dir), "/urls", depth=3)
    return tree.withColumn("has_children", F.col("has_children").cast("int"))
