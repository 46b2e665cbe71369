"""Line dedup: drop lines that many documents share. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import join_counted, stored

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_DOCS = 10
MIN_CHARS = 1


def line_key(line: Column) -> Column:
    """What makes two lines equal: the line without white space at its ends, A-Z as a-z."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def hash_pair(value: Column, name: str) -> list[Column]:
    """128 bits of hash as two columns ``<name>1`` and ``<name>2``."""
    return [F.xxhash64(value).alias(f"{name}1"), F.xxhash64(F.lit("2"), value).alias(f"{name}2")]


def exploded(docs: DataFrame, doc: str, text: str, min_chars: int) -> DataFrame:
    """One row per line that can be dropped: document, hash of its text, position, hash of the key."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(
        F.col(doc).alias("doc"), *hash_pair(whole, "t"), F.posexplode(F.split(whole, "\n", -1)).alias("pos", "line")
    )
    keyed = lines.select("doc", "t1", "t2", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= max(1, min_chars)).select(
        "doc", "t1", "t2", "pos", *hash_pair(F.col("key"), "h")
    )


def drop_shared_lines(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """Drop every line whose key is found in ``min_docs`` documents or more.

    Returns all columns of ``docs`` and ``n_lines``, ``n_dropped`` (bigint) and ``kept`` (string,
    the other lines joined by newline); columns of ``docs`` with these three names are replaced.

    Lines are hashed (128 bits) and made distinct per document first, so that a line found
    everywhere is a counter per task, not a list. The frequent hashes are written once. Positions
    of dropped lines meet their document again by id and hash of the text, and the text is put
    together by position where it stands: only ids, hashes and positions are exploded and shuffled.

    NULL or empty text is one empty line and comes back as ``''``. A key shorter than
    ``min_chars`` (at least 1) is never dropped. Documents are told apart by ``doc``: rows that
    repeat an id count once, every row is returned; rows with a NULL id count as one document.
    If all lines go, ``kept`` is ``''``. An empty table gives an empty table.
    """
    lines = exploded(docs, doc, text, min_chars)
    per_doc = lines.groupBy("h1", "h2", "doc").agg(F.count("*").alias("n"))
    counts = per_doc.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_rows"))
    frequent = stored(counts.where(F.col("n_docs") >= min_docs).drop("n_docs"), "frequent-lines")

    dropped = join_counted(lines, frequent, ["h1", "h2"], "n_rows", [F.col("doc"), F.col("t1"), F.col("pos")])
    positions = dropped.groupBy("doc", "t1", "t2").agg(F.collect_set("pos").alias("drop"))

    ours = ("n_lines", "n_dropped", "kept")
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.struct(*[c for c in docs.columns if c not in ours]).alias("row"),
        F.col(doc).alias("row_doc"),
        *hash_pair(whole, "row_t"),
    )
    same = (
        F.col("row_doc").eqNullSafe(F.col("doc"))
        & (F.col("row_t1") == F.col("t1"))
        & (F.col("row_t2") == F.col("t2"))
    )
    back = rows.join(positions, same, "left")
    text_again = F.coalesce(F.col("row")[text], F.lit(""))
    back = back.select("row", "drop", F.split(text_again, "\n", -1).alias("lines"))
    kept_positions = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop")
    rebuilt = F.array_join(F.transform(kept_positions, lambda p: F.get("lines", p)), "\n")
    return back.select(
        "row.*",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.coalesce(F.col("row")[text], F.lit(""))).otherwise(rebuilt).alias("kept"),
    )
