"""Chat formatting: keep the longest log of every conversation and render it as one text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.timekeys import floor_div
from millrace.llm.merkle import placed
from millrace.llm.tables import stored
from millrace.operators.blocks import running_totals
from millrace.operators.joins import lookup_join

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
BLOCK_TURNS = 4096  # turns of a conversation that one task sums up at a time
PART_TURNS = 1024  # turns of a conversation that are rendered into one text
SLICE_ROWS = 4096  # different rows of a part that are rendered into one text
SUMS = ["s1", "s2", "s3", "s4"]


def turn_rows(logs: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return logs.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"),
        F.coalesce(F.col(turn), F.lit(-1)).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """Rolling hash of every conversation up to each of its turns: ``conv, turn, s1 .. s4``.

    The hash of a prefix is the sum of the hashes of its turns (with their numbers), kept as four
    sums of 32 bits. Sums can be taken in blocks, so no conversation has to fit in a task, and
    rows logged twice are made one before.
    """
    hashed = turns.select(
        "conv",
        "turn",
        F.xxhash64("turn", "role", "text").alias("h1"),
        F.xxhash64(F.lit("2"), "turn", "role", "text").alias("h2"),
    ).distinct()
    low, high = lambda h: F.col(h).bitwiseAND(F.lit(0xFFFFFFFF)), lambda h: F.shiftrightunsigned(F.col(h), 32)
    pieces = [low("h1"), high("h1"), low("h2"), high("h2")]
    per_turn = hashed.groupBy("conv", "turn").agg(*[F.sum(p).alias(f"t{k}") for k, p in enumerate(pieces, 1)])
    block = floor_div(F.col("turn"), BLOCK_TURNS)
    measures = {s: F.col(f"t{k}") for k, s in enumerate(SUMS, 1)}
    summed = running_totals(per_turn, ["conv"], ["turn"], block, measures)
    return summed.select("conv", "turn", *[(F.col(s) + F.col(f"t{k}")).alias(s) for k, s in enumerate(SUMS, 1)])


def maximal(turns: DataFrame) -> DataFrame:
    """``conv, n_logs`` of the conversations that are not the beginning of a longer one.

    A conversation begins another if the other has a turn with the same number and the same
    prefix hash and goes on. Of equal conversations the one with the smallest id stays; ``n_logs``
    is how many were equal. Both sides of the anti-join have one row per prefix.
    """
    every = prefixes(turns)
    ends = every.groupBy("conv").agg(F.max(F.struct("turn", *SUMS)).alias("end"))
    key = ["turn", *SUMS]
    ended = ends.select("conv", "end.*").groupBy(*key).agg(F.min("conv").alias("conv"), F.count("*").alias("n_logs"))
    passed = every.groupBy(*key).agg(F.count("*").alias("n_passed"))
    on = [F.col(f"e.{k}") == F.col(f"p.{k}") for k in key] + [F.col("p.n_passed") > F.col("e.n_logs")]
    return ended.alias("e").join(passed.alias("p"), on, "left_anti").select("conv", "n_logs")


def escaped(text: Column) -> Column:
    """A marker inside a text must not end its turn."""
    return F.regexp_replace(text, r"<\|(im_start|im_end)\|>", r"<\\|$1|>")


def sliced(turns: DataFrame, slice_rows: int) -> DataFrame | None:
    """Add ``slice`` (None if no part needs it): 0, but in parts with more than ``slice_rows`` different rows the place of a row among them,
    by so many. Only rows of such parts are sorted for that: of one turn number with very many texts, say."""
    hashed = turns.select("conv", "part", "turn", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("2"), "role", "text").alias("h2"))
    heavy = hashed.distinct().groupBy("conv", "part").agg(F.count("*").alias("n")).where(F.col("n") > slice_rows)
    heavy = stored(heavy, "heavy-parts")
    if heavy.isEmpty():
        return None
    marked = lookup_join(turns, heavy.select("conv", "part", F.lit(True).alias("many")), ["conv", "part"], "left", ["turn", "role", "text"])
    many = marked.where("many").select(F.struct("conv", "part").alias("key"), "turn", "role", "text").distinct()
    ranked = placed(many, "key", ["turn", "role", "text"])
    cut = ranked.select("key.*", "turn", "role", "text", floor_div(F.col("idx"), slice_rows).alias("slice"))
    few = marked.where("many is null").drop("many").withColumn("slice", F.lit(0).cast("bigint"))
    return few.unionByName(cut)


def format_chats(
    logs: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part_turns: int = PART_TURNS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Collapse logged conversations to maximal ones and render them.

    Returns ``conv`` (named as in ``logs``), ``part``, ``slice``, ``n_turns``, ``n_logs`` and ``chat``. A chat is
    rendered in parts of ``part_turns`` turn numbers, and a part with more than ``slice_rows`` different rows in
    slices of so many, so that neither a very long chat nor a turn number with very many texts is one value or one task;
    usual ones have part 0 and slice 0 alone. Joined in order they are the whole chat. The rows are
    gathered by part and slice where they are read and move once.

    Turn numbers, roles and texts make two conversations equal. A row logged twice counts once;
    different rows of one turn are ordered by role and text. NULL role and text are empty, a NULL
    turn comes first (-1), rows without conversation id belong to none and are left out. An
    empty table gives an empty table; other columns are ignored.
    """
    turns = turn_rows(logs, conv, turn, role, text)
    numbered = turns.withColumn("part", F.greatest(floor_div(F.col("turn"), part_turns), F.lit(0)))
    cut = sliced(numbered, slice_rows)
    key = ["conv", "part"] if cut is None else ["conv", "part", "slice"]
    numbered = numbered if cut is None else cut
    parts = numbered.groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    # a few numbers per part: those of one conversation may meet in one task
    wanted = numbered.select(*key).distinct().join(maximal(turns), "conv")
    one = lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), escaped(t["text"]), F.lit(CLOSE + "\n"))
    return parts.join(wanted, key).select(
        F.col("conv").alias(conv),
        "part",
        F.lit(0).cast("bigint").alias("slice") if cut is None else F.col("slice"),
        F.size("turns").cast("bigint").alias("n_turns"),
        "n_logs",
        F.array_join(F.transform("turns", one), "").alias("chat"),
    )
