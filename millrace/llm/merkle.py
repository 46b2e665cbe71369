"""Merkle manifest of a dataset: a digest per document, source and dataset, and a proof for every document.

Blocks of ``BLOCK`` consecutive documents of a source are hashed in one task. The blocks then exchange
digests like a butterfly: in round r the groups of up to ``FANOUT`` neighbouring stretches of FANOUT**r
blocks swap their digests, one message a block and stretch, and every block hashes the parent itself. After
the last round each block has the root and all digests beside its own path, without a way down the tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.lines import LOWER, UPPER
from millrace.llm.tables import join_counted, stored

FANOUT = 16
BLOCK_LEVELS = 3
BLOCK = FANOUT**BLOCK_LEVELS
TAMPER_EVERY = 5


def field(value: Column) -> Column:
    """``-`` for NULL, else its length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.encode(F.concat(*map(field, columns)), "UTF-8"), 256)


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_for(n: int) -> int:
    """Levels above the leaves of a tree of n leaves: none for a lone leaf."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def rising(leaves: Sequence[str], levels: int) -> list[list[str]]:
    """The nodes of each level of a block, leaves first."""
    out = [list(leaves)]
    for _ in range(levels):
        below = out[-1]
        out.append([digest(below[k : k + FANOUT]) for k in range(0, len(below), FANOUT)])
    return out


def placed(leaves: DataFrame, source: str, order: Sequence[str]) -> DataFrame:
    """Add ``idx``, the place of a row among those of its source, and ``n_source``.

    The rows are sorted on all tasks and written in that order; a row's place is its place in its
    file plus the rows of the source in the files before, which are counted per file and source.
    """
    ordered = stored(leaves.orderBy(source, *order).select("*", F.monotonically_increasing_id().alias("at")), "merkle-order")
    rows = ordered.select("*", F.shiftright("at", 33).alias("part"))
    counts = rows.groupBy(source, "part").agg(F.count("*").alias("c"), F.min("at").alias("first"))
    of_source = Window.partitionBy(source)
    before = of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col(source).alias("_source"), F.col("part").alias("_part"), "first",
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"), F.sum("c").over(of_source).alias("n_source"),
    )
    same = F.col(source).eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part"))
    idx = F.col("before") + F.col("at") - F.col("first")
    return rows.join(counts, same).select(*leaves.columns, idx.alias("idx"), "n_source")


def block_roots(rows: DataFrame, source: str) -> DataFrame:
    """``(source, block, blocks, root)`` of the placed rows, block by block as they come sorted."""

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (name, block), total, leaves, _ in blocks_of(batches):
            top = rising(leaves, min(BLOCK_LEVELS, levels_for(total)))[-1][0]
            row = [[name], [block], [-(-total // BLOCK)], [top]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                ["source", "block", "blocks", "root"],
            )

    narrow = rows.select(F.col(source).alias("source"), "idx", "n_source", "leaf")
    return dealt(narrow).mapInArrow(roots, "source string, block bigint, blocks bigint, root string")


def dealt(rows: DataFrame) -> DataFrame:
    """Each block whole in one task, in order: at most BLOCK rows have one key."""
    block = F.floor(F.col("idx") / BLOCK).cast("bigint")
    return rows.withColumn("block", block).repartition("source", "block").sortWithinPartitions("source", "block", "idx")


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(source, block), n_source, leaves, rows`` of sorted batches; a block may span batches."""
    key, total, rows = None, 0, []
    for batch in batches:
        for row in batch.to_pylist():
            new = (row["source"], row["block"])
            if rows and new != key:
                yield key, total, [r["leaf"] for r in rows], rows
                rows = []
            key, total = new, row["n_source"]
            rows.append(row)
    if rows:
        yield key, total, [r["leaf"] for r in rows], rows


def butterfly(nodes: DataFrame, keys: Sequence[str], rounds: int) -> DataFrame:
    """Add to nodes ``(*keys, block, blocks, root)`` the digests beside their path, level by level.

    ``block`` counts the nodes of a key from 0 and ``blocks`` is their number. Afterwards ``root`` is the root over
    all of them, and ``lefts`` and ``rights`` hold, per level, the digests of the run before and after as one
    string each. Each of the ``rounds`` shuffles at most FANOUT rows per node, under the node
    they are for, so no task gets more of a key than of another.
    """
    empty = F.array().cast("array<string>")
    state = nodes.select(*keys, "block", "blocks", "root", empty.alias("lefts"), empty.alias("rights"))
    for r in range(rounds):
        state = exchanged(state, keys, FANOUT**r)
    return state


def exchanged(state: DataFrame, keys: Sequence[str], step: int) -> DataFrame:
    """One round: stretches of ``step`` blocks, FANOUT of them beside each other, learn each other's digests.

    Block number o of a stretch sends to number o of each other stretch. The last stretch may be
    shorter: its o-th block sends to every number that leaves the remainder o.
    """
    stretch = F.expr(f"block div {step}")
    sender = state.select(
        *keys, "block", "blocks", "root", "lefts", "rights", stretch.alias("mine"),
        F.expr(f"block % {step}").alias("o"), F.expr(f"(blocks + {step - 1}) div {step}").alias("stretches"),
    )
    sender = sender.select("*", F.expr(f"least({step}, blocks - mine * {step})").alias("size"))
    group = F.expr(f"mine div {FANOUT} * {FANOUT}")
    theirs = F.sequence(group, F.least(group + FANOUT, F.col("stretches")) - 1)
    sent = sender.select("*", F.explode(theirs).alias("to"))
    last = F.expr(f"least((to + 1) * {step}, blocks) - 1")
    begin = F.col("to") * step + F.col("o")
    targets = F.when(begin <= last, F.sequence(begin, last, F.col("size"))).otherwise(F.array().cast("array<bigint>"))
    sent = sent.select("*", F.explode(targets).alias("target"))
    own = F.col("target") == F.col("block")
    inbox = sent.groupBy(*keys, "target", "blocks", "stretches").agg(
        F.sort_array(F.collect_list(F.struct("mine", "root"))).alias("run"),
        F.max(F.when(own, F.struct("mine", "root", "lefts", "rights"))).alias("me"),
    )

    def beside(side) -> Column:
        return F.array_join(F.transform(F.filter("run", side), lambda m: m["root"]), "")

    left = beside(lambda m: m["mine"] < F.col("me.mine"))
    right = beside(lambda m: m["mine"] > F.col("me.mine"))
    inbox = inbox.select("*", left.alias("left"), right.alias("right"))
    grows = F.col("stretches") > 1
    parent = F.sha2(F.concat("left", "me.root", "right"), 256)
    return inbox.select(
        *keys, F.col("target").alias("block"), "blocks",
        F.when(grows, parent).otherwise(F.col("me.root")).alias("root"),
        F.when(grows, F.array_append("me.lefts", F.col("left"))).otherwise(F.col("me.lefts")).alias("lefts"),
        F.when(grows, F.array_append("me.rights", F.col("right"))).otherwise(F.col("me.rights")).alias("rights"),
    )


def proofs(rows: DataFrame, upper: DataFrame, id_kind: str) -> DataFrame:
    """Per row its leaf, subroot and root, the digest of its proof, and the root folded from the leaf it has now.

    ``upper`` brings one row per block; it travels to the block's rows as its first row.
    """
    body = rows.select("source", "idx", "n_source", "leaf", "doc_id", "now", F.lit(None).cast("string").alias("subroot"),
                       F.lit(None).cast("string").alias("root"), F.array().cast("array<string>").alias("lefts"),
                       F.array().cast("array<string>").alias("rights"))
    heads = upper.select(
        "source", (F.col("block") * BLOCK).alias("idx"), F.lit(0).cast("bigint").alias("n_source"), F.lit("").alias("leaf"),
        F.lit(None).cast(id_kind).alias("doc_id"), F.lit(None).cast("string").alias("now"), "subroot", "root", "lefts", "rights",
    )
    block = F.floor(F.col("idx") / BLOCK).cast("bigint")
    both = heads.unionByName(body).withColumn("block", block).repartition("source", "block")
    both = both.sortWithinPartitions("source", "block", "idx", "n_source")  # the head, with n_source 0, comes first

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, total, leaves, got in blocks_of(batches):
            head, members = got[0], got[1:]
            nodes = rising(leaves[1:], min(BLOCK_LEVELS, levels_for(total)))
            out = []
            for at, row in enumerate(members):
                path, beside, place = row["now"], [], at
                for level in nodes[:-1]:
                    run = place // FANOUT * FANOUT
                    left, right = "".join(level[run:place]), "".join(level[place + 1 : run + FANOUT])
                    beside += [left, right]
                    path, place = digest([left, path, right]), place // FANOUT
                for left, right in zip(head["lefts"], head["rights"]):
                    beside += [left, right]
                    path = digest([left, path, right])
                out.append((row["doc_id"], row["leaf"], head["subroot"], head["root"], digest(beside), path, path == head["root"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), shape)], schema=shape)

    schema = (f"doc_id {id_kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean")  # fmt: skip
    shape = pa.schema(
        [("doc_id", pa.string() if id_kind == "string" else pa.int64())]
        + [(n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
        + [("verified", pa.bool_())]
    )
    return both.mapInArrow(prove, schema)


def merkle_manifest(
    docs: DataFrame,
    doc: str = "doc_id",
    source: str = "source",
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    text: str = "text",
    tampered: Column | None = None,
) -> DataFrame:
    """A row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the digest of the ``columns``. The leaves of a source, by document id, make a tree with runs of FANOUT
    nodes, whose root is the subroot; the subroots, by source (NULL first), make the tree of the dataset.
    ``proof_sha256`` is over all digests beside the path from the leaf to the root. ``folded_root`` is the root
    recomputed from the document as it is now and those digests: where ``tampered`` holds, ``text`` is taken with A-Z
    in lower case. ``verified`` says whether that is the root.

    A hot source is many blocks of 4,096 documents; no task or group holds more. NULL columns have a digest of their own
    (``-``); a NULL source is a source, a NULL id comes first in it. Rows that repeat an id are ordered by their digest;
    identical rows are leaves of their own, each beside the other. An empty text differs from NULL. An empty
    table gives no rows. Only the named columns are read, so that no other names clash. Ids are read as
    bigint unless they are strings.
    """
    id_kind = "string" if docs.schema[doc].dataType.simpleString() == "string" else "bigint"
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    leaf = leaf_digest([F.col(c) for c in columns])
    later = leaf_digest([F.translate(text, UPPER, LOWER) if c == text else F.col(c) for c in columns])
    leaves = docs.select(
        F.col(doc).cast(id_kind).alias("doc_id"), F.col(source).cast("string").alias("source"), leaf.alias("leaf"),
        F.when(changed, later).alias("now"),
    )
    rows = placed(leaves, "source", ["doc_id", "leaf"])
    rows = rows.withColumn("now", F.coalesce("now", "leaf"))
    blocks = stored(block_roots(rows, "source"), "merkle-blocks")
    most = blocks.agg(F.max("blocks")).first()[0] or 1
    inner = stored(butterfly(blocks, ["source"], levels_for(most)), "merkle-inner")
    # the subroots are the blocks of the tree of the dataset
    subroots = inner.where("block = 0").select("source", F.col("root").alias("subroot"), "blocks")
    top = placed(subroots.withColumn("all", F.lit(0)), "all", ["source"])
    top = stored(top.select("source", "subroot", F.col("blocks").alias("n_blocks"), F.col("idx").alias("block"),
                            F.col("n_source").alias("blocks"), F.col("subroot").alias("root")), "merkle-top")
    whole = butterfly(top, [], levels_for(top.count()))
    roots = stored(
        top.select("source", "subroot", "n_blocks", "block")
        .join(whole.select("block", F.col("root").alias("top"), F.col("lefts").alias("tl"), F.col("rights").alias("tr")), "block")
        .select("subroot", "n_blocks", "top", "tl", "tr", F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none")),
        "merkle-roots",
    )
    named = inner.select(
        "*", F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none")
    ).drop("root", "blocks")
    upper = join_counted(named, roots, ["name", "none"], "n_blocks", [F.col("block")])
    upper = upper.select(
        "source", "block", "subroot", F.col("top").alias("root"),
        F.concat("lefts", "tl").alias("lefts"), F.concat("rights", "tr").alias("rights"),
    )
    return proofs(rows, upper, id_kind)


def every_fifth(doc: Column) -> Column:
    """Whether TAMPER_EVERY divides the CRC-32 of the decimal id."""
    return F.crc32(F.encode(doc.cast("string"), "UTF-8")) % TAMPER_EVERY == 0
