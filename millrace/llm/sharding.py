"""Sharding: linked documents meet in one shard by balanced label propagation. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.lines import hash_pair
from millrace.llm.tables import join_counted, stored, unstored
from millrace.operators.blocks import running_totals

SHARDS = 16
ROUNDS = 20
HOT_ROWS = 1 << 16  # a link with more members is dealt over SALTS tasks and numbered in several blocks
SALTS = 64
SLACK = 16  # while documents move, a shard may be fuller by one part in so many
LEVELS, PLACES = 8, 32  # candidates of two shards are admitted by so many levels of gain and hash places
FINE = 1 << 20  # of the last place that fits, members are admitted by so many parts


def move_quotas(wanted: Sequence[Sequence[int]], load: Sequence[int], capacity: int, sweeps: int = 100) -> list[list[float]]:
    """How many of the documents that want to go from shard i to shard j may go.

    All go where that leaves every shard within the capacity. Else the moves into the shards that
    would be too full are scaled down until it does; a move less also frees less room elsewhere,
    so this is repeated. A shard that is too full already takes nothing.
    """
    n = len(load)
    go = [[float(w) if i != j else 0.0 for j, w in enumerate(row)] for i, row in enumerate(wanted)]
    for _ in range(sweeps):
        still = True
        for j in range(n):
            arriving = sum(go[i][j] for i in range(n))
            over = load[j] - sum(go[j]) + arriving - capacity
            if over > 1e-6 and arriving > 0:
                still = False
                share = max(0.0, 1 - over / arriving)
                for i in range(n):
                    go[i][j] *= share
        if still:
            break
    return go


def nodes_of(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """One narrow row per document: its number, what is returned of it, and hashes of its text."""
    body = F.col(text)
    rows = docs.select(
        F.col(doc).alias("doc"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        *hash_pair(body, "t"),
        body.isNull().alias("no_text"),
    )
    numbered = rows.select("*", F.monotonically_increasing_id().alias("node"))
    return stored(numbered.select("*", F.xxhash64("doc", "t1", "t2", "size").alias("k")), "shard-nodes")


def memberships(nodes: DataFrame, links: DataFrame | None) -> DataFrame:
    """``(node, l1, l2, n)``: which documents each link of two or more members ties together."""
    if links is None:
        rows = nodes.where("not no_text").select("node", F.col("t1").alias("l1"), F.col("t2").alias("l2"))
    else:
        named = links.select(F.col(links.columns[0]).alias("doc"), *hash_pair(F.col(links.columns[1]).cast("string"), "l"),
                             F.col(links.columns[1]).alias("link"))
        named = named.where("link is not null").drop("link").distinct()
        rows = nodes.select("doc", "node").join(named, "doc").select("node", "l1", "l2")
    counts = stored(rows.groupBy("l1", "l2").agg(F.count("*").alias("n")).where("n > 1"), "shard-links")
    counted = counts.select("*", F.col("n").alias("members"))
    tied = join_counted(rows, counted, ["l1", "l2"], "members", [F.col("node")])
    salt = F.when(F.col("n") > HOT_ROWS, F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(0).cast("int")
    return stored(tied.select("node", "l1", "l2", "n", salt.alias("salt")), "shard-members")


def choices(members: DataFrame, labels: DataFrame, allowed: Sequence[int], roomy: Sequence[int], heavy: int) -> DataFrame:
    """The shard every linked document would like best, beside the one it is in.

    A link votes for a shard with its members there. Votes are counted on the map side, and a
    link with very many members sends its votes to all its salts. Of equal votes a hash of link
    and shard decides, alike for all members, so that they do not pass each other by.
    """
    placed = members.join(labels, "node")
    votes = placed.groupBy("l1", "l2", "n", "shard").agg(F.count("*").alias("votes"))
    votes = votes.groupBy("l1", "l2", "n").agg(F.collect_list(F.struct("shard", "votes")).alias("cast"))
    salts = F.when(F.col("n") > HOT_ROWS, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    votes = votes.select("l1", "l2", "cast", F.explode(salts).alias("salt"))
    heard = placed.join(votes, ["l1", "l2", "salt"]).select(
        "node", "k", "l1", "l2", "n", F.col("shard").alias("now"), F.explode("cast").alias("v")
    )
    heard = heard.groupBy("node", "k", "now", F.col("v.shard").alias("shard")).agg(
        F.sum("v.votes").alias("votes"), F.min(F.struct("l1", "l2")).alias("link"), F.max("n").alias("n")
    )
    link = F.col("link")
    tie = F.xxhash64(link["l1"], link["l2"], F.col("shard"))
    rank = F.struct("votes", F.col("shard").isin(list(roomy)).alias("room"), tie.alias("tie"), "shard")
    may = F.col("shard").isin(list(allowed)) | (F.col("shard") == F.col("now"))
    best = heard.groupBy("node", "k", "now").agg(
        F.max(F.when(may, rank)).alias("best"),
        F.sum(F.when(F.col("shard") == F.col("now"), F.col("votes"))).alias("here"),
        F.min("link").alias("link"),
        F.max("n").alias("n"),
    )
    gain = F.col("best.votes") - F.col("here")
    # members of a link stand in one place, so that they go together; those of a heavy one are spread
    place = F.when(F.col("n") > heavy, F.xxhash64(F.lit(3), "k")).otherwise(F.xxhash64(link["l1"], link["l2"]))
    return best.select(
        "node", "k", "now", F.col("best.shard").alias("to"),
        F.least(F.floor(F.log2(gain + 1)), F.lit(LEVELS - 1)).cast("int").alias("level"),
        F.pmod(place, F.lit(PLACES)).cast("int").alias("place"),
    )


def moved(wishes: DataFrame, quotas: Sequence[Sequence[float]], turn: int) -> DataFrame:
    """Labels after a round: of those who want to go from one shard to another, the ones with most
    to gain go, as many as the quota allows. The places are counted; their number is bounded by
    shards * shards * LEVELS * PLACES whatever the input, so that they are broadcast."""
    spark = wishes.sparkSession
    allowed = [(i, j, float(q)) for i, row in enumerate(quotas) for j, q in enumerate(row) if q > 0]
    quota = spark.createDataFrame(allowed, "now int, to int, quota double")
    places = wishes.where("now <> to").groupBy("now", "to", "level", "place").agg(F.count("*").alias("c"))
    places = places.join(F.broadcast(quota), ["now", "to"])
    order = "OVER (PARTITION BY now, to ORDER BY level DESC, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    part = places.selectExpr("*", f"coalesce(sum(c) {order}, 0) AS before")
    part = part.select("now", "to", "level", "place", ((F.col("quota") - F.col("before")) / F.col("c") * FINE).alias("parts"))
    joined = wishes.join(F.broadcast(part.where("parts > 0")), ["now", "to", "level", "place"], "left")
    mine = F.pmod(F.xxhash64(F.lit(turn), "k"), F.lit(FINE))
    goes = F.coalesce(mine < F.col("parts"), F.lit(False))
    return joined.select("node", "k", F.when(goes, F.col("to")).otherwise(F.col("now")).alias("shard"))


def propagated(members: DataFrame, labels: DataFrame, shards: int, capacity: int, rounds: int) -> DataFrame:
    """Rounds of label propagation until nobody moves. The driver sees two tables of shards by shards."""
    load = [0] * shards
    for row in labels.groupBy("shard").count().collect():
        load[row["shard"]] = row["count"]
    old, still = None, 0
    for turn in range(rounds):
        # in turn with shards that are full, where documents may change places, and with those that have room
        free = [s for s in range(shards) if load[s] < capacity]
        allowed = range(shards) if turn % 2 == 0 else free
        wishes = stored(choices(members, labels, allowed, free, max(LEVELS, capacity // 64)), "shard-wishes")
        wanted = [[0] * shards for _ in range(shards)]
        for row in wishes.groupBy("now", "to").count().collect():
            wanted[row["now"]][row["to"]] = row["count"]
        quotas = move_quotas(wanted, [sum(row) for row in wanted], capacity)
        labels = moved(wishes, quotas, turn)
        if old is not None:
            unstored(old)
        old = wishes
        load = [sum(wanted[s]) - sum(quotas[s]) + sum(q[s] for q in quotas) for s in range(shards)]
        still = still + 1 if sum(map(sum, quotas)) < 1 else 0
        if still == 2:
            break
    return labels


def numbered(rows: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """Add ``pos``, counted from 0 per key in the order of ``kind`` and ``h``, in blocks that no link outgrows."""
    prefix = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("bigint")
    sub = F.when(F.col("many"), F.shiftright("node", 18)).otherwise(F.lit(0).cast("bigint"))
    cut = rows.select("*", prefix.alias("prefix"), sub.alias("sub"))
    seq = ["kind", "prefix", "sub", "h", "k", "node"]
    block = F.struct("kind", "prefix", "sub")
    return running_totals(cut, keys, seq, block, {"pos": F.lit(1)}).drop("prefix", "sub")


def pick(values: Sequence[int], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("bigint") for v in values]), index.cast("int") + 1)


def balanced_shards(
    docs: DataFrame,
    links: DataFrame | None = None,
    doc: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Put every row into one of ``shards`` shards: ``doc, size, text_crc32, shard, slot``.

    The counts of any two shards differ by one at most. ``links`` is a table of (document, link): documents
    with the same link should meet. Without it equal texts are linked. ``size`` is the text's UTF-8
    bytes plus one, ``text_crc32`` its unsigned CRC-32, ``slot`` the place in the shard, counted from 0
    without gaps.

    Linked documents start in shards by hash. In every round each looks at the shards of those it
    is linked to and wants to go where most are; shards take as many as their quota leaves room
    for (a little more than its share while documents move), those with most to gain first. A link with more members than a shard holds fills shards one after the other.
    What has no links is no cut edge anywhere: it fills what room is left at the end. Should the linked
    alone overfill a shard, the last links in it go to where there is room.

    NULL text has size 1 and a NULL CRC, and is linked to nothing; empty texts are equal texts. A NULL id is
    an id for this purpose, but has no links of its own in ``links``. Rows that are repeated are placed one by one.
    Columns of ``docs`` other than the two named are not read, so no names clash. An empty table gives no rows.
    The result depends on the rows alone, save which of several identical rows gets which place.
    """
    nodes = nodes_of(docs, doc, text)
    total = nodes.count()
    capacity, more = divmod(total, shards)
    members = memberships(nodes, links)
    first = members.groupBy("node").agg(F.min(F.struct("l1", "l2")).alias("link"), F.max("n").alias("n"))
    linked = stored(nodes.join(first, "node"), "shard-linked")
    start = F.pmod(F.xxhash64(F.lit(1), "k"), F.lit(shards)).cast("int")
    labels = linked.select("node", "k", start.alias("shard"))
    room_for = capacity + capacity // SLACK + 1
    labels = stored(propagated(members, labels, shards, room_for, rounds).select("node", "shard"), "shard-labels")

    load = [0] * shards
    for row in labels.groupBy("shard").count().collect():
        load[row["shard"]] = row["count"]
    fullest = sorted(range(shards), key=lambda s: (-load[s], s))[:more]
    quota = [capacity + (s in fullest) for s in range(shards)]
    kept = [min(n, q) for n, q in zip(load, quota)]
    bits = max(0, (total >> 16).bit_length())

    out = ["doc", "size", "text_crc32", "shard", "slot"]
    carried = ["doc", "size", "text_crc32", "node", "k"]
    placed = numbered(
        linked.join(labels, "node").select(
            *carried, "shard", F.col("link.l1").alias("h"), (F.col("n") > HOT_ROWS).alias("many"), F.lit(0).alias("kind")
        ),
        ["shard"], bits,
    )
    placed = stored(placed, "shard-placed")
    stay = F.col("pos") < pick(quota, F.col("shard"))
    alone = nodes.join(linked.select("node"), "node", "left_anti")
    # rows whose hash may be that of very many others are numbered by their own number instead
    crowd = F.col("no_text") if links is None else F.lit(True)
    alone = alone.select(*carried, F.when(crowd, 0).otherwise(F.col("k")).alias("h"), crowd.alias("many"), F.lit(1).alias("kind"))
    over = placed.where(~stay).select(*carried, "h", "many", "kind")
    pool = numbered(over.unionByName(alone), [], bits)
    ends, at = [], 0
    for s in range(shards):
        at += quota[s] - kept[s]
        ends.append(at)
    room = F.array(*[F.lit(e).cast("bigint") for e in ends])
    pool = pool.select("*", F.size(F.filter(room, lambda e: e <= F.col("pos"))).alias("shard"))
    first_of = [e - (q - k) for e, q, k in zip(ends, quota, kept)]
    slot = pick(kept, F.col("shard")) + F.col("pos") - pick(first_of, F.col("shard"))
    settled = placed.where(stay).select(*carried, "shard", F.col("pos").alias("slot"))
    filled = pool.select(*carried, "shard", slot.alias("slot"))
    return settled.unionByName(filled).select(*out)
