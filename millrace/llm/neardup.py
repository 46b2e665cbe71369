"""Near-duplicate documents: consistent weighted samples of TF-IDF shingles, banded and verified.

1. Document frequencies of all shingles, summed in a fixed number of buckets.
2. Improved consistent weighted sampling (Ioffe 2010) gives every document ``bands * rows``
   samples; two documents share one with the probability of their weighted Jaccard similarity.
3. Documents with equal texts become one member; members that share a band meet in a bucket.
4. Members are verified against the pivot of their bucket, and against one another only where
   they did not come out connected and no bound rules a link out.
5. Connected components are the classes.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.lines import hash_pair
from millrace.llm.shingles import HASH_BITS, SHINGLE_WORDS, distinct_shingles, mix, portions
from millrace.llm.tables import join_counted, stored, unstored

SIMILARITY = 0.8
BANDS, ROWS = 12, 3  # a pair at 0.8 shares no band with probability 0.0002
FREQUENCY_BITS = 18  # documents are counted in so many (as a power of two) buckets of shingles
QUANTILES = 1 << 14
GROUPS = 256  # groups of shingles in the profile of a text
BLOCK = 4096  # members of a pivot that are compared with as many others at a time
PORTION = 1 << 16  # shingles sampled at a time, so that arrays stay in the cache


# --- weights -------------------------------------------------------------------------------


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(HASH_BITS - FREQUENCY_BITS)).astype(np.int64)


def inverse_frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """Weight of every bucket of shingles: ln((1 + documents) / (1 + documents with one)) + 1.

    All documents count. The table has 2 ** FREQUENCY_BITS entries whatever the input, so it can
    be broadcast. A bucket also holds rare shingles by chance: they add the same share to every
    bucket at any size, far below what frequent shingles have.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(1 << FREQUENCY_BITS, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for first, end in portions(texts):
                hashes, _, counts = distinct_shingles(texts[first:end])
                sums += np.bincount(buckets(hashes), minlength=len(sums))
                n += int((counts > 0).sum())
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), pa.array(np.append(sums[found], n))], names=["bucket", "n"]
        )

    counted = docs.select(text).mapInArrow(count, "bucket bigint, n bigint")
    total = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = (total.column(c).to_numpy() for c in ("bucket", "n"))
    frequency = np.zeros(1 << FREQUENCY_BITS)
    frequency[bucket[bucket >= 0]] = n[bucket >= 0]
    return (np.log((1.0 + n[bucket < 0].sum()) / (1.0 + frequency)).clip(0) + 1).astype(np.float32)


def weighted(texts: Sequence[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles, their TF-IDF weights, and their number for each text."""
    hashes, times, counts = distinct_shingles(texts)
    return hashes, times.astype(np.float32) * idf[buckets(hashes)], counts


# --- sampling ------------------------------------------------------------------------------


@functools.cache
def gamma_quantiles() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the Gamma(2, 1) distribution and their logarithms."""
    x = np.concatenate([np.linspace(0, 1, 200_001), np.linspace(1, 30, 400_001)[1:]])
    values = np.interp((np.arange(QUANTILES) + 0.5) / QUANTILES, 1 - (1 + x) * np.exp(-x), x)
    return values.astype(np.float32), np.log(values).astype(np.float32)


def steps(hashes: np.ndarray, log_weights: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The quantised log weight t and the log of the race time a of every shingle."""
    gamma, log_gamma = gamma_quantiles()
    bits = mix(hashes + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    r = gamma[bits & np.uint64(QUANTILES - 1)]
    log_c = log_gamma[(bits >> np.uint64(14)) & np.uint64(QUANTILES - 1)]
    beta = (bits >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
    t = np.floor(log_weights / r + beta)
    return t, log_c - r * (t - beta) - r


def samples(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, number: int) -> np.ndarray:
    """``number`` samples of every text, whose shingles begin at ``starts``: a row per text."""
    out = np.zeros((len(starts), number), np.uint64)
    logs = np.log(weights)
    place = np.arange(len(hashes), dtype=np.uint64)
    for k in range(number):
        t, a = steps(hashes, logs, k)
        order = a.view(np.uint32)  # made to sort as the floats do
        order = np.where(order >> np.uint32(31), ~order, order | np.uint32(1 << 31)).astype(np.uint64)
        best = np.minimum.reduceat(order << np.uint64(32) | place, starts) & np.uint64(0xFFFFFFFF)
        best = best.astype(np.int64)
        out[:, k] = mix(hashes[best] ^ mix(t[best].astype(np.int64).view(np.uint64)))
    return out


def band_keys(texts: Sequence[str | None], idf: np.ndarray, bands: int, rows: int) -> list[np.ndarray | None]:
    """Keys of the bands of every text; None for a text without words."""
    out: list[np.ndarray | None] = [None] * len(texts)
    for first, end in portions(texts):
        hashes, weights, counts = weighted(texts[first:end], idf)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        filled = np.flatnonzero(counts)
        groups = np.searchsorted(bounds[filled], np.arange(0, bounds[-1] + PORTION, PORTION))
        for i, j in zip(groups[:-1], groups[1:], strict=True):
            if i == j:
                continue
            low, high = bounds[filled[i]], bounds[filled[j - 1] + 1]
            got = samples(hashes[low:high], weights[low:high], bounds[filled[i:j]] - low, bands * rows)
            keys = np.zeros((j - i, bands), np.uint64)
            for k in range(rows):
                keys = mix(keys * np.uint64(31) + got[:, k::rows])
            for number, row in zip(filled[i:j], keys, strict=True):
                out[first + number] = row.view(np.int64)
    return out


def signed(docs: DataFrame, doc: str, text: str, idf: np.ndarray, bands: int, rows: int) -> DataFrame:
    """``doc, t1, t2`` (hash of the text) and ``keys`` (of the bands) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(batch.column(3).to_pylist(), shared.value, bands, rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(keys, pa.list_(pa.int64()))], names=["doc", "t1", "t2", "keys"]
            )

    marks = [F.when(F.col(text).isNotNull(), h).alias(t) for h, t in zip(hash_pair(F.col(text), "t"), ("t1", "t2"), strict=True)]
    given = docs.select(F.col(doc).alias("doc"), *marks, F.col(text).alias("text"))
    kind = docs.schema[doc].dataType.simpleString()
    return given.mapInArrow(sign, f"doc {kind}, t1 bigint, t2 bigint, keys array<bigint>")


# --- verification --------------------------------------------------------------------------


def similarities(left: Sequence[str], right: Sequence[str], idf: np.ndarray) -> list[float]:
    """Weighted Jaccard similarity of the texts of each pair."""
    out: list[float] = []
    for first, end in portions(left, right):
        n = end - first
        # a pivot comes many times in a row and is weighed once
        sides = list(dict.fromkeys([*left[first:end], *right[first:end]]))
        number = {t: i for i, t in enumerate(sides)}
        hashes, weights, counts = weighted(sides, idf)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        for k in range(first, first + n):
            a, b = number[left[k]], number[right[k]]
            ha, wa = hashes[bounds[a] : bounds[a + 1]], weights[bounds[a] : bounds[a + 1]]
            hb, wb = hashes[bounds[b] : bounds[b + 1]], weights[bounds[b] : bounds[b + 1]]
            at = np.searchsorted(hb, ha)
            at[at == len(hb)] = 0
            same = hb[at] == ha if len(hb) else np.zeros(len(ha), bool)
            common = float(np.minimum(wa[same], wb[at[same]]).sum(dtype=np.float64))
            total = float(wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64)) - common
            out.append(common / total if total else 0.0)
    return out


def texts_of(wanted: DataFrame, docs: DataFrame, members: DataFrame, doc: str, text: str) -> DataFrame:
    """``id, text`` of the members in ``wanted`` (column ``member``), and of no other document."""
    marked = wanted.distinct().join(members.select("member", "t1", "t2"), "member").withColumnRenamed("member", "id")
    source = docs.select(F.col(doc).alias("id"), *hash_pair(F.col(text), "t"), F.col(text).alias("text"))
    return source.join(marked, ["id", "t1", "t2"], "left_semi").dropDuplicates(["id"]).select("id", "text")


def verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, doc: str, text: str, idf: np.ndarray) -> DataFrame:
    """``a, b`` and their similarity, for pairs of members; all of them, linked or not."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    wanted = pairs.select(F.col("a").alias("member")).union(pairs.select("b"))
    texts = stored(texts_of(wanted, docs, members, doc, text), "paired-texts")
    both = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = similarities(batch.column(2).to_pylist(), batch.column(3).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(got, pa.float64())], names=["a", "b", "similarity"])

    kind = docs.schema[doc].dataType.simpleString()
    out = both.select("a", "b", "text_a", "text_b").mapInArrow(verify, f"a {kind}, b {kind}, similarity double")
    out = stored(out, "verified-pairs")
    unstored(texts)
    return out


# --- pairs that no pivot settles -----------------------------------------------------------


def profiled(wanted: DataFrame, docs: DataFrame, members: DataFrame, doc: str, text: str, idf: np.ndarray) -> DataFrame:
    """``member, weight, profile``: the total weight of a text, and its weight by group of shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def profile(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, weights, profiles = batch.column(1).to_pylist(), [], []
            for first, end in portions(texts):
                hashes, weight, counts = weighted(texts[first:end], shared.value)
                owner = np.repeat(np.arange(end - first), counts)
                place = owner * GROUPS + (hashes % np.uint64(GROUPS)).astype(np.int64)
                sums = np.bincount(place, weight, (end - first) * GROUPS).reshape(-1, GROUPS)
                weights += sums.sum(1).tolist()
                profiles += [row.tobytes() for row in sums.astype(np.float32)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(weights, pa.float64()), pa.array(profiles, pa.binary())],
                names=["member", "weight", "profile"],
            )

    kind = docs.schema[doc].dataType.simpleString()
    return texts_of(wanted, docs, members, doc, text).mapInArrow(profile, f"member {kind}, weight double, profile binary")


def possible_pairs(x: pa.Table, y: pa.Table, similarity: float) -> pa.Table:
    """``a, b`` of one block of open members and one of members of the same pivot, of which no
    bound says that they are less similar."""
    column = lambda t, c: t.column(c).to_numpy(zero_copy_only=False)
    own = np.frombuffer(b"".join(x.column("profile").to_pylist()), np.float32).reshape(-1, GROUPS)
    other = np.frombuffer(b"".join(y.column("profile").to_pylist()), np.float32).reshape(-1, GROUPS)
    members, labels, far, weights = (column(y, c) for c in ("member", "label", "distance", "weight"))
    settled, pairs = column(y, "settled").astype(bool), []
    for k, (member, label, distance, weight) in enumerate(
        zip(*(column(x, c) for c in ("member", "label", "distance", "weight")), strict=True)
    ):
        left = (labels != label) & (settled | (members > member)) & (np.abs(far - distance) <= 1 - similarity + 1e-6)
        left = np.flatnonzero(left)
        common = np.minimum(own[k], other[left]).sum(1, dtype=np.float64)  # as much as both can have in common
        good = common * (1 + 1e-5) >= similarity * (weight + weights[left] - common)
        pairs += [(member, m) for m in members[left[good]]]
    kind = x.schema.field("member").type
    return pa.table({"a": pa.array([a for a, _ in pairs], kind), "b": pa.array([b for _, b in pairs], kind)})


# --- classes -------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest id that is connected with a node, for all nodes of ``a, b`` links.

    Every round takes the smallest label among the neighbours and then the label of the label,
    so that long chains shrink quickly; each round is written to the shared folder.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    first = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = stored(first.select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("b"), "label")
        near = both.join(seen, "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a).select("node", F.least("label", "near").alias("label"))
        step = stored(step, "labels")
        over = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = stored(step.join(over, "label").select("node", F.least("label", "further").alias("label")), "labels")
        moved = jumped.join(labels.select("node", F.col("label").alias("old")), "node").where("label != old")
        done = moved.isEmpty()
        unstored(labels, step)
        labels = jumped
        if done:
            unstored(both)
            return labels


def near_duplicates(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """The class of every document: ``doc`` (named as in ``docs``) and ``class_id``.

    Documents are linked if their texts are equal, or if their weighted Jaccard similarity over
    TF-IDF weights of five-word shingles (letters and digits without regard to case) is
    ``similarity`` or more. ``class_id`` is the smallest id that is connected with a document.

    Links are searched in buckets of equal bands. In each bucket the member that meets most others
    is the pivot, and all are verified against it: as many pairs as members. Members that are in
    another component than their pivot afterwards are then verified against all members of the
    pivot in other components than their own, but for those that two bounds prove not to be
    similar (:func:`unsettled`). Nothing is capped or sampled.

    Returned is one row per id: rows that repeat an id are one document, and of its texts the one
    with the smallest hash counts. Rows with a NULL id are not returned, for no class could name
    them. NULL text: a class of its own. Texts with no word are linked only to equal ones; with
    fewer than five words, all words are one shingle. An empty table gives an empty table.
    """
    idf = inverse_frequencies(docs, text)
    marks = signed(docs, doc, text, idf, bands, rows).where("doc is not null")
    one = marks.groupBy("doc").agg(F.min(F.struct("t1", "t2", "keys")).alias("mark")).select("doc", "mark.*")
    marks = stored(one, "signatures")

    equal = marks.where("t1 is not null").groupBy("t1", "t2")
    members = equal.agg(F.min("doc").alias("member"), F.count("*").alias("n_copies"), F.first("keys").alias("keys"))
    members = stored(members, "members")
    split = members.select("member", F.posexplode("keys").alias("band", "key"))
    bucket = ["band", "key"]
    sizes = stored(split.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1"), "bucket-sizes")
    met = stored(join_counted(split, sizes, bucket, "n", [F.col("member")]), "met")
    degrees = met.groupBy("member").agg(F.sum("n").alias("degree"))
    ranked = met.join(degrees, "member").groupBy(*bucket).agg(
        F.count("*").alias("n"), F.max_by("member", F.struct("degree", F.xxhash64("member"), "member")).alias("pivot")
    )
    pivots = stored(ranked, "pivots")
    starred = join_counted(met.drop("n"), pivots, bucket, "n", [F.col("member")])
    starred = stored(starred.where("member != pivot").drop("n"), "starred")
    stars = starred.select(F.col("pivot").alias("a"), F.col("member").alias("b")).distinct()
    checked = verified(stars, docs, members, doc, text, idf)
    links = checked.where(F.col("similarity") >= similarity).select("a", "b")
    labels = components(links)

    profiles = lambda wanted: profiled(wanted, docs, members, doc, text, idf)
    again = stored(unsettled(starred, checked, labels, similarity, profiles), "unsettled")
    if not again.isEmpty():
        more = verified(again, docs, members, doc, text, idf)
        labels = components(links.union(more.where(F.col("similarity") >= similarity).select("a", "b")))

    classes = members.join(labels, members.member == labels.node, "left").select(
        "t1", "t2", "n_copies", F.coalesce("label", "member").alias("class_id")
    )
    found = join_counted(
        marks.drop("keys"), stored(classes, "classes"), ["t1", "t2"], "n_copies", [F.col("doc")], how="left"
    )
    unstored(sizes, met, pivots, starred, checked, again)
    return found.select(F.col("doc").alias(doc), F.coalesce("class_id", "doc").alias("class_id"))


def unsettled(
    starred: DataFrame, checked: DataFrame, labels: DataFrame, similarity: float, profiles: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Pairs ``a, b`` that still have to be verified: members with one pivot in different components,
    of which one is not in the pivot's, unless a bound rules a link out.

    Two bounds do so: 1 - similarity is a distance, so distances from the pivot may not differ by
    more; and two texts have in common at most what both have in each group of shingles. Members of
    a pivot are compared in blocks, each with each, and only pairs that may be similar leave a
    block: as a rule next to none.
    """
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("label"))
    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("pivot_label"))
    tagged = checked.join(of_b, "b", "left").join(of_a, "a", "left").select(
        F.col("a").alias("pivot"),
        F.col("b").alias("member"),
        (1 - F.col("similarity")).alias("distance"),
        F.coalesce("label", "b").alias("label"),
        (F.coalesce("label", "b") == F.coalesce("pivot_label", "a")).alias("settled"),
    )
    tagged = stored(tagged, "tagged")
    blocks = tagged.groupBy("pivot").agg(
        F.ceil(F.count(F.when(~F.col("settled"), 1)) / BLOCK).cast("int").alias("n_x"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("n_y"),
        F.count("*").alias("n"),
    )
    blocks = stored(blocks.where("n_x > 0 and n > 1"), "blocks")
    placed = join_counted(tagged, blocks, ["pivot"], "n", [F.col("member")])
    if placed.isEmpty():
        return checked.select("a", "b").limit(0)
    full = stored(placed.join(profiles(placed.select("member")), "member"), "placed")
    block = lambda n: F.pmod(F.xxhash64("member"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = full.where(~F.col("settled")).withColumn("bx", block("n_x")).withColumn("by", each("n_y"))
    y = full.withColumn("by", block("n_y")).withColumn("bx", each("n_x"))
    keys = ["pivot", "bx", "by"]
    kind = checked.schema["a"].dataType.simpleString()
    pairs = x.groupBy(*keys).cogroup(y.groupBy(*keys))
    return pairs.applyInArrow(lambda a, b: possible_pairs(a, b, similarity), f"a {kind}, b {kind}").distinct()
