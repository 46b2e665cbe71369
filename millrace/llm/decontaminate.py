"""Benchmark decontamination: short test items inside long documents.

Containment of a short item in a long document leaves next to no Jaccard similarity between the
two, so both are brought to one size first. Items are partitioned by size (number of shingles,
by powers of two), and for each partition the documents are read in overlapping windows of
twice that size: an item lies whole in one of them, at a similarity of at least a fifth. Each
MinHash value is a band of its own, so a window finds an item if any of ``BANDS`` minima agree.
Every pair found is verified by exact containment in the whole document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.lines import hash_pair
from millrace.llm.shingles import HASH_BITS, distinct_shingles, mix, portions, shingle_hashes
from millrace.llm.tables import stored

CONTAINMENT = 0.8
BANDS = 48  # at a similarity of 1/5 no minimum agrees with probability 0.8 ** 48 = 2e-5
FILTER_BITS = 25  # size of the bit table of item minima, as a power of two: 4 MB at any input
SALTS = 32  # tasks among which the documents of one item are dealt


def size_class(n: np.ndarray) -> np.ndarray:
    """0 for one shingle, 1 for two, 2 for up to four ...; -1 for none."""
    return np.where(n > 0, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), -1)


def permuted(hashes: np.ndarray, band: int) -> np.ndarray:
    return mix(hashes + np.uint64((band + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of every shingle in the bit table."""
    return hashes >> np.uint64(HASH_BITS - FILTER_BITS), mix(hashes) >> np.uint64(64 - FILTER_BITS)


def signed_items(items: DataFrame, item: str, text: str, bands: int) -> DataFrame:
    """``item, shingles, cls``, the ``minima`` of all bands and the ``bits`` of the shingles that have them."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            hashes, _, counts = distinct_shingles(texts)
            bounds, rows = np.concatenate([[0], np.cumsum(counts)]), {"s": [], "m": [], "x": []}
            for k in range(len(texts)):
                own = hashes[bounds[k] : bounds[k + 1]]
                values = [permuted(own, b) for b in range(bands)] if len(own) else []
                rows["s"].append(own.view(np.int64))
                rows["m"].append(np.array([v.min() for v in values], np.uint64).view(np.int64))
                minimal = own[sorted({int(v.argmin()) for v in values})]
                rows["x"].append(np.unique(np.concatenate(places(minimal))).view(np.int64))
            lists = [pa.array(v, pa.list_(pa.int64())) for v in rows.values()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size_class(counts)), *lists], names=["item", "cls", "shingles", "minima", "bits"]
            )

    kind = items.schema[item].dataType.simpleString()
    schema = f"item {kind}, cls bigint, shingles array<bigint>, minima array<bigint>, bits array<bigint>"
    return items.select(F.col(item).alias("item"), F.col(text).alias("text")).mapInArrow(sign, schema)


def bit_table(items: DataFrame) -> np.ndarray:
    """Bits of the shingles that are a minimum of some item.

    The table has a fixed size and comes in words of 64 bits, so it can be broadcast however many
    items there are; more items let more documents through to the exact steps, none is lost.
    """
    words = items.select(F.explode("bits").alias("place")).select(
        F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, CAST(place & 63 AS INT))").alias("bit")
    )
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def flagged(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    one, two = (
        table[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1) for p in places(hashes)
    )
    return (one & two).astype(bool)


def window_minima(hashes: np.ndarray, marked: np.ndarray, classes: Sequence[int], bands: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(class, band, minima) over the windows of one document, of the minima that are marked shingles.

    Other windows cannot agree with an item: the shingle that has the minimum is the item's too.
    """
    for band in range(bands):
        values = permuted(hashes, band)
        known = np.sort(values[marked])
        for cls in classes:
            half = np.minimum.reduceat(values, np.arange(0, len(values), 1 << cls))
            whole = np.minimum(half[:-1], half[1:]) if len(half) > 1 else half
            whole = np.unique(whole)
            at = np.searchsorted(known, whole)
            at[at == len(known)] = 0
            whole = whole[known[at] == whole]
            if len(whole):
                yield cls, band, whole


def found_windows(docs: DataFrame, doc: str, text: str, table: np.ndarray, classes: Sequence[int], bands: int) -> DataFrame:
    """Documents with windows that may agree with an item: ``doc, t1, t2, shingles, found``."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            texts = batch.column(3).to_pylist()
            rows, sets, founds = [], [], []
            for first, end in portions(texts):
                hashes, counts = shingle_hashes(texts[first:end])
                bounds, marks = np.concatenate([[0], np.cumsum(counts)]), flagged(hashes, bits)
                owner = np.repeat(np.arange(end - first), counts)
                for k in np.unique(owner[marks]):
                    own = slice(bounds[k], bounds[k + 1])
                    found = [
                        {"cls": cls, "band": band, "minimum": m}
                        for cls, band, minima in window_minima(hashes[own], marks[own], classes, bands)
                        for m in minima.view(np.int64).tolist()
                    ]
                    if found:
                        rows.append(first + int(k))
                        sets.append(np.unique(hashes[own]).view(np.int64))
                        founds.append(found)
            kept = batch.select([0, 1, 2]).take(pa.array(rows, pa.int64()))
            kind = pa.list_(pa.struct([("cls", pa.int64()), ("band", pa.int64()), ("minimum", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sets, pa.list_(pa.int64())), pa.array(founds, kind)],
                names=["doc", "t1", "t2", "shingles", "found"],
            )

    kind = docs.schema[doc].dataType.simpleString()
    schema = f"doc {kind}, t1 bigint, t2 bigint, shingles array<bigint>, found array<struct<cls:bigint,band:bigint,minimum:bigint>>"
    given = docs.where(F.col(text).isNotNull()).select(
        F.col(doc).alias("doc"), *hash_pair(F.col(text), "t"), F.col(text).alias("text")
    )
    return given.mapInArrow(search, schema)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    containment: float = CONTAINMENT,
    bands: int = BANDS,
) -> DataFrame:
    """Pairs of a document and an item it contains.

    Returns ``doc`` and ``item`` (named as in their tables; an item column named like the document's
    gets ``_item`` after its name), ``n_shared`` and ``n_shingles``: how many of the item's distinct
    five-word shingles (letters and digits without regard to case) the document has, and how many
    there are. Pairs with a share of ``containment`` or more are returned, each once.

    NULL or wordless texts and items match nothing; an item with fewer than five words is one
    shingle of all its words, and so is a text. Rows that repeat an id are one document or item
    each text of which is compared; the best text counts. NULL ids stay NULL and count as
    one. Empty tables give an empty table. Items may be many: their minima become a bit table of
    fixed size, and the items themselves are joined, dealt by salt as one item may be in very many
    documents.
    """
    signs = stored(signed_items(items, item, item_text, bands), "item-signatures")
    classes = sorted(r[0] for r in signs.where("cls >= 0").select("cls").distinct().collect())  # at most 44
    hits = stored(found_windows(docs, doc, text, bit_table(signs), classes, bands), "found-windows")

    salt = F.pmod(F.xxhash64("t1"), F.lit(SALTS)).cast("int").alias("salt")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    each = hits.select("doc", "t1", "t2", salt, F.explode("found").alias("w")).select("doc", "t1", "t2", "salt", "w.*")
    keyed = signs.select("item", "cls", F.col("shingles").alias("item_shingles"), F.posexplode("minima").alias("band", "minimum"))
    mark = [h.alias(f"i{k}") for k, h in enumerate(hash_pair(F.col("item_shingles"), "i"), 1)]
    bands_of = keyed.select("item", "cls", F.col("band").cast("bigint").alias("band"), "minimum", *mark, salts)
    pairs = each.join(bands_of, ["cls", "band", "minimum", "salt"]).select("doc", "t1", "t2", "item", "i1", "i2").distinct()

    own = hits.select("doc", "t1", "t2", "shingles").distinct()
    sets = signs.select("item", F.col("shingles").alias("item_shingles")).distinct()
    sets = sets.select("item", "item_shingles", *[h.alias(f"i{k}") for k, h in enumerate(hash_pair(F.col("item_shingles"), "i"), 1)], salts)
    full = pairs.join(
        own.withColumnRenamed("doc", "own_doc").withColumnRenamed("t1", "o1").withColumnRenamed("t2", "o2"),
        F.col("doc").eqNullSafe(F.col("own_doc")) & (F.col("t1") == F.col("o1")) & (F.col("t2") == F.col("o2")),
    ).select("doc", "item", "i1", "i2", "shingles", F.pmod(F.xxhash64("t1"), F.lit(SALTS)).cast("int").alias("salt"))
    other = sets.withColumnRenamed("item", "set_item")
    full = full.join(other, ["i1", "i2", "salt"]).where(F.col("item").eqNullSafe(F.col("set_item")))
    shared = F.size(F.array_intersect("shingles", "item_shingles")).cast("bigint")
    counted = full.select("doc", "item", shared.alias("n_shared"), F.size("item_shingles").cast("bigint").alias("n_shingles"))
    good = counted.where(F.col("n_shared") >= F.ceil(F.col("n_shingles") * F.lit(containment) - 1e-9))
    share = F.col("n_shared") / F.col("n_shingles")
    best = good.groupBy("doc", "item").agg(F.max_by(F.struct("n_shared", "n_shingles"), F.struct(share, F.col("n_shingles"))).alias("best"))
    name = item if item != doc else f"{item}_item"
    return best.select(F.col("doc").alias(doc), F.col("item").alias(name), "best.*")
