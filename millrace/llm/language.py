"""Language ID with a string kernel.

The kernel of two texts is the number of character n-grams that both have, over the geometric
mean of how many each has (blended spectrum, presence only). Ridge regression with one output per
language is fitted in the space that a few landmark texts span (Nystroem): K(x, landmarks) times
K(landmarks, landmarks) ** -1/2. Texts are scored in batches: one matrix product of their n-gram
presence with that of the landmarks, and one with the weights.

One language always comes out best, however strange the text. Whether a text is in that language
at all is told by the share of its n-grams that the language's texts have (:func:`familiar`).
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

GRAMS = (1, 2, 3)
PRESENCE_BITS = 14  # n-grams are told apart by a hash of so many bits
UNKNOWN = "und"

# Bounds of what is collected to fit: MAX_TRAINING texts of 2 KB each, and the languages.
MAX_TRAINING = 4000
MAX_LANGUAGES = 256
LANDMARKS = 256
RIDGE = 1.0

# A text is in a language if so many of its n-grams are usual there: this far up from the share
# that any n-gram has to be usual to what all but a hundredth of the texts learned from reach.
USUAL_TEXTS = 2
STRANGE = 0.01
FAMILIAR = 2 / 3

CHUNK_CHARS = 1 << 20
SCORE_TEXTS = 512  # texts scored at a time: 8 MB of presence


@functools.cache
def letter_table() -> np.ndarray:
    """Code of every character: letters in lower case, 0 for the others."""
    table = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            table[i] = ord(c.lower()[0])
    return table


def presence(texts: Sequence[str | None]) -> np.ndarray:
    """One row per text: which n-grams of letters it has. Runs of other characters are one blank.

    A text without letters has an empty row. Long texts are read in chunks that overlap.
    """
    rows = np.zeros((len(texts), 1 << PRESENCE_BITS), bool)
    table, longest = letter_table(), max(GRAMS)
    shift = np.uint32(32 - PRESENCE_BITS)
    for row, text in zip(rows, texts, strict=True):
        tail = np.zeros(1, np.uint32)  # a text begins after a blank
        for at in range(0, len(text or ""), CHUNK_CHARS):
            part = text[at : at + CHUNK_CHARS].encode("utf-32-le", "surrogatepass")
            codes = np.concatenate([tail, table[np.frombuffer(part, np.uint32)]])
            codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
            last = at + CHUNK_CHARS >= len(text)
            if last and codes[-1] != 0:
                codes = np.append(codes, np.uint32(0))
            if codes.any():
                hashes = codes * np.uint32(0x9E3779B1)
                for n in GRAMS:
                    if n > 1:
                        hashes = hashes[:-1] * np.uint32(0x85EBCA6B) + codes[n - 1 :] * np.uint32(0xC2B2AE35) + np.uint32(n)
                    row[(hashes ^ hashes >> np.uint32(15)) * np.uint32(0x27D4EB2F) >> shift] = True
            tail = codes[-(longest - 1) :]
    return rows


def kernel(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Normalised number of common n-grams of every two rows; 0 with an empty row."""
    a, b = rows.astype(np.float32), others.astype(np.float32)
    norms = np.sqrt(np.outer(a.sum(1), b.sum(1)))
    return np.divide(a @ b.T, norms, out=np.zeros_like(norms), where=norms > 0)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    landmarks: np.ndarray  # packed presence
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray
    usual: np.ndarray  # packed presence of the n-grams that are usual in each language
    least: np.ndarray  # share of a text's n-grams that have to be


EMPTY = Model([], np.zeros((0, 1 << PRESENCE_BITS - 3), np.uint8), np.zeros((0, 0)), np.zeros(0), np.zeros((0, 1 << PRESENCE_BITS - 3), np.uint8), np.zeros(0))


def ridge(rows: np.ndarray, langs: np.ndarray, landmarks: int = LANDMARKS, penalty: float = RIDGE) -> Model:
    """Fit on presence rows and their languages, which come in a random order."""
    languages = sorted(set(langs))
    # the first rows of every language in turn
    turn = np.zeros(len(langs), np.int64)
    for lang in languages:
        mine = langs == lang
        turn[mine] = np.arange(mine.sum())
    chosen = rows[np.argsort(turn, kind="stable")[:landmarks]]
    values, vectors = np.linalg.eigh(kernel(chosen, chosen).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    blocks = [kernel(rows[at : at + SCORE_TEXTS], chosen) for at in range(0, len(rows), SCORE_TEXTS)]
    features = np.concatenate(blocks).astype(np.float64) @ root
    target = np.where(langs[:, None] == np.array(languages, object)[None, :], 1.0, -1.0)
    # every language weighs the same, however many of its texts are there
    share = np.array([1.0 / (langs == lang).sum() for lang in langs]) * len(langs) / len(languages)
    middle, level = np.average(features, 0, share), np.average(target, 0, share)
    centred = (features - middle) * share[:, None]
    solved = np.linalg.solve(centred.T @ (features - middle) + penalty * np.eye(features.shape[1]), centred.T @ (target - level))
    known = [usual(rows[langs == lang]) for lang in languages]
    grams, least = np.packbits([g for g, _ in known], axis=1), np.array([n for _, n in known])
    return Model(languages, np.packbits(chosen, axis=1), root @ solved, level - middle @ solved, grams, least)


def usual(rows: np.ndarray) -> tuple[np.ndarray, float]:
    """N-grams that ``USUAL_TEXTS`` of a language's texts have, and the share of them that a text needs.

    A text learned from is measured by what the others have, as a new one would be. A language
    with too few texts to tell needs nothing.
    """
    texts = rows.sum(0, dtype=np.int64)
    own = (rows & (texts > USUAL_TEXTS)).sum(1) / np.maximum(rows.sum(1), 1)
    grams = texts >= USUAL_TEXTS
    any_gram, reached = grams.mean(), np.quantile(own, STRANGE, method="lower")
    return grams, max(0.0, any_gram + FAMILIAR * (reached - any_gram)) if reached > any_gram else 0.0


def familiar(rows: np.ndarray, best: np.ndarray, model: Model, grams: np.ndarray) -> np.ndarray:
    """Whether texts have the n-grams of the language that came out best. ``grams`` are the usual ones, unpacked."""
    found = (rows & grams[best]).sum(1)
    return found >= model.least[best] * rows.sum(1)


def fit(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MAX_TRAINING) -> Model:
    """Fit on a sample of the rows with a language and a letter, at most ``most`` texts in all.

    Each language gets an equal part of ``most`` (all its rows, if it has fewer), taken by the
    hash of the id; of more than ``MAX_LANGUAGES`` languages the most frequent are learned. No rows
    give a model that knows no language.
    """
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counted = usable.groupBy(lang).agg(F.count("*").alias("n")).orderBy(F.desc("n"), lang).limit(MAX_LANGUAGES).collect()
    if not counted:
        return EMPTY
    part = most // len(counted)
    steps = 1_000_000
    threshold = F.lit(0)
    for r in counted:
        threshold = F.when(F.col(lang) == r[lang], min(steps, -(-steps * part // r["n"]))).otherwise(threshold)
    order = F.xxhash64(F.lit("sample"), doc)
    sampled = usable.where(F.pmod(order, F.lit(steps)) < threshold)
    sampled = sampled.select(F.col(lang).cast("string").alias("lang"), order.alias("order"), text)
    sampled = sampled.orderBy("order").limit(most)  # the same texts, however the rows are dealt

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for at in range(0, len(texts), SCORE_TEXTS):
                bits = [r.tobytes() for r in np.packbits(presence(texts[at : at + SCORE_TEXTS]), axis=1)]
                part = batch.slice(at, SCORE_TEXTS)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(bits, pa.binary())], names=["lang", "order", "bits"])

    got = sampled.mapInArrow(pack, "lang string, order bigint, bits binary").toArrow().sort_by("order")
    bits = np.frombuffer(b"".join(got.column("bits").to_pylist()), np.uint8).reshape(got.num_rows, -1)
    langs = np.array(got.column("lang").to_pylist(), object)
    return ridge(np.unpackbits(bits, axis=1).astype(bool), langs) if len(langs) else EMPTY


def scored(
    texts: Sequence[str | None], model: Model, landmarks: np.ndarray, grams: np.ndarray
) -> tuple[list[str], np.ndarray, np.ndarray]:
    rows = presence(texts)
    lettered = rows.any(1)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    values = kernel(rows, landmarks).astype(np.float64) @ model.weights + model.bias
    best = values.argmax(1)
    score = np.clip((values[np.arange(len(texts)), best] + 1) / 2, 0, 1).round(4)
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered, strict=True)]
    return names, np.where(lettered, score, 0.0), lettered & familiar(rows, best, model, grams)


def with_language(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    out: str = "lang_pred",
    out_score: str = "score",
    out_known: str | None = None,
) -> DataFrame:
    """Add the predicted language and a score from 0 to 1. Only the text is looked at. No shuffle.

    ``und`` and 0 for NULL, empty and letterless texts, and for a model that knows no language.
    ``out_known``, if named, tells whether the text has the n-grams of the predicted language; the
    score does not: of K languages the best one scores 1/K or more, whatever the text. Whole texts
    count, however long. Columns with the output names are replaced; rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        landmarks, grams = (np.unpackbits(bits, axis=1).astype(bool) for bits in (known.landmarks, known.usual))
        for texts in batches:
            values, langs, scores, sure = texts.tolist(), [], [], []
            for at in range(0, len(values), SCORE_TEXTS):
                got = scored(values[at : at + SCORE_TEXTS], known, landmarks, grams)
                langs += got[0]
                scores.append(got[1])
                sure.append(got[2])
            both = {"score": np.concatenate([*scores, []]).astype(float), "known": np.concatenate([*sure, []]).astype(bool)}
            yield pd.DataFrame({"lang": langs, **both})

    guess = F.pandas_udf(predict, "lang string, score double, known boolean", F.PandasUDFType.SCALAR_ITER)(F.col(text))
    kept = [c for c in docs.columns if c not in (out, out_score, out_known, "_guess")]
    named = {"lang": out, "score": out_score, **({"known": out_known} if out_known else {})}
    return docs.select(*kept, guess.alias("_guess")).select(
        *kept, *[F.col(f"_guess.{field}").alias(name) for field, name in named.items()]
    )


def held_out(doc: str = "doc_id") -> Column:
    """Documents that are never learned from: a quarter by checksum of the id, and those without id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))
