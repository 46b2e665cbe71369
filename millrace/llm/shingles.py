"""Word shingles of many texts at once, as hashes in numpy arrays; used inside tasks."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np

SHINGLE_WORDS = 5
HASH_BITS = 44  # of a shingle; leaves room for the number of a text above it
CHUNK_CHARS = 1 << 20
GAP, OUT = 0, 1  # codes of white space, which ends a word, and of what is left out of words

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_FILLER = np.uint64(0xD1B54A32D192ED03)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def code_table() -> np.ndarray:
    """Code of every character: letters, digits and marks are told apart without regard to case."""
    table = np.full(0x110000, OUT, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isspace():
            table[i] = GAP
        elif c.isalnum() or unicodedata.category(c)[0] == "M":
            table[i] = ord(c.lower()[0]) + 2
    return table


@functools.cache
def powers(base: int, bits: int) -> np.ndarray:
    """base ** k modulo 2**64 for k below 2**bits."""
    out = np.ones(1, np.uint64)
    for _ in range(bits):
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out


def pieces(texts: Sequence[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts, the long ones cut at white space, in portions of about ``CHUNK_CHARS``."""
    numbers, parts, size = [], [], 0
    for number, text in enumerate(texts):
        at, text = 0, text or ""
        while at < len(text):
            end = at + CHUNK_CHARS
            while end < len(text) and not text[end].isspace():
                end += 1
            numbers.append(number)
            parts.append(text[at:end])
            size, at = size + len(parts[-1]), end
            if size >= CHUNK_CHARS:
                yield numbers, parts
                numbers, parts, size = [], [], 0
    if parts:
        yield numbers, parts


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, text after text, and the number of words of each text."""
    hashes, counts = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    table = code_table()
    for numbers, parts in pieces(texts):
        whole = np.frombuffer("\n".join([*parts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = table[whole]
        place = np.flatnonzero(codes != OUT)
        codes = codes[place]
        inside = np.concatenate([[False], codes != GAP])
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        ends = np.flatnonzero(inside[:-1] & ~inside[1:])  # the last code is a gap
        bits = max(21, int(len(codes)).bit_length())
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers(_BASE, bits)[: len(codes)])])
        hashes.append(mix((sums[ends] - sums[starts]) * powers(_BASE_INVERSE, bits)[starts]))
        bounds = np.cumsum([len(p) + 1 for p in parts])
        per_part = np.diff(np.searchsorted(place[starts], bounds), prepend=0)
        np.add.at(counts, numbers, per_part)
    return np.concatenate(hashes), counts


def shingle_hashes(texts: Sequence[str | None], words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """44-bit hash of every run of ``words`` words, in order, and their number for each text.

    A text with fewer words has one shingle, of all its words; one without words has none.
    """
    hashes, counts = word_hashes(texts)
    short = np.where((counts > 0) & (counts < words), words - counts, 0)
    if short.any():
        hashes = np.insert(hashes, np.repeat(np.cumsum(counts), short), _FILLER)
        counts = counts + short
    if len(hashes) < words:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    total = len(hashes) - words + 1
    runs = np.zeros(total, np.uint64)
    for k in range(words):
        runs += hashes[k : k + total] * np.uint64((_BASE * (2 * k + 3) ** 7) % (1 << 64) | 1)
    last = np.repeat(np.cumsum(counts), counts)[:total]  # end of the text that a run begins in
    good = np.arange(total) + words <= last
    return mix(runs[good]) >> np.uint64(64 - HASH_BITS), np.maximum(counts - words + 1, 0)


def distinct_shingles(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text, how often each occurs, and their number for each text."""
    hashes, counts = shingle_hashes(texts)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    keys = np.sort(owner << np.uint64(HASH_BITS) | hashes)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    per_text = np.bincount((keys >> np.uint64(HASH_BITS)).astype(np.int64), minlength=len(texts))
    return keys & np.uint64((1 << HASH_BITS) - 1), times, per_text


def portions(texts: Sequence[str | None], more: Sequence[str | None] | None = None, chars: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts (or pairs of texts) with about so many characters, which bounds the arrays of a task."""
    first = size = 0
    for k, text in enumerate(texts):
        size += len(text or "") + len(more[k] or "" if more else "")
        if size >= chars or k - first >= 1 << 19:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(texts):
        yield first, len(texts)
