"""Periodic runs: stretches of words that repeat with a period at least four times in a row.

Inside a task many texts are laid one after the other as one array of word numbers, and all steps
are done for all of them at once in numpy.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# A run is at least so many words long and at least so many of its periods.
MIN_WORDS, MIN_TIMES = 6, 4

# A difference cover: every distance modulo PERIOD is one between two members of COVER.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
PORTION_CHARS = 2 << 20
PAIRS = 1 << 20  # grid pairs looked at together
WORD_BITS = 21  # of three words packed into one number


def split_words(text: str | None) -> list[bytes]:
    """Words of a text: what stands between blanks, tabs and line ends of ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def plant(words: list[bytes], doc_id) -> list[bytes]:
    """Every tenth document, by the CRC of its id, goes on with a repeated part of itself."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * ((n - a) // p + 1))[: n - a]


class Matches:
    """How far two places of an array read alike, in constant time after sorting a sample of suffixes.

    Sampled are the places whose number modulo PERIOD is in the difference cover, so that for any two places a
    small step, the same for both, leads to two sampled ones. A question compares the words up to
    there; if all are equal, the rest is the smallest common prefix of neighbours between the two
    in suffix order, by a sparse table.
    """

    _step = np.array(
        [[next(d for d in range(PERIOD) if (i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER)
          for j in range(PERIOD)] for i in range(PERIOD)], np.int64)

    def __init__(self, values: np.ndarray):
        """``values`` (>= 1) must contain a value found nowhere else after each text."""
        # beyond the end every place reads 0, which stands in no text
        self.n = len(values)
        self.x = np.concatenate([values.astype(np.int64), np.zeros(4 * PERIOD, np.int64)])
        places = np.arange(self.n)
        self.sample = places[np.isin(places % PERIOD, COVER)]
        self._sort()

    def _ranked(self, keys: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order by keys (first counts most), the rank of every entry, and whether it differs from the one before."""
        order = np.lexsort(tuple(reversed(keys))) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
        new = np.zeros(len(order), bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return order, rank, new

    def _sort(self) -> None:
        m = len(self.sample)
        self.number = np.full(self.n + 4 * PERIOD, m, np.int64)  # of a sampled place in the sample
        self.number[self.sample] = np.arange(m)
        words = [self.x[self.sample + t] for t in range(PERIOD)]
        if self.x.max() < 1 << WORD_BITS:
            words = [a << 2 * WORD_BITS | b << WORD_BITS | c for a, b, c in zip(*[iter(words)] * 3)]
        order, rank, new = self._ranked(words)
        ranks = [rank]  # ranks[k]: by the first PERIOD * 2**k words
        width = PERIOD
        while len(rank) and rank.max() + 1 < m:
            later = np.append(rank + 1, 0)[self._number_of(self.sample + width)]
            order, rank, new = self._ranked([rank, later])
            ranks.append(rank)
            width *= 2
        self.rank = rank
        # common prefix of each suffix with the one before it in the order
        lcp = np.zeros(m, np.int64)
        if m > 1:
            a, b = self.sample[order[:-1]].copy(), self.sample[order[1:]].copy()
            whole = np.zeros(m - 1, np.int64)
            for k in range(len(ranks) - 1, -1, -1):
                known = np.append(ranks[k], -1)
                ia, ib = self._number_of(a), self._number_of(b)
                same = (known[ia] == known[ib]) & (ia < m) & (ib < m)
                step = np.where(same, PERIOD << k, 0)
                a, b, whole = a + step, b + step, whole + step
            lcp[1:] = whole + self._compared(a, b, np.full(m - 1, PERIOD))
        self.table = [lcp]
        while 2 << (len(self.table) - 1) <= m:
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _number_of(self, places: np.ndarray) -> np.ndarray:
        return self.number[np.minimum(places, self.n)]

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, at most ``most`` (up to PERIOD) of them."""
        length = np.zeros(len(i), np.int64)
        at = np.flatnonzero(most > 0)
        for t in range(PERIOD):
            at = at[(self.x[np.minimum(i[at] + t, self.n)] == self.x[np.minimum(j[at] + t, self.n)]) & (t < most[at])]
            if not len(at):
                break
            length[at] += 1
        return length

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common beginning of what follows i and j (i < j)."""
        step = self._step[i % PERIOD, j % PERIOD]
        length = self._compared(i, j, step)
        at = np.flatnonzero(length == step)
        ni, nj = self._number_of(i[at] + step[at]), self._number_of(j[at] + step[at])
        inside = (ni < len(self.sample)) & (nj < len(self.sample))
        at, ni, nj = at[inside], ni[inside], nj[inside]
        low, high = self.rank[ni], self.rank[nj]
        low, high = np.minimum(low, high) + 1, np.maximum(low, high) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            of = level == k
            table = self.table[k]
            length[at[of]] += np.minimum(table[low[of]], table[high[of] - (1 << int(k))])
        return length


def grid_hits(x: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods of the harmonic grid where a run may be: ``(g, p)``.

    The words of a run with period p match those p later over at least three periods, so
    three multiples of p in a row match (counted from the beginning of the text). All periods of
    all texts are gone through, a harmonic sum of places, in portions of bounded size.
    """
    most = counts // MIN_TIMES  # largest period of each text
    owner = np.repeat(np.arange(len(counts)), most)
    period = np.arange(len(owner)) - np.repeat(np.cumsum(most) - most, most) + 1
    places = (counts[owner] - 1) // period - 2  # multiples k with (k + 3) * period inside
    ends = np.cumsum(places)
    at = 0
    while at < len(owner):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS)))
        c, p = places[at:stop], period[at:stop]
        k = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        p, first = np.repeat(p, c), np.repeat(starts[owner[at:stop]], c)
        g = first + k * p
        good = np.flatnonzero(x[g] == x[g + p])
        g, p = g[good], p[good]
        end = first[good] + np.repeat(counts[owner[at:stop]], c)[good]
        for times in (2, 3):
            ok = g + times * p < end
            g, p, end = g[ok], p[ok], end[ok]
            same = x[g] == x[g + times * p]
            g, p, end = g[same], p[same], end[same]
        if len(g):
            yield g, p
        at = stop


def find_runs(texts: Sequence[Sequence]) -> list[list[tuple[int, int, int]]]:
    """Runs of each text, a sequence of words: ``(start, length, period)`` by start, then period."""
    numbers: defaultdict = defaultdict(itertools.count(1).__next__)
    flat = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts]
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    counts = np.array([len(w) for w in flat], np.int64)
    if not len(flat) or counts.max() < MIN_TIMES:
        return found
    starts = np.cumsum(counts) - counts
    hits = [(g.astype(np.int32), p.astype(np.int32)) for g, p in grid_hits(np.concatenate(flat), starts, counts)]
    if not hits:
        return found
    g, p = (np.concatenate(part) for part in zip(*hits))
    # suffixes are sorted of texts with hits alone, each behind a number of its own
    owner = np.searchsorted(starts, g, side="right") - 1
    wanted = np.unique(owner)
    base, at = np.zeros(len(flat), np.int64), 1
    parts = [np.array([len(numbers) + 1])]
    for order, k in enumerate(wanted):
        base[k] = at
        parts += [flat[k], np.array([len(numbers) + 2 + order])]
        at += len(flat[k]) + 1
    x = np.concatenate(parts)
    x = np.unique(x, return_inverse=True)[1] + 1  # small numbers: three are packed into one
    i = g - starts[owner] + base[owner]
    ahead, back = Matches(x), Matches(x[::-1])
    stretches = np.zeros((0, 4), np.int64)
    for at in range(0, len(i), PAIRS):
        part = slice(at, at + PAIRS)
        new = np.column_stack([*stretch(ahead, back, i[part], p[part]), p[part], owner[part]])
        new = new[(new[:, 1] >= MIN_TIMES * new[:, 2]) & (new[:, 1] >= MIN_WORDS)]
        # of periods of one stretch the smallest counts; the others are its multiples
        stretches = np.concatenate([stretches, new])
        stretches = stretches[np.lexsort((stretches[:, 2], stretches[:, 1], stretches[:, 0]))]
        first = np.ones(len(stretches), bool)
        first[1:] = (stretches[1:, :2] != stretches[:-1, :2]).any(axis=1)
        stretches = stretches[first]
    for s, size, period, k in stretches[np.lexsort((stretches[:, 2], stretches[:, 0]))].tolist():
        found[k].append((s - int(base[k]), size, period))
    return found


def stretch(ahead: Matches, back: Matches, i: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the longest stretch with period p around each place i; ``back`` reads backwards."""
    after = ahead.extend(i, i + p)
    before = back.extend(back.n - (i + p), back.n - i)
    return i - before, before + after + p


def collapsed(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return list(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    keep = np.cumsum(edge)[:-1] == 0
    return list(itertools.compress(words, keep))


SCHEMA = (
    "doc_id {id}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)
RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
TYPES = {**{k: pa.int64() for k in range(1, 6)}, 6: pa.string(), 7: pa.string(), 8: RUNS, 9: pa.string()}
FULL = ", runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def row_of(words: list[bytes], runs: list[tuple[int, int, int]], full: bool) -> tuple:
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
    kept = b" ".join(collapsed(words, runs))
    row = (len(runs), *top, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())
    if not full:
        return row
    return (*row, [dict(zip(("start", "length", "period"), r)) for r in runs], kept.decode("utf-8", "surrogatepass"))


def portions(texts: Sequence[str | None]) -> Iterator[range]:
    """Ranges of texts of about ``PORTION_CHARS``; a longer text is one alone."""
    first = size = 0
    for k, text in enumerate(texts):
        size += len(text or "") + 1
        if size >= PORTION_CHARS:
            yield range(first, k + 1)
            first, size = k + 1, 0
    if first < len(texts):
        yield range(first, len(texts))


def periodic_runs(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", planted: bool = False, full: bool = False
) -> DataFrame:
    """Find the runs of every text: a row for every row of ``docs``.

    ``doc_id`` (as the column ``doc``), ``n_runs``, the strongest run (``start, length, period, exponent_milli``; greatest
    length by period, then smallest start, then period; NULL without a run), ``runs_sha256`` over all runs and
    ``collapsed_sha256`` over the text in which only the first period of every run is kept. With ``full`` also ``runs``
    and ``collapsed`` themselves. With ``planted`` every tenth document is first made periodic by a rule on its id.

    A run is a stretch of words with smallest period q that is at least ``MIN_WORDS`` and ``MIN_TIMES`` q words long and
    that no neighbouring word extends. Every run is found, in whole texts, by comparing the places of
    a harmonic grid: work grows with n log n in the words of a text. Rows are independent: nothing is shuffled.

    NULL, empty and blank texts have no words and no runs. A NULL id comes back as NULL and is not planted. Repeated
    rows are repeated. Other columns are not read, so no names clash. An empty table gives no rows.
    """
    kind = docs.select(F.col(doc)).schema[0].dataType.simpleString()
    schema = SCHEMA.format(id=kind) + (FULL if full else "")
    names = [part.split()[0] for part in SCHEMA.split(", ")] + (["runs", "collapsed"] if full else [])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            lengths = column.to_pylist()
            for part in portions(lengths):
                keys = ids.slice(part.start, len(part))
                words = [split_words(lengths[k]) for k in part]
                if planted:
                    words = [plant(w, key) for w, key in zip(words, keys.to_pylist())]
                rows = [row_of(w, runs, full) for w, runs in zip(words, find_runs(words))]
                columns = [pa.array(c, TYPES[k]) for k, c in enumerate(zip(*rows), 1)]
                yield pa.RecordBatch.from_arrays([keys, *columns], names)

    return docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(scan, schema)

