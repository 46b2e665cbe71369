"""Token counts: greedy longest-match word pieces counted in one pass over the bytes.

The vocabulary is a trie with failure links. Where a node has no child for the next byte, the
longest-match pieces at the head of what was read are certain; how many they are was computed
beforehand, and the failure link leads to the node of what is left. Every byte is read once and
no piece is ever built.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MARK = b" "
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# A vocabulary is broadcast, so its size is bounded; words remembered by a task are bounded too.
MAX_VOCABULARY_BYTES = 64 << 20
REMEMBERED_WORDS = 300_000
REMEMBERED_LENGTH = 64


def read_pieces(path: str = VOCABULARY) -> list[bytes]:
    """Pieces of a rank file: a base64 piece and its rank on each line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class LongestMatch:
    """Counts the pieces that greedy longest match cuts ``mark + word`` into.

    A word of which some part matches no piece counts as one unknown token.
    """

    def __init__(self, pieces: Iterable[bytes], mark: bytes = MARK) -> None:
        self.mark = mark
        child: dict[int, int] = {}
        ends = [False]
        parent = [(0, 0)]
        for piece in pieces:
            node = 0
            for byte in piece:
                edge = node << 8 | byte
                if edge not in child:
                    child[edge] = len(ends)
                    ends.append(False)
                    parent.append((node, byte))
                node = child[edge]
            ends[node] = node != 0
        fail: list[int] = [-1] * len(ends)  # -1: what was read has no beginning that is a piece
        popped = [0] * len(ends)
        below: list[list[int]] = [[] for _ in ends]
        for node in range(1, len(ends)):
            below[parent[node][0]].append(node)
        queue = deque(below[0])
        while queue:
            node = queue.popleft()
            queue.extend(below[node])
            up, byte = parent[node]
            if ends[node]:
                fail[node], popped[node] = 0, 1
                continue
            at, n = fail[up], popped[up]
            while at != -1 and at << 8 | byte not in child:
                n += popped[at]
                at = fail[at]
            if at != -1:
                fail[node], popped[node] = child[at << 8 | byte], n
        self.child, self.fail, self.popped = child, fail, popped

    def count(self, word: str) -> int:
        child, fail, popped = self.child, self.fail, self.popped
        node = n = 0
        for byte in self.mark + word.encode("utf-8", "surrogatepass"):
            nxt = child.get(node << 8 | byte)
            while nxt is None:
                if fail[node] == -1:
                    return 1
                n += popped[node]
                node = fail[node]
                nxt = child.get(node << 8 | byte)
            node = nxt
        while node:
            if fail[node] == -1:
                return 1
            n += popped[node]
            node = fail[node]
        return n


class Counts(dict):
    """Counts of words already seen by a task, up to a bound."""

    def __init__(self, automaton: LongestMatch) -> None:
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(word)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = n
        return n


_counts: dict[str, Counts] = {}  # of this Python worker, which serves many tasks


def remembered(key: str, pieces: list[bytes], mark: bytes) -> Counts:
    if key not in _counts:
        _counts.clear()
        _counts[key] = Counts(LongestMatch(pieces, mark))
    return _counts[key]


def with_token_counts(
    docs: DataFrame,
    text: str = "text",
    vocabulary: str = VOCABULARY,
    mark: bytes = MARK,
    out: str = "n_tokens",
    out_words: str = "n_words",
) -> DataFrame:
    """Add how many words ``[^\\x20\\x09-\\x0D]+`` and how many word pieces a text has (bigint).

    Each word is read with ``mark`` before it, which is how the vocabulary tells the beginning
    of a word from its inside. No shuffle: every text is counted where it is read.

    NULL, empty and blank texts have 0 words and 0 tokens. A word with bytes that no piece
    begins with is one token. Columns with the output names are replaced; rows stay as they
    are, repeated ones too.
    """
    pieces = read_pieces(vocabulary)
    if sum(map(len, pieces)) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary is larger than {MAX_VOCABULARY_BYTES} bytes")
    key = hashlib.sha256(b"\n".join([mark, *pieces])).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        seen = remembered(key, shared.value, mark)
        for texts in batches:
            n_words, n_tokens = [], []
            for value in texts:
                words = WORD.findall(value) if value else []
                n_words.append(len(words))
                n_tokens.append(sum(map(seen.__getitem__, words)))
            yield pd.DataFrame({"words": n_words, "tokens": n_tokens}, dtype="int64")

    counted = F.pandas_udf(count, "words bigint, tokens bigint", F.PandasUDFType.SCALAR_ITER)(F.col(text))
    kept = [c for c in docs.columns if c not in (out, out_words, "_counted")]
    return docs.select(*kept, counted.alias("_counted")).select(
        *kept, F.col("_counted.words").alias(out_words), F.col("_counted.tokens").alias(out)
    )
