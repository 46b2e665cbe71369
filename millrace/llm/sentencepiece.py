"""SentencePiece encoding and decoding over the pieces of a given model.

An Aho-Corasick automaton over all pieces reads a text once. At every position its output
links give the pieces that end there, and each relaxes the best way to reach the position
(Viterbi). For a unigram model the score of a way is the sum of its pieces' scores. For a merge
(BPE) model it is 0 if every two neighbours are what merging makes of the two together, and
minus infinity else: exactly one way has score 0, and it is what merging makes of the text.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # stands for a blank inside pieces
UNIGRAM, BPE = 1, 2
PUNCTUATION = ".,;:!?#*$%&|<>\"'()[]{}-+=/\\~`^@"
UNKNOWN_PENALTY = 10.0  # an unknown character scores this much below the worst piece

# A model is broadcast, so its size is bounded; what a task remembers is bounded too.
MAX_MODEL_PIECES = 1 << 20
REMEMBERED_WORDS = 250_000
REMEMBERED_CHUNKS = 200_000
REMEMBERED_LENGTH = 64
PAIR_BITS = 20  # of the table of pairs
PAIR_SPREAD = np.int64(-7046029254386353131)
PORTION = 1 << 17  # characters that are looked at together
PART_WORDS = 1 << 16  # words that are encoded together
SLICE = 2 << 20


@dataclass(frozen=True)
class Model:
    """What encoding needs of a model file."""

    key: str
    kind: int
    pieces: list[str]  # by id
    scores: list[float]
    usable: list[bool]  # may be part of a text: neither control, unknown nor byte
    byte_ids: list[int]  # id of each of the 256 bytes, or empty
    unknown: int
    dummy_prefix: bool


def read_model(path: str = MODEL) -> Model:
    from sentencepiece import sentencepiece_model_pb2

    with open(path, "rb") as file:
        raw = file.read()
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(raw)
    kinds = type(proto.pieces[0])
    if len(proto.pieces) > MAX_MODEL_PIECES:
        raise ValueError(f"the model has more than {MAX_MODEL_PIECES} pieces")
    rule = proto.normalizer_spec
    if rule.precompiled_charsmap or rule.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models that leave the text as it is are supported")
    if proto.trainer_spec.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    by_byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
    return Model(
        key=hashlib.sha256(raw).hexdigest(),
        kind=proto.trainer_spec.model_type,
        pieces=[p.piece for p in proto.pieces],
        scores=[p.score for p in proto.pieces],
        usable=[p.type in (kinds.NORMAL, kinds.USER_DEFINED) for p in proto.pieces],
        byte_ids=[by_byte[b] for b in range(256)] if len(by_byte) == 256 else [],
        unknown=next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN),
        dummy_prefix=rule.add_dummy_prefix,
    )


class Seen(dict):
    """What was seen last, in two generations: a full one becomes the old one, and what is asked for
    again moves over, so that frequent words stay."""

    def __init__(self, most: int) -> None:
        self.most, self.old = most, {}

    def unknown(self, texts: set[str]) -> list[str]:
        """Texts not seen; the others can be looked up until the next call."""
        if len(self) >= self.most // 2:
            self.old = dict(self)
            self.clear()
        new = [t for t in texts if t not in self]
        again = {t: ids for t in new if (ids := self.old.get(t)) is not None}
        self.update(again)
        return [t for t in new if t not in again] if again else new


class Encoder:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.ids = {p: i for i, p in enumerate(model.pieces) if model.usable[i]}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.sizes = np.array([len(p) for p in model.pieces], np.int64)
        self.unknown_score = min((model.scores[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY
        self.characters = set().union(*self.ids)
        self.singles = {p for p in self.ids if len(p) == 1}
        self.gap = next(c for c in map(chr, range(0x110000)) if c not in self.characters)
        self.rises: dict[int, tuple[list, list] | None] = {}
        self.apart_key = np.full(1 << PAIR_BITS, -1, np.int64)
        self.apart_value = np.zeros(1 << PAIR_BITS, bool)
        self.chunks, self.words = Seen(REMEMBERED_CHUNKS), Seen(REMEMBERED_WORDS)
        self.cut = self.boundaries()

    def boundaries(self) -> re.Pattern | None:
        """Chunks that no piece reaches over, which can be encoded and remembered one by one.

        Where no piece holds a blank after another character, a text falls apart before blanks;
        so it does around newlines if no piece holds one, and after a run of letters before a
        character that no piece holds after a letter.
        """
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            return None
        follow = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if a.isalpha()}
        alone = "" if "\n" in self.characters else "\n"
        apart = "".join(re.escape(c) for c in PUNCTUATION if c not in follow) + alone + SPACE
        letters = rf"{SPACE}*[^\W\d_]+(?=[{apart}])"
        return re.compile(rf"{letters}|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|{alone}" if alone else ""))

    def rise(self, i: int) -> tuple[list, list] | None:
        """How merging by score makes a piece of its characters: for each merge its score and the symbol that is
        then at the left edge, and the same for the right edge. None if it never becomes one piece.

        Such a piece is in no text: nothing outside its characters takes part in their merging.
        """
        if i in self.rises:
            return self.rises[i]
        ids, scores = self.ids, self.model.scores
        symbols = list(self.model.pieces[i])
        left, right = [(0.0, symbols[0])], [(0.0, symbols[-1])]
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                made = ids.get(symbols[k] + symbols[k + 1])
                if made is not None and (best is None or scores[made] > best):
                    best, at = scores[made], k
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            left.append((best, symbols[0]))
            right.append((best, symbols[-1]))
        self.rises[i] = (left, right) if len(symbols) == 1 else None
        return self.rises[i]

    def apart(self, left: int, right: int) -> bool:
        """Whether merging leaves two neighbouring pieces (-1: none) as they are.

        Both rise merge by merge, the better score first, until a merge across their border is better
        than the next one of either: then they are not left apart.
        """
        if left < 0:
            return self.rise(right) is not None
        ours, theirs = self.rise(left), self.rise(right)
        if ours is None or theirs is None:
            return False
        ids, scores, ours, theirs = self.ids, self.model.scores, ours[1], theirs[0]
        a = b = 0
        worst = float("-inf")
        while True:
            next_a = ours[a + 1][0] if a + 1 < len(ours) else worst
            next_b = theirs[b + 1][0] if b + 1 < len(theirs) else worst
            across = ids.get(ours[a][1] + theirs[b][1])
            # of equal scores the merge further left is first
            if across is not None and scores[across] > next_a and scores[across] >= next_b:
                return False
            if next_a == next_b == worst:
                return True
            if next_a >= next_b:
                a += 1
            else:
                b += 1

    def all_apart(self, keys: np.ndarray) -> np.ndarray:
        """:meth:`apart` for pairs ``(left + 1) << 20 | right``; what was asked last is kept in a table."""
        slot = (keys * PAIR_SPREAD).view(np.uint64) >> np.uint64(64 - PAIR_BITS)
        good = self.apart_value[slot]
        new = np.flatnonzero(self.apart_key[slot] != keys)
        if len(new):
            pairs, inverse = np.unique(keys[new], return_inverse=True)
            values = np.array([self.apart((k >> 20) - 1, k & 0xFFFFF) for k in pairs.tolist()], bool)
            good[new] = values[inverse]
            at = slot[new]
            self.apart_key[at], self.apart_value[at] = -1, False
            at = (pairs * PAIR_SPREAD).view(np.uint64) >> np.uint64(64 - PAIR_BITS)
            at, kept = np.unique(at, return_index=True)  # of pairs with one slot the first is kept
            self.apart_key[at], self.apart_value[at] = pairs[kept], values[kept]
        return good

    def best_sum(self, chunk: str) -> list[tuple[int, int]]:
        """Unigram: for every position the start and id of the last piece of the best way to it."""
        scores = self.model.scores
        best = [0.0] + [float("-inf")] * len(chunk)
        last = [(0, 0)] * (len(chunk) + 1)
        settled, single = 0, False

        def settle(stop: int) -> None:
            """A character is unknown where no piece is just that character."""
            nonlocal settled, single
            while settled < stop:
                if not single and best[settled] + self.unknown_score > best[settled + 1]:
                    best[settled + 1] = best[settled] + self.unknown_score
                    last[settled + 1] = (settled, -1 - settled)
                settled, single = settled + 1, False

        for end, i in self.automaton.iter(chunk):
            settle(end)
            size = len(self.model.pieces[i])
            start = end + 1 - size
            single = single or size == 1
            if best[start] + scores[i] > best[end + 1]:
                best[end + 1] = best[start] + scores[i]
                last[end + 1] = (start, i)
        settle(len(chunk))
        return last

    def best_merge(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """BPE: ids of the one way on which all neighbours stay apart, for many chunks at once, and where
        the ids of each chunk end.

        One pass of the automaton over all of them gives every piece that ends at every position. The positions are
        then settled from the first of each chunk to the last: a piece leads to its end if it
        stays apart from the last piece of the way to its start. A character without a piece
        (-2 - character) stands between as one of its own.
        """
        whole = self.gap.join([*chunks, ""])
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        ends = np.cumsum(lengths + 1)
        starts = ends - lengths - 1
        matches = np.fromiter(itertools.chain.from_iterable(self.automaton.iter(whole)), np.int64).reshape(-1, 2)
        end, piece = matches[:, 0] + 1, matches[:, 1]
        begin = end - self.sizes[piece]
        last = np.full(len(whole) + 1, -1, np.int64)
        depth = end - starts[np.searchsorted(ends, end)]
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        # a character that no piece of one character is may be unknown, where no longer piece ends with it
        single = np.zeros(len(whole) + 1, bool)
        single[end[self.sizes[piece] == 1]] = True
        odd = np.flatnonzero(~single[1:]) + 1
        odd = odd[whole_positions(odd, starts, ends)]
        odd_depth = odd - starts[np.searchsorted(ends, odd)]
        order, odd_order = np.argsort(depth, kind="stable"), np.argsort(odd_depth, kind="stable")
        steps = np.arange(1, (int(lengths.max()) if len(lengths) else 0) + 2)
        bounds, odd_bounds = np.searchsorted(depth[order], steps), np.searchsorted(odd_depth[odd_order], steps)
        for k in range(len(steps) - 1):
            at = order[bounds[k] : bounds[k + 1]]
            if len(at):
                before = np.maximum(last[begin[at]], -1)  # after an unknown character as at the start
                good = at[self.all_apart((before + 1) << 20 | piece[at])]
                last[end[good]] = piece[good]
            lone = odd[odd_order[odd_bounds[k] : odd_bounds[k + 1]]]
            if len(lone):
                lone = lone[last[lone] == -1]
                last[lone] = -2 - codes[lone - 1]
        # back from the ends, all chunks one piece at a time
        used = np.zeros(len(whole) + 1, bool)
        at, stop = ends - 1, starts
        going = at > stop
        at, stop = at[going], stop[going]
        while len(at):
            used[at] = True
            at = at - np.where(last[at] >= 0, self.sizes[last[at]], 1)
            going = at > stop
            at, stop = at[going], stop[going]
        places = np.flatnonzero(used)
        return last[places], np.searchsorted(places, ends, "left")

    def best_way(self, chunk: str) -> list[int]:
        """Unigram: ids of the best way through a chunk; -2 - character for a character without a piece."""
        last = self.best_sum(chunk)
        ids, at = [], len(chunk)
        while at:
            at, i = last[at]
            ids.append(i if i >= 0 else -2 - ord(chunk[-1 - i]))
        ids.reverse()
        return ids

    def encode_chunks(self, chunks: list[str]) -> Iterator[bytes]:
        """Ids of each chunk, each as four bytes."""
        if self.model.kind == BPE:
            ids, ends = self.best_merge(chunks)
        else:
            ways = [self.best_way(chunk) for chunk in chunks]
            ids, ends = np.array([i for way in ways for i in way], np.int64), np.cumsum([len(way) for way in ways])
        odd = np.flatnonzero(ids < 0)
        spelled = set(np.searchsorted(ends, odd, "right").tolist())
        whole, first = ids.astype(np.int32).tobytes(), 0
        for k, stop in enumerate(ends.tolist()):
            yield np.array(self.spelled(ids[first:stop].tolist()), np.int32).tobytes() if k in spelled else whole[4 * first : 4 * stop]
            first = stop

    def spelled(self, way: list[int]) -> list[int]:
        """Characters without a piece as bytes, or as one unknown id a run."""
        ids: list[int] = []
        for i in way:
            if i >= 0:
                ids.append(i)
            elif self.model.byte_ids:
                ids.extend(self.model.byte_ids[b] for b in chr(-2 - i).encode("utf-8", "surrogatepass"))
            elif not ids or ids[-1] != self.model.unknown:
                ids.append(self.model.unknown)
        return ids

    def learn(self, chunks: set[str]) -> None:
        """Encode the chunks that are not known yet, portion by portion."""
        new, size = [], 0
        for chunk in self.chunks.unknown(chunks):
            new.append(chunk)
            size += len(chunk)
            if size >= PORTION:
                self.chunks.update(zip(new, self.encode_chunks(new), strict=True))
                new, size = [], 0
        self.chunks.update(zip(new, self.encode_chunks(new), strict=True))

    def parts(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """A text as lists of bounded size: of words with one blank before each (True), or of chunks."""
        plain = self.cut and self.model.dummy_prefix and text[0] != " " != text[-1] and "  " not in text and SPACE not in text
        if plain:
            words = text.split(" ")
            for k in range(0, len(words), PART_WORDS):
                yield True, words[k : k + PART_WORDS]
            return
        text = ((" " if self.model.dummy_prefix else "") + text).replace(" ", SPACE)
        if self.cut is None:
            yield False, [text]
            return
        cut = (m.group() for m in self.cut.finditer(text))
        while some := list(itertools.islice(cut, PART_WORDS)):
            yield False, some

    def encode_all(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text, each as four bytes. What a task remembers is emptied beyond its bounds."""
        out: list[list[bytes]] = []
        waiting: list[tuple[int, bool, list[str]]] = []
        size = 0
        for k, text in enumerate(texts):
            out.append([])
            for plain, part in self.parts(text) if text else ():
                waiting.append((k, plain, part))
                size += len(part)
                if size >= PART_WORDS:
                    self.encode_parts(waiting, out)
                    waiting, size = [], 0
        self.encode_parts(waiting, out)
        return [b"".join(ids) for ids in out]

    def encode_parts(self, waiting: list[tuple[int, bool, list[str]]], out: list[list[bytes]]) -> None:
        words, chunks = set(), set()
        for _, plain, part in waiting:
            (words if plain else chunks).update(part)
        cut = {word: self.cut.findall(SPACE + word) for word in self.words.unknown(words)}
        chunks.update(itertools.chain.from_iterable(cut.values()))
        self.learn(chunks)
        known = self.chunks.__getitem__
        self.words.update({word: b"".join(map(known, pieces)) for word, pieces in cut.items()})
        for k, plain, part in waiting:
            out[k].append(b"".join(map((self.words if plain else self.chunks).__getitem__, part)))
        for seen in (self.words, self.chunks):
            for long in [w for w in (cut if seen is self.words else chunks) if len(w) > REMEMBERED_LENGTH]:
                seen.pop(long, None)

    def encode(self, text: str) -> bytes:
        """Ids of a text, each as four bytes."""
        return self.encode_all([text])[0]


def whole_positions(places: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which places are the end of a character of a chunk and not of the gap behind it."""
    owner = np.minimum(np.searchsorted(ends, places), len(ends) - 1)
    return (places > starts[owner]) & (places < ends[owner])


class Decoder:
    def __init__(self, model: Model) -> None:
        self.dummy_prefix = model.dummy_prefix
        table = [p.replace(SPACE, " ").encode() if u else b"" for p, u in zip(model.pieces, model.usable, strict=True)]
        for byte, i in enumerate(model.byte_ids):
            table[i] = bytes([byte])
        table[model.unknown] = " ⁇ ".encode()
        self.bytes_of = pa.array(table, pa.binary())

    def decode(self, ids: Sequence[int]) -> str:
        return self.texts(np.array([0, len(ids)]), np.asarray(ids, np.int32))[0]

    def texts(self, ends: np.ndarray, ids: np.ndarray) -> list[str]:
        """Texts of the lists of ids that end at ``ends[1:]``: the bytes of all of them are taken together."""
        taken = self.bytes_of.take(pa.array(ids))
        bounds = taken.buffers()[1]
        offsets = np.frombuffer(bounds, np.int32)[: len(ids) + 1][ends].tolist() if len(ids) else [0] * len(ends)
        whole = taken.buffers()[2].to_pybytes() if len(ids) and taken.buffers()[2] else b""
        texts = [whole[i:j].decode("utf-8", "replace") for i, j in zip(offsets, offsets[1:])]
        return [t[1:] if self.dummy_prefix and t.startswith(" ") else t for t in texts]


_made: dict[tuple[str, type], Encoder | Decoder] = {}  # of this Python worker, which serves many tasks


def remembered(kind: type, model: Model) -> Encoder | Decoder:
    if (model.key, kind) not in _made:
        _made[model.key, kind] = kind(model)
    return _made[model.key, kind]


def slices(rows: pa.Array, sizes: pa.Array) -> Iterator[pa.Array]:
    """Runs of rows with about ``SLICE`` bytes or ids, which bounds what a task builds at a time."""
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(rows):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + SLICE, "right")))
        yield rows.slice(at, end - at)
        at = end


def decoded_array(lists: pa.ListArray, decoder: Decoder) -> pa.Array:
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    known = lists.is_valid().to_numpy(zero_copy_only=False)
    base = int(ends[0])
    texts = decoder.texts(ends - base, flat[base : int(ends[-1])])
    return pa.array(texts, pa.string(), mask=~known)


def encode(
    docs: DataFrame, text: str = "text", model: str = MODEL, out: str = "ids", out_decoded: str | None = None
) -> DataFrame:
    """Add the piece ids of each text as ``out`` (array<int>). No shuffle.

    The ids are those of the sentencepiece library. NULL stays NULL, an empty text gives an
    empty list. Characters without a piece become bytes, or one unknown id per run in models
    without byte pieces. With ``out_decoded`` the ids are decoded again by the same task, as
    :func:`decode` does. Columns with the output names are replaced; rows stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = remembered(Encoder, shared.value), remembered(Decoder, shared.value)
        for texts in batches:
            for part in slices(texts, pc.binary_length(texts)):
                encoded = encoder.encode_all(part.to_pylist())
                ends = np.cumsum([0, *(len(e) // 4 for e in encoded)], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(encoded), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends), values, mask=part.is_null())
                back = decoded_array(lists, decoder) if out_decoded else pa.nulls(len(part), pa.string())
                yield pa.StructArray.from_arrays([lists, back], names=["ids", "decoded"])

    kind = "struct<ids:array<int>,decoded:string>"
    coded = F.arrow_udf(ids, kind, F.ArrowUDFType.SCALAR_ITER)(F.col(text)).alias("_coded")
    names = [out, *([out_decoded] if out_decoded else [])]
    kept = [c for c in docs.columns if c not in (*names, "_coded")]
    made = [F.col(f"_coded.{f}").alias(n) for f, n in zip(("ids", "decoded"), names, strict=False)]
    return docs.select(*kept, coded).select(*kept, *made)


def decode(rows: DataFrame, ids: str = "ids", model: str = MODEL, out: str = "decoded") -> DataFrame:
    """Add the text of a list of ids as ``out``. No shuffle.

    NULL stays NULL, an empty list gives ``''``; NULL ids and control ids are left out. Bytes that
    are not UTF-8 become U+FFFD. A character that stands for a blank inside pieces (U+2581)
    comes back as a blank, as it does in the sentencepiece library; all other texts come back
    as they were. A column named ``out`` is replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast(read_model(model))

    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = remembered(Decoder, shared.value)
        for lists in batches:
            for part in slices(lists, pc.list_value_length(lists)):
                yield decoded_array(part, decoder)

    given = F.filter(F.col(ids), lambda i: i.isNotNull())
    return rows.withColumn(out, F.arrow_udf(texts, "string", F.ArrowUDFType.SCALAR_ITER)(given))
