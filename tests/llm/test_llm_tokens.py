"""SentencePiece coding against the library, token counts against plain longest match."""

import math
import random

import numpy as np
import pytest
import sentencepiece
from conftest_llm import ODD, prose

from millrace.llm import sentencepiece as own
from millrace.llm import tokencount


def some_texts(n=600):
    chance = random.Random(5)
    letters = "abc the▁  \n\t0123é漢字😀☃ńfoo.,#\"'()"
    texts = ["".join(chance.choice(letters) for _ in range(chance.randint(0, 50))) for _ in range(n)]
    return [*texts, "a" * 3000, " " * 100, "\n" * 20, prose(500, 4), "Hello, World! don't stop", "x,y;z:###***"]


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), np.int32).tolist()


def test_merge_model_gives_the_ids_of_the_library():
    encoder, decoder = own.Encoder(own.read_model()), own.Decoder(own.read_model())
    library = sentencepiece.SentencePieceProcessor(model_file=own.MODEL)
    for text in some_texts():
        ids = ids_of(encoder, text)
        assert ids == library.encode(text)
        assert decoder.decode(ids) == text.replace("▁", " ")


def test_unigram_model_gives_the_best_score_of_the_library(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(own.MODEL, "rb").read())
    proto.trainer_spec.model_type = own.UNIGRAM
    for i, piece in enumerate(proto.pieces):
        if piece.type == type(piece).NORMAL:
            piece.score = -math.log(i + 2) * 1.7
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    model = own.read_model(str(path))
    encoder, library = own.Encoder(model), sentencepiece.SentencePieceProcessor(model_file=str(path))
    total = lambda ids: sum(model.scores[i] for i in ids)
    for text in some_texts(300):
        mine, theirs = ids_of(encoder, text), library.encode(text)
        assert total(mine) == pytest.approx(total(theirs), rel=1e-5) and (mine == theirs or len(mine) == len(theirs))


def test_encode_and_decode_as_columns(odd, clashing, no_rows):
    library = sentencepiece.SentencePieceProcessor(model_file=own.MODEL)
    for table in (odd, clashing):
        got = own.decode(own.encode(table)).select("text", "ids", "decoded").collect()
        assert len(got) == len(ODD)
        for text, ids, decoded in got:
            assert ids == (None if text is None else library.encode(text))
            assert decoded == (None if text is None else text.replace("▁", " "))
        fused = own.encode(table, out_decoded="decoded").select("text", "ids", "decoded").collect()
        assert sorted(map(str, fused)) == sorted(map(str, got))
    assert own.decode(own.encode(no_rows)).count() == 0


def test_decode_leaves_out_nulls_and_control_ids(rows):
    got = own.decode(rows([([1, None, 22557, 2],), ([],), (None,)], "ids array<int>")).select("decoded").collect()
    assert [r[0] for r in got] == ["Hello", "", None]


def longest_match(pieces, word):
    rest, n = b" " + word.encode(), 0
    while rest:
        k = next((k for k in range(len(rest), 0, -1) if rest[:k] in pieces), None)
        if k is None:
            return 1
        rest, n = rest[k:], n + 1
    return n


def test_counts_are_those_of_greedy_longest_match(odd, clashing, no_rows):
    pieces = set(tokencount.read_pieces())
    for table in (odd, clashing):
        got = tokencount.with_token_counts(table).select("text", "n_words", "n_tokens").collect()
        assert len(got) == len(ODD)
        for text, n_words, n_tokens in got:
            words = tokencount.WORD.findall(text or "")
            known = {w: longest_match(pieces, w) for w in set(words)}
            assert (n_words, n_tokens) == (len(words), sum(known[w] for w in words))
    assert tokencount.with_token_counts(no_rows).count() == 0


def test_automaton_on_small_vocabularies():
    chance = random.Random(3)
    for _ in range(300):
        pieces = {bytes(chance.choice(b"ab ") for _ in range(chance.randint(1, 4))) for _ in range(chance.randint(1, 8))}
        automaton = tokencount.LongestMatch(pieces)
        for _ in range(20):
            word = "".join(chance.choice("ab") for _ in range(chance.randint(0, 9)))
            assert automaton.count(word) == longest_match(pieces, word)
