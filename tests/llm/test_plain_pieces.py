"""Pieces of plain texts by byte classes: the rules of the expression, and each piece looked up once."""

import random

import numpy as np

from biblioforge.llm import bpe, token_orc

ODD = [None, "", " ", "\n\t", "a", "it's", "'s", "''s x", "\"'sx'llama", "...a..1234b,é", "ÀÉÎ straße ß", "x\x1cy\x1fz \x0b\x0c a", "<|end|> b", "漢字 abc", "\x00 \x7f", "I'LL DON'T", "a'r'v'l're've'm'd'"]


def texts():
    r = random.Random(3)
    return ODD + ["".join(r.choice("aAbs'’tlrevmd. ,;1 9\n\téÄß-\"\x1c") for _ in range(r.randint(0, 60))) for _ in range(3000)]


def test_plain_pieces_are_those_of_the_expression():
    folded = [t for t in map(bpe.folded, texts()) if t is not None]
    pieces, count = bpe.plain_pieces(folded)
    want = [bpe._PLAIN.findall(t) for t in folded]
    assert pieces.to_pylist() == [p for w in want for p in w] and count.tolist() == list(map(len, want))
    assert bpe.plain_pieces([])[1].tolist() == [] and bpe.plain_pieces([b"", b""])[1].tolist() == [0, 0]


def test_ids_are_the_librarys_and_each_piece_of_a_group_is_looked_up_once(monkeypatch):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(bpe.tokenizer_path())
    coder.no_padding()
    coder.no_truncation()
    some, cache = texts(), bpe.WordCache(1 << 18)  # so small that it forgets
    learn = token_orc._learner(coder)
    for k in range(0, len(some), 200):
        want = [e.ids for e in coder.encode_batch_fast([t or "" for t in some[k : k + 200]], add_special_tokens=False)]
        assert [x.tolist() for x in cache.ids(some[k : k + 200], learn)] == want
    assert cache.ids([], learn) == []

    looked = []

    class Numbers(dict):
        def __getitem__(self, piece):
            looked.append(piece)
            return self.setdefault(piece, len(self))

    fresh = bpe.WordCache()
    fresh.number = Numbers()
    ids = fresh.ids(["over and over again"] * 100, learn)
    assert sorted(looked) == [b"again", b"and", b"over"] and all(np.array_equal(x, ids[0]) for x in ids)
