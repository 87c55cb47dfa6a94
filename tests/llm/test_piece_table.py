"""Pieces are found by their hashes without sorting, and forgotten pieces are learned again."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidegauge.llm import pieces
from tidegauge.llm import repair_files as rf
from tidegauge.llm.textscan import bytes_of

BYTE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(BYTE)
rnd = random.Random(3)


def prose(n):
    return "".join(rnd.choice(["a", "bc", "é", "日本", " ", " ", "\n", ".", "\x00", "'s", "7", "x" * 20]) for _ in range(n))


def cut(texts):
    data, offsets = bytes_of(pa.array(texts, pa.string()))
    begin = pieces.spaced_pieces(data, offsets)
    return data, begin, np.r_[begin[1:], len(data)].astype(np.int64)


def library_ids(texts):
    return [i for t in texts for i in LIBRARY.encode(t, add_special_tokens=False).ids]


def test_known_pieces_are_not_sorted_again(monkeypatch):
    texts = [prose(400) for _ in range(20)]
    coder = pieces.PieceEncoder(BYTE)
    assert coder.encode(*cut(texts))[0].tolist() == library_ids(texts)

    def sort(*args, **kwargs):
        raise AssertionError("known pieces are sorted")

    for name in ("unique", "sort", "argsort"):
        monkeypatch.setattr(np, name, sort)
    texts = texts[::-1]
    assert coder.encode(*cut(texts))[0].tolist() == library_ids(texts)


@pytest.mark.parametrize("most", [1, 300, 1 << 20])
def test_table_grows_and_forgets(monkeypatch, most):
    monkeypatch.setattr(pieces, "MOST_PIECES", most)
    monkeypatch.setattr(pieces, "FIRST_SLOT_BITS", 1)
    coder = pieces.PieceEncoder(BYTE)
    for _ in range(6):
        texts = [prose(300) for _ in range(5)]
        ids, lengths = coder.encode(*cut(texts))
        assert ids.tolist() == library_ids(texts) and lengths.sum() == len(ids)
        assert 2 * coder.n <= len(coder.keys) and np.count_nonzero(coder.keys) == coder.n


def test_hashes_tell_bytes_not_places(monkeypatch):
    monkeypatch.setattr(pieces, "HASHED_AT_ONCE", 7)
    spans = [b"abcdefgh" * 6, b"\x00" * 48, bytes(range(48))]
    spans = sorted({s[:n] for s in spans for n in range(1, 49)} | {b"abcdefgi", b"abcdefghabcdefgi"})
    found = {}
    for lead in range(9):
        data = np.frombuffer(b"#" * lead + b"".join(spans), dtype=np.uint8)
        ends = lead + np.cumsum([len(s) for s in spans])
        for span, h in zip(spans, pieces.piece_hashes(data, np.r_[lead, ends[:-1]], ends).tolist()):
            assert found.setdefault(span, h) == h
    assert len(set(found.values())) == len(spans) and 0 not in found.values()


def test_pairs_that_fill_more_than_63_bits():
    ids = np.array([rnd.randrange(5) for _ in range(3000)], dtype=np.int32)
    slots, table = rf._slots(ids[:-1], ids[1:])
    short, long = (rf._frequent(ids[:-1], ids[1:], slots, table, 8, symbols) for symbols in (5, 1 << 30))
    assert [x.tolist() for x in short[:2]] == [x.tolist() for x in long[:2]]
    assert sorted(zip(short[2].tolist(), short[3].tolist())) == sorted(zip(long[2].tolist(), long[3].tolist()))
    wide = ids.astype(np.int64)
    assert ((wide[short[2]] << 32 | wide[short[2] + 1]) == short[0][short[3]]).all()
