"""What a Python worker still holds when its task has ended."""

import os
import random
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidegauge.llm import bpe_chunks, common, jaccard_groups, phrase_index

WORD = public_tokenizers.path("word_bpe_49k.json")
rnd = random.Random(5)


class Caught:
    """Stands for a table; keeps the function that a step hands to ``mapInArrow``."""

    def select(self, *columns):
        return self

    def mapInArrow(self, task, schema):
        self.task = task
        return self

    def where(self, condition):
        return self


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


def words(n):
    return " ".join("".join(rnd.choices("abcdefghij", k=9)) for _ in range(n))


@pytest.mark.parametrize("step", ["tokens", "near_duplicates", "decontaminate"])
def test_memory_is_given_back_when_a_task_ends(monkeypatch, step):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    docs = Caught()
    monkeypatch.setattr(bpe_chunks, "texts_of", lambda d: d)
    if step == "tokens":
        bpe_chunks.encode_decode(docs, WORD)
    elif step == "near_duplicates":
        jaccard_groups.grouped(docs, np.zeros(jaccard_groups.COUNTERS, dtype="u2"), 5, 75, 8)
    else:
        monkeypatch.setattr(phrase_index, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
        phrase_index.index_postings(docs, np.ones(phrase_index.SLOTS, bool), np.ones(phrase_index.SLOTS, bool), 9)
    out = docs.task(iter([batch([words(30), None, words(20)])]))
    next(out)
    assert not given
    assert all(isinstance(rows, pa.RecordBatch) for rows in out) and given == [1]


def test_memory_is_given_back_when_a_task_fails(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))

    def broken(batches):
        yield next(batches)
        raise ValueError("row")

    with pytest.raises(ValueError):
        list(common.lean(broken)(iter([batch(["a"])])))
    assert given == [1]


@pytest.mark.skipif(not os.path.exists("/proc/self/statm"), reason="memory is read from /proc")
def test_freed_memory_leaves_the_process():
    def held():
        return int(Path("/proc/self/statm").read_text().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6

    blocks = [b"x" * (100_000 + i % 2) for i in range(1000)]
    kept = blocks[::10]
    del blocks
    before = held()
    common.give_back()
    assert len(kept) == 100 and held() < before - 50


def test_kept_pieces_and_chunks_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe_chunks, "MOST_PIECES", 400)
    monkeypatch.setattr(bpe_chunks, "MOST_IDS", 1000)
    coder = bpe_chunks.ChunkEncoder(WORD)
    decoder = bpe_chunks.Decoder(WORD)
    assert decoder.tokenizer is coder.pieces.tokenizer
    for _ in range(8):
        texts = [words(50) for _ in range(6)]
        ids, ends = coder.encode(pa.array(texts))
        assert [ids[s:e].tolist() for s, e in zip(ends[:-1], ends[1:])] == [coder.whole(t) for t in texts]
        assert coder.pieces.n <= 400
