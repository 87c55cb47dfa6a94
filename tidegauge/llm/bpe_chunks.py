"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over the last bytes cuts a text into chunks, so a passage gives the same chunks in
every document that holds it. A worker encodes a chunk once and reuses its ids wherever the chunk
comes again. The words that a cut runs through belong to no chunk. They repair the join: they are
encoded whole, and once more together with the words on both sides; if the two do not agree, the
join is widened, at last to the whole document. Nothing is shuffled: at a hundred terabytes
moving every chunk to one place would cost more than encoding a copy again on another machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegauge.llm.common import binary, lean, texts_of
from tidegauge.llm.pieces import encoder, ranges
from tidegauge.llm.textscan import AS_IS, SPACED_WORDS, BASE, batches_of, bytes_of, mix, span_hashes, word_spans

ROLL = 16
CHUNK_BYTES = 2048
MOST_IDS = 2 << 20
# A worker outlives its stage, and so does what it keeps; this is some 50 MB at most.
MOST_PIECES = 1 << 20
# Texts are encoded in blocks of about this many bytes; arrays of a block take some fifty times that.
BLOCK_BYTES = 1 << 19


def chunk_edges(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row ends and the places where the hash of the last ROLL bytes tells to cut."""
    n = len(data)
    if n <= ROLL:
        return np.unique(offsets)
    rolled = np.zeros(n - ROLL + 1, dtype=np.uint64)
    factor = 1
    for k in range(ROLL - 1, -1, -1):
        rolled += AS_IS[data[k : n - ROLL + 1 + k]].astype(np.uint64) * np.uint64(factor)
        factor = factor * BASE & ((1 << 64) - 1)
    cuts = np.flatnonzero(mix(rolled) % np.uint64(CHUNK_BYTES) == 0) + ROLL
    row = np.searchsorted(offsets, cuts, side="left") - 1
    return np.unique(np.concatenate([offsets, cuts[cuts - ROLL >= offsets[row]]]))


class ChunkEncoder:
    """Keeps the ids of chunks, up to MOST_IDS of them, and starts again beyond."""

    def __init__(self, path: str):
        self.pieces = encoder(path, MOST_PIECES)
        self.chunks: dict[int, np.ndarray] = {}
        self.held = 0

    def whole(self, text: str) -> list[int]:
        return self.pieces.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: row i has ids[offsets[i]:offsets[i+1]]."""
        data, offsets = bytes_of(texts)
        starts, ends, first = word_spans(data, offsets, SPACED_WORDS)
        if not len(starts):
            return np.zeros(0, dtype=np.int32), np.zeros(len(offsets), dtype=np.int64)
        edges = chunk_edges(data, offsets)
        chunk = np.searchsorted(edges, starts, side="right") - 1
        seam = ends > edges[chunk + 1]
        # Runs of words of one chunk, and each word on a cut by itself: the segments of the rows.
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (chunk[1:] != chunk[:-1]) | seam[1:] | seam[:-1]
        begin = np.flatnonzero(new)
        stop = np.r_[begin[1:], len(starts)]
        is_chunk = ~seam[begin]
        keys = span_hashes(data, starts[begin], ends[stop - 1])
        if self.held > MOST_IDS:
            self.chunks, self.held = {}, 0
        fresh: dict[int, int] = {}
        todo = ~is_chunk
        for i in np.flatnonzero(is_chunk).tolist():
            key = int(keys[i])
            if key not in self.chunks and key not in fresh:
                fresh[key] = i
                todo[i] = True
        words = ranges(begin[todo], (stop - begin)[todo])
        ids, lengths = self.pieces.encode(data, starts[words], ends[words])
        word_ends = np.concatenate([[0], np.cumsum(lengths)])
        seg_words = np.concatenate([[0], np.cumsum((stop - begin)[todo])])
        at = np.zeros(len(begin), dtype=np.int64)
        size = np.zeros(len(begin), dtype=np.int64)
        at[todo] = word_ends[seg_words[:-1]]
        size[todo] = word_ends[seg_words[1:]] - at[todo]
        pool, end = [ids], len(ids)
        placed: dict[int, tuple[int, int]] = {key: (int(at[i]), int(size[i])) for key, i in fresh.items()}
        for i in np.flatnonzero(~todo).tolist():
            key = int(keys[i])
            if key not in placed:
                placed[key] = (end, len(self.chunks[key]))
                pool.append(self.chunks[key])
                end += len(self.chunks[key])
            at[i], size[i] = placed[key]
        for key, i in fresh.items():
            self.chunks[key] = ids[at[i] : at[i] + size[i]].copy()
            self.held += int(size[i]) + 16
        out = np.concatenate(pool)[ranges(at, size)]
        seg_first = np.searchsorted(begin, first)
        row_ends = np.concatenate([[0], np.cumsum(size)])[seg_first]
        odd = self._disagreeing(data, starts, ends, first, np.flatnonzero(~is_chunk), begin, out, np.concatenate([[0], np.cumsum(size)]))
        return (out, row_ends) if not odd else self._widened(texts, out, row_ends, odd)

    def _disagreeing(self, data, starts, ends, first, seams, begin, out, seg_ends) -> set[int]:
        """Rows with a join whose words, encoded with a neighbour on each side, give other ids."""
        if not len(seams):
            return set()
        word = begin[seams]
        row = np.searchsorted(first, word, side="right") - 1
        left = np.maximum(word - 1, first[row])
        right = np.minimum(word + 1, first[row + 1] - 1)
        raw = data.tobytes()
        near = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[left].tolist(), ends[right].tolist())]
        joined = [e.ids for e in self.pieces.tokenizer.encode_batch_fast(near, add_special_tokens=False)]
        pick = np.stack([left, word, right], axis=1)
        used = np.stack([left < word, np.ones(len(word), dtype=bool), right > word], axis=1)
        apart, lengths = self.pieces.encode(data, starts[pick[used]], ends[pick[used]])
        edges = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(used.sum(axis=1))])]
        return {int(row[k]) for k, ids in enumerate(joined) if ids != apart[edges[k] : edges[k + 1]].tolist()}

    def _widened(self, texts, out, row_ends, odd):
        rows = [out[s:e] for s, e in zip(row_ends[:-1], row_ends[1:])]
        for i in odd:
            rows[i] = np.array(self.whole(texts[i].as_py() or ""), dtype=np.int32)
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


class Decoder:
    """Ids back to text as the library's ``decode`` does, keeping special tokens."""

    def __init__(self, path: str):
        self.tokenizer = encoder(path, MOST_PIECES).tokenizer
        self.joined = self.tokenizer.decoder is None
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=-1) + 1
        self.tokens = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(size)] if self.joined else []

    def decode(self, ids: np.ndarray) -> bytes:
        if self.joined:
            return b" ".join(map(self.tokens.__getitem__, ids.tolist()))
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False).encode()


_CHUNKS: dict[str, tuple[ChunkEncoder, Decoder]] = {}


def coders(path: str) -> tuple[ChunkEncoder, Decoder]:
    if path not in _CHUNKS:
        _CHUNKS[path] = ChunkEncoder(path), Decoder(path)
    return _CHUNKS[path]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` of every row.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers; ``path`` names the
    tokenizer file on every machine. The words of the tokenizer must not depend on what stands
    behind ASCII white space; joins are checked for it. Null texts count as empty and give no
    ids and an empty text. Rows may repeat; an empty table gives no rows.
    """

    def code(batches):
        chunks, decoder = coders(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for low, high in batches_of(texts, BLOCK_BYTES):
                found, ends = chunks.encode(texts.slice(low, high - low))
                rows = [found[s:e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(low, high - low), pa.array(np.diff(ends), pa.int64()),
                        binary([r.astype("<u4").tobytes() for r in rows]),
                        binary([decoder.decode(r) for r in rows]).cast(pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    return texts_of(docs).mapInArrow(lean(code), "doc_id BIGINT, n_tokens BIGINT, ids BINARY, decoded STRING")
