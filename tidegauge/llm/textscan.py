"""Words and their hashes of whole batches of texts, by array operations on UTF-8 bytes.

A batch of texts is one byte buffer with row offsets. Word characters are told by a table of
256 entries, which is exact because every rule used here separates on ASCII characters only
and takes all bytes of other characters as word bytes. Words are hashed from prefix sums of
``byte * BASE**position``, so no word becomes a Python object. Buffers are hashed in segments,
which bounds the memory whatever the length of one text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1

# The ASCII white space of the word rules, space and tab to carriage return.
WHITE_SPACE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def byte_table(separators: bytes) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


SPACED_WORDS = byte_table(WHITE_SPACE)
# Fixed rule: digits, letters and everything beyond ASCII form words.
ALNUM_WORDS = byte_table(bytes(c for c in range(128) if not chr(c).isalnum()))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
AS_IS = np.arange(256, dtype=np.uint8)


class _Powers:
    """Powers of BASE and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = self._table(BASE, n)
            self.down = self._table(pow(BASE, -1, 1 << 64), n)
        return self.up, self.down

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base, dtype=np.uint64)
        steps[:1] = 1
        return np.cumprod(steps, dtype=np.uint64)


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a text column; null counts as empty. Row i is bytes[offsets[i]:offsets[i+1]]."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(at):
        at = np.zeros(1, dtype=np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)``: byte spans of words in order; row i has words first[i]:first[i+1]."""
    inside = table[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = AS_IS) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, spans being in order and apart."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, side="right")))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = _POWERS.get(max(high - low, SEGMENT))
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((fold[data[low:high]].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def hash_words(texts: pa.Array, table: np.ndarray, fold: np.ndarray = AS_IS) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: word hashes of a batch of texts; row i has hashes[first[i]:first[i+1]]."""
    data, offsets = bytes_of(texts)
    starts, ends, first = word_spans(data, offsets, table)
    return span_hashes(data, starts, ends, fold), first


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` neighbouring words, also across rows (see ``windows_of``)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    factor = 1
    for k in range(size):
        factor = factor * 0xD6E8FEB86659FD93 & MASK
        total += words[k : k + n] * np.uint64(factor)
    return mix(total)


def whole_hash(words: np.ndarray) -> int:
    """One hash of a short sequence, which never equals that of a full window by its tag."""
    total = 0xA5A5A5A5 + len(words)
    for word in words.tolist():
        total = (total * 0xD6E8FEB86659FD93 + word) & MASK
    return int(mix(np.array([total], dtype=np.uint64))[0])


def batches_of(texts: pa.Array, most_bytes: int = 4 * SEGMENT):
    """``(low, high)`` row ranges of about ``most_bytes`` bytes each, one row at least."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    low = 0
    while low < len(lengths):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + most_bytes, side="right")))
        yield low, high
        low = high
