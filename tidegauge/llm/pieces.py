"""Encoding by a public tokenizer where each distinct piece of text is encoded once.

A piece is a span of bytes that the tokenizer treats on its own, whatever stands around it. A
worker keeps the ids of the pieces it has met in flat arrays behind a table of hashes, up to a fixed
number; beyond that it starts again. Only new pieces are sorted. Results never depend on what is kept.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from tidegauge.llm.textscan import BASE, SPACED_WORDS, mix, span_hashes

MOST_PIECES = 3 << 20
# New pieces are handed to the library in texts of about this many bytes.
JOINED_BYTES = 1 << 16
HASHED_AT_ONCE = 1 << 16
# Slots of an empty table of hashes, as a power of two; it doubles before half of it is taken.
FIRST_SLOT_BITS = 16


def _kind(c: int) -> int:
    """What a byte can be, one bit each: space or mark, then what a cut before either needs, two bits on."""
    space, control = not SPACED_WORDS[c], 0x1C <= c <= 0x1F
    found = [space, chr(c) in ",.;:!?&%$#*()", not space and not control, c < 128 and chr(c).isalnum(), c >= 0x80, c == 0xC2, 0xE1 <= c <= 0xE3]
    return sum(bit << k for k, bit in enumerate(found))


KINDS = bytes(_kind(c) for c in range(256))
# The first k bytes of a word of eight.
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def load(path: str) -> Tokenizer:
    # A task has one core; threads of the library would take those of other tasks.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    begin = np.cumsum(lengths) - lengths
    return np.repeat(starts - begin, lengths) + np.arange(total)


def spaced_pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin for a tokenizer that keeps white space with the word after it.

    Its pattern never matches from a visible character into white space, so a run of white space
    and what follows it can be encoded alone. A cut needs an ASCII space behind a character that
    is surely none: no cut is made behind the characters that could be wider spaces (their
    first UTF-8 bytes C2, E1, E2 and E3) or the four separator controls.
    """
    kinds = np.frombuffer(data.tobytes().translate(KINDS), dtype=np.uint8)
    wider = np.zeros(len(data), dtype=np.uint8)
    wider[1:] = kinds[:-1] >> 5
    wider[2:] |= kinds[:-2] >> 6
    wider &= kinds >> 4
    wider &= 1
    # Marks that end words are cut off behind ASCII letters and digits; the pattern never takes
    # both together. The apostrophe may begin a contraction and the bar a special token; they are left alone.
    behind = (kinds >> 2) & ~wider
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = (kinds[1:] & behind[:-1] & 3) != 0
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


def piece_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each piece, never 0; so many at once, which bounds the memory."""
    words = np.zeros(len(data) // 8 + 3, dtype="<u8")
    words.view(np.uint8)[: len(data)] = data
    out = np.empty(len(starts), dtype=np.uint64)
    for low in range(0, len(starts), HASHED_AT_ONCE):
        part = slice(low, low + HASHED_AT_ONCE)
        out[part] = _hashes(data, words, starts[part], ends[part] - starts[part])
    return np.maximum(out, np.uint64(1))


def _hashes(data, words, starts, sizes):
    """Most pieces fit two words of eight bytes, which are hashed at once; the others go byte by byte."""
    at, shift = starts >> 3, ((starts & 7) << 3).astype(np.uint64)
    # Where nothing is shifted, the next word is shifted out whole, which leaves 0.
    back, middle = np.uint64(64) - shift, words[at + 1]
    first = (words[at] >> shift) | (middle << back)
    second = (middle >> shift) | (words[at + 2] << back)
    first &= FIRST_BYTES[np.minimum(sizes, 8)]
    second &= FIRST_BYTES[np.clip(sizes - 8, 0, 8)]
    out = mix(first * np.uint64(BASE) + second * np.uint64(0xD6E8FEB86659FD93) + sizes.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    long = np.flatnonzero(sizes > 16)
    if len(long):
        stops = np.cumsum(sizes[long])
        out[long] = span_hashes(data[ranges(starts[long], sizes[long])], stops - sizes[long], stops)
    return out


def _behind(held: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """``more`` written behind the first ``n`` entries; where there is no room, the array doubles."""
    if n + len(more) > len(held):
        held = np.concatenate([held[:n], np.zeros(n + len(more), dtype=held.dtype)])
    held[n : n + len(more)] = more
    return held


class PieceEncoder:
    def __init__(self, path: str, most: int | None = None):
        self.most = most
        self.tokenizer = load(path)
        self.token_bytes = self._token_bytes()
        self._forget()

    def _token_bytes(self) -> np.ndarray | None:
        """Bytes of text behind each id, for a tokenizer that keeps every byte; else None.

        A byte-level vocabulary has one character for each byte.
        """
        kinds = [str(part).split("(")[0] for part in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        if kinds != ["None", "ByteLevel"]:
            return None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            sizes[i] = len(token)
        return sizes

    def _forget(self):
        self.n = 0
        # Piece i has ids[bounds[i]:bounds[i + 1]]; both arrays have room behind what is used.
        self.bounds = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)
        self._empty_table(FIRST_SLOT_BITS)

    def _empty_table(self, bits: int):
        """A hash stands in the slot that its first bits name, or in the next free one; 0 is a free slot."""
        self.bits = bits
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.piece = np.full(1 << bits, -1, dtype=np.int32)

    def _seek(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each hash, or the free one where it would stand."""
        slot = (keys >> np.uint64(64 - self.bits)).view(np.int64)
        held = self.keys[slot]
        ahead = np.flatnonzero((held != keys) & (held != 0))
        while len(ahead):
            slot[ahead] = (slot[ahead] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[ahead]]
            ahead = ahead[(held != keys[ahead]) & (held != 0)]
        return slot

    def _put(self, keys: np.ndarray, pieces: np.ndarray):
        """Distinct new hashes and their pieces; of those that meet in a free slot, one gets it."""
        while len(keys):
            slot = self._seek(keys)
            self.keys[slot] = keys
            got = self.keys[slot] == keys
            self.piece[slot[got]] = pieces[got]
            keys, pieces = keys[~got], pieces[~got]

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, lengths)``: the ids of all pieces in order, and how many each piece has."""
        if not len(starts):
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        keys = piece_hashes(data, starts, ends)
        piece = self.piece[self._seek(keys)]
        new = np.flatnonzero(piece < 0)
        if len(new):
            fresh, first, inverse = np.unique(keys[new], return_index=True, return_inverse=True)
            if self.n and self.n + len(fresh) > (self.most or MOST_PIECES):
                self._forget()
                return self.encode(data, starts, ends)
            piece[new] = self.n + inverse
            self._learn(data, fresh, starts[new[first]], ends[new[first]])
        begin = self.bounds[piece]
        lengths = self.bounds[piece + 1] - begin
        return self.ids[ranges(begin, lengths)], lengths

    def _learn(self, data, keys, starts, ends):
        flat, lengths = self._found(data, starts, ends)
        used = int(self.bounds[self.n])
        self.ids = _behind(self.ids, used, flat)
        self.bounds = _behind(self.bounds, self.n + 1, used + np.cumsum(lengths))
        pieces = np.arange(self.n, self.n + len(keys), dtype=np.int32)
        self.n += len(keys)
        if 2 * self.n > len(self.keys):
            taken = self.piece >= 0
            keys, pieces = np.concatenate([self.keys[taken], keys]), np.concatenate([self.piece[taken], pieces])
            self._empty_table((2 * self.n - 1).bit_length())
        self._put(keys, pieces)

    def _found(self, data, starts, ends):
        """The ids of new pieces: side by side where both ends of a piece allow it, else apart."""
        if self.token_bytes is None:
            return self._apart(data, starts, ends)
        last = data[ends - 1]
        sure = (last > 0x20) & (last < 0x7F)
        long = ends - starts > 3
        second, third = data[ends - np.minimum(2, ends - starts)], data[ends - np.minimum(3, ends - starts)]
        sure |= long & (last >= 0x80) & (second != 0xC2) & ((third < 0xE1) | (third > 0xE3))
        safe = ~SPACED_WORDS[data[starts]] & sure
        order = np.concatenate([np.flatnonzero(safe), np.flatnonzero(~safe)])
        n = int(safe.sum())
        pairs = [self._joined(data, starts[order[:n]], ends[order[:n]]), self._apart(data, starts[order[n:]], ends[order[n:]])]
        flat, lengths = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        back = np.argsort(order)
        begin = (np.cumsum(lengths) - lengths)[back]
        return flat[ranges(begin, lengths[back])], lengths[back]

    def _apart(self, data, starts, ends):
        raw = data.tobytes()
        texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts.tolist(), ends.tolist())]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(lengths.sum())), lengths

    def _joined(self, data, starts, ends):
        """Pieces side by side, told apart again by the bytes that the ids stand for."""
        if not len(starts):
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        sizes = ends - starts
        joined = data[ranges(starts, sizes)].tobytes()
        edges = np.concatenate([[0], np.cumsum(sizes)])
        cuts = [0]
        while cuts[-1] < len(sizes):
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(edges, edges[cuts[-1]] + JOINED_BYTES, side="right")) - 1))
        texts = [joined[edges[i] : edges[j]].decode("utf-8", "replace") for i, j in zip(cuts[:-1], cuts[1:])]
        parts = [np.array(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(parts)
        reached = np.concatenate([[0], np.cumsum(self.token_bytes[flat])])
        stops = np.searchsorted(reached, edges)
        if not np.array_equal(reached[np.minimum(stops, len(reached) - 1)], edges):
            return self._apart(data, starts, ends)
        return flat, np.diff(stops)


_ENCODERS: dict[tuple[str, int | None], PieceEncoder] = {}


def encoder(path: str, most: int | None = None) -> PieceEncoder:
    """The worker's encoder for a tokenizer file, which keeps ``most`` pieces (else MOST_PIECES)."""
    if (path, most) not in _ENCODERS:
        _ENCODERS[path, most] = PieceEncoder(path, most)
    return _ENCODERS[path, most]
