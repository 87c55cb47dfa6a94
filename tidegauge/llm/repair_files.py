"""Token-id files compressed by Re-Pair, with random access.

Documents are encoded in ascending order of their ids and cut into shards of about SHARD_TOKENS
ids. A shard keeps a grammar: frequent pairs of neighbouring symbols are replaced by new symbols
until no pair is frequent. It stores the rules, the number of ids each rule expands to and
the remaining sequence, in as many bits a number as they need. From the expansion lengths any range
of ids is found by binary search and only the rules that it needs are expanded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import binary, stored, texts_of
from tidegauge.llm.pieces import encoder, ranges, spaced_pieces
from tidegauge.llm.textscan import batches_of, bytes_of

SHARD_TOKENS = 1 << 20
# Pairs that occur so often are replaced.
LEAST_COUNT = 8
# Width of the table of hashed pair counts; it costs time only.
SLOT_BITS = 18
# A multiple of eight, so that every block of packed numbers ends at a byte.
PACKED_AT_ONCE = 1 << 16

SHARD_SCHEMA = "part INT, shard INT, start BIGINT, n BIGINT, base INT, n_rules INT, n_symbols INT, doc_ids BINARY, has_id BINARY, lengths BINARY, rules BINARY, expansions BINARY, sequence BINARY"


def _slots(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each pair in a table of hashed counts, and that table."""
    slots = first.view(np.uint32) * np.uint32(0x9E3779B1)
    slots += second.view(np.uint32) * np.uint32(0x85EBCA77)
    slots >>= np.uint32(32 - SLOT_BITS)
    slots = slots.astype(np.intp)
    return slots, np.bincount(slots, minlength=1 << SLOT_BITS)


def _frequent(first: np.ndarray, second: np.ndarray, slots: np.ndarray, table: np.ndarray, least: int, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(good, counts, place, which)``: the pairs that occur ``least`` times or more, how often, and where.

    Most pairs are rare. Hashed counts are never too low, so they leave few places to be sorted, each as
    one number with its pair where both fit 63 bits. There are ``symbols`` symbols.
    """
    place = np.flatnonzero((table >= least)[slots])
    width, room = symbols.bit_length(), len(first).bit_length()
    ordered = first[place].astype(np.int64)
    ordered <<= width
    ordered |= second[place]
    if 2 * width + room <= 63:
        ordered <<= room
        ordered |= place
        ordered.sort()
        place = ordered & ((1 << room) - 1)
        ordered >>= room
    else:
        order = np.argsort(ordered)
        place, ordered = place[order], ordered[order]
    begin = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)])
    counts = np.diff(np.r_[begin, len(place)])
    enough = counts >= least
    place = place[np.repeat(enough, counts)]
    good, counts = ordered[begin[enough]], counts[enough]
    return ((good >> width) << 32) | (good & ((1 << width) - 1)), counts, place, np.repeat(np.arange(len(good)), counts)


def _apart(n: int, place: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of the places, pairs of neighbours with a count each, are taken so that no two overlap.

    The greater count wins; in a run of equal counts every second place is taken, from the left.
    """
    at = np.zeros(n + 2, dtype=np.int32)
    at[place + 1] = weight
    taken = np.zeros(n, dtype=bool)
    taken[place[(weight >= at[place]) & (weight >= at[place + 2])]] = True
    # Places of a run behind its first.
    later = np.flatnonzero(taken[1:] & taken[:-1]) + 1
    run = np.flatnonzero(np.r_[True, np.diff(later) != 1][: len(later)])
    inside = later - np.repeat(later[run], np.diff(np.r_[run, len(later)]))
    taken[later[inside % 2 == 0]] = False
    return taken[place]


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rules, expansions, sequence)``: symbol ``base + r`` stands for the pair ``rules[r]``.

    All pairs of neighbours are counted and the frequent ones replaced, in rounds whose least count falls
    by four each to LEAST_COUNT, and then as often as there are pairs that reach it. A pair that is left
    less than two places of its own waits for another round. It ends when a round replaces nothing, so
    only pairs that lose all their places to others of at least the same count can be left.

    After a round at LEAST_COUNT, a pair can be frequent only if it was so before or holds a symbol that
    the round has put in, so the next one counts those places only.
    """
    sequence = ids.astype(np.int32)
    rules = np.zeros((0, 2), dtype=np.int64)
    sizes = np.ones(base, dtype=np.int64)
    least = None
    # Places whose pair may be frequent, if not all; the last place has none.
    likely = None
    while len(sequence) >= 2 * LEAST_COUNT:
        first, second = (sequence[:-1], sequence[1:]) if likely is None else (sequence[likely], sequence[likely + 1])
        slots, table = _slots(first, second)
        least = max(LEAST_COUNT, int(table.max() if least is None else least) // 4)
        good, counts, place, which = _frequent(first, second, slots, table, least, len(sizes))
        place = place if likely is None else likely[place]
        taken = _apart(len(sequence), place, counts[which])
        named = np.bincount(which[taken], minlength=len(good)) >= 2
        taken &= named[which]
        if not taken.any():
            if least == LEAST_COUNT:
                break
            continue
        lost = place[~taken]
        place, which = place[taken], (np.cumsum(named) - 1)[which[taken]]
        # A pair that lost places to others in an earlier round has its rule already.
        _, old, again = np.intersect1d((rules[:, 0] << 32) | rules[:, 1], good[named], assume_unique=True, return_indices=True)
        new = np.ones(int(named.sum()), dtype=bool)
        new[again] = False
        symbols = len(sizes) + np.cumsum(new) - 1
        symbols[again] = base + old
        made = np.stack([good[named][new] >> 32, good[named][new] & 0xFFFFFFFF], axis=1)
        sequence[place] = symbols[which]
        left = np.ones(len(sequence), dtype=bool)
        left[place + 1] = False
        sequence = sequence[left]
        if least == LEAST_COUNT:
            put = sequence >= len(sizes)
            if len(again):
                old_again = np.zeros(len(sizes) + len(made), dtype=bool)
                old_again[base + old] = True
                put |= old_again[sequence]
            put[:-1] |= put[1:]
            # Lost places that are still there have moved by as many places as were taken out before them.
            lost = lost[left[lost]]
            put[lost - np.searchsorted(np.sort(place), lost)] = True
            likely = np.flatnonzero(put[:-1])
        rules = np.concatenate([rules, made])
        sizes = np.concatenate([sizes, sizes[made].sum(axis=1)])
    return rules, sizes[base:], sequence.astype(np.int64)


def expand(rules, expansions, sequence, base: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids ``start:stop`` of a shard; only the rules that this range needs are expanded."""
    lengths = np.concatenate([np.ones(base, dtype=np.int64), expansions])
    ends = np.cumsum(lengths[sequence])
    total = int(ends[-1]) if len(ends) else 0
    stop = total if stop is None else min(stop, total)
    if start >= stop:
        return np.zeros(0, dtype=np.int32)
    first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left")
    symbols = sequence[first : last + 1]
    skipped = int(ends[first] - lengths[symbols[0]])
    pool, starts = _pool(rules, lengths, base, symbols)
    return pool[ranges(starts[symbols], lengths[symbols])][start - skipped : stop - skipped]


def _pool(rules: np.ndarray, lengths: np.ndarray, base: int, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The expansions of ``symbols`` and of all that they are made of in one array, and where each starts."""
    needed = np.zeros(len(lengths), dtype=bool)
    fresh = np.unique(symbols)
    while len(fresh):
        needed[fresh] = True
        parts = np.unique(rules[fresh[fresh >= base] - base])
        fresh = parts[~needed[parts]]
    used = np.flatnonzero(needed)
    starts = np.zeros(len(lengths), dtype=np.int64)
    starts[used] = np.cumsum(lengths[used]) - lengths[used]
    pool = np.zeros(int(lengths[used].sum()), dtype=np.int32)
    plain = used[used < base]
    pool[starts[plain]] = plain
    made = used[used >= base]
    while len(made):
        # All rules whose parts are expanded already: those before the first that names one of them.
        ahead = (rules[made - base] >= made[0]).any(axis=1)
        stop = int(np.argmax(ahead)) if ahead.any() else len(made)
        now, made = made[:stop], made[stop:]
        left, right = rules[now - base].T
        pool[ranges(starts[now], lengths[left])] = pool[ranges(starts[left], lengths[left])]
        pool[ranges(starts[now] + lengths[left], lengths[right])] = pool[ranges(starts[right], lengths[right])]
    return pool, starts


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in as many bits as the greatest of them takes; the first byte says how many."""
    width = max(1, int(values.max()).bit_length()) if len(values) else 1
    parts = [bytes([width])]
    for low in range(0, len(values), PACKED_AT_ONCE):
        block = values[low : low + PACKED_AT_ONCE].astype("<u4").view(np.uint8).reshape(-1, 4)
        parts.append(np.packbits(np.unpackbits(block, axis=1, bitorder="little")[:, :width], bitorder="little").tobytes())
    return b"".join(parts)


def unpacked(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``packed``."""
    width = data[0]
    # All blocks but the last end at a byte, so the bits stand side by side. A number may cross into the next word.
    words = np.zeros(len(data) // 8 + 2, dtype="<u8")
    words.view(np.uint8)[: len(data) - 1] = np.frombuffer(data, dtype=np.uint8, offset=1)
    out = np.zeros(n, dtype=np.int64)
    for low in range(0, n, PACKED_AT_ONCE):
        bit = np.arange(low, min(n, low + PACKED_AT_ONCE)) * width
        at, shift = bit >> 6, (bit & 63).astype(np.uint64)
        # Where nothing is shifted, the next word is shifted out whole, which leaves 0.
        value = (words[at] >> shift) | (words[at + 1] << (np.uint64(64) - shift))
        out[low : low + len(bit)] = value & np.uint64((1 << width) - 1)
    return out


def _parts(shard: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    n = shard["n_rules"]
    return unpacked(shard["rules"], 2 * n).reshape(-1, 2), unpacked(shard["expansions"], n), unpacked(shard["sequence"], shard["n_symbols"]), shard["base"]


def shard_ids(shard: dict, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids of one row of the file table, whole or a range counted from the shard's first id."""
    return expand(*_parts(shard), start, stop)


def _shard(part: int, shard: int, start: int, base: int, rows: list) -> pa.RecordBatch:
    ids = np.concatenate([r[1] for r in rows])
    lengths = np.array([len(r[1]) for r in rows], dtype=np.int64)
    doc_ids = np.array([r[0] or 0 for r in rows], dtype=np.int64)
    has_id = np.array([r[0] is not None for r in rows], dtype=np.uint8)
    rules, expansions, sequence = compress(ids, base)
    blobs = [doc_ids.tobytes(), has_id.tobytes(), lengths.tobytes(), packed(rules.ravel()), packed(expansions), packed(sequence)]
    numbers = [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64())]
    numbers += [pa.array([x], pa.int32()) for x in (base, len(rules), len(sequence))]
    return pa.RecordBatch.from_arrays([*numbers, *(binary([b]) for b in blobs)], names=[c.split()[0] for c in SHARD_SCHEMA.split(", ")])


def write_shards(docs: DataFrame, path: str, end_id: int, parts: int | None = None) -> DataFrame:
    """The file table: encoded documents, each with ``end_id`` behind it, in ascending ``doc_id`` order.

    ``part`` numbers ranges of ids in order, ``shard`` the shards of a part, and ``start`` counts
    the ids of the part before the shard. Rows are moved once, by range of their ids; a task holds
    one shard. The table is written to the shared folder, one file for each part.
    """
    rows = texts_of(docs)
    parts = parts or 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches):
        coder = encoder(path)
        base = max(coder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        part, shard, start, held, size = TaskContext.get().partitionId(), 0, 0, [], 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for low, high in batches_of(texts, 2 << 20):
                data, offsets = bytes_of(texts.slice(low, high - low))
                begin = spaced_pieces(data, offsets)
                found, lengths = coder.encode(data, begin, np.r_[begin[1:], len(data)].astype(np.int64))
                ends = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(begin, offsets)]
                for i in range(high - low):
                    held.append((ids[low + i], np.append(found[ends[i] : ends[i + 1]], np.int32(end_id))))
                    size += len(held[-1][1])
                    if size >= SHARD_TOKENS:
                        yield _shard(part, shard, start, base, held)
                        shard, start, held, size = shard + 1, start + size, [], 0
        if held:
            yield _shard(part, shard, start, base, held)

    return stored(rows.mapInArrow(write, SHARD_SCHEMA), "token-files")


def read_documents(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the file table.

    ``start`` counts all ids before the document; only one number for each part meets in one
    place for it.
    """
    before = files.groupBy("part").agg(F.sum("n").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))

    def read(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                ids = shard_ids(shard).astype("<u4", copy=False)
                lengths = np.frombuffer(shard["lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                known = np.frombuffer(shard["has_id"], dtype=np.uint8) == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard["part"]] * len(lengths), pa.int32()),
                        pa.array(np.frombuffer(shard["doc_ids"], dtype=np.int64), mask=known),
                        pa.array(shard["start"] + ends - lengths), pa.array(lengths),
                        pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(np.r_[0, 4 * ends].astype(np.int32)), pa.py_buffer(ids)]),
                    ],
                    names=["part", "doc_id", "within", "n_tokens", "ids"],
                )

    rows = files.mapInArrow(read, "part INT, doc_id BIGINT, within BIGINT, n_tokens BIGINT, ids BINARY")
    # One line for each part, which are fixed in number.
    return rows.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids")


def token_files(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write the files and read all documents back from them.

    Null texts count as empty and hold ``end_id`` alone. Rows without an id come first. Rows that
    repeat an id are all kept, in the order of their texts. An empty table gives no rows.
    """
    return read_documents(write_shards(docs, path, end_id))
