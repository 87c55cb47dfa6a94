"""Phrase collocations by relational mining over sorted occurrence relations (SETM).

The relation of length k holds ``(position, phrase)`` of every occurrence of a frequent phrase, sorted
by position. Positions are counted within a block of whole texts and jump at the end of a piece, so
equal pieces and adjacent positions are one comparison. A length is extended in three passes:

1. merge-join of the sorted relation with itself at the next position and group-count by half the
   hash: slots that phrases may share, so no phrase is more frequent than its slot,
2. the same merge-join and group-count by phrase, of the phrases in frequent slots: partial counts of
   each task are added up by range of their hash, which leaves the frequent longer phrases,
3. the same merge-join, semi-joined with these: the next relation, written to the shared folder.

A relation never moves between tasks, since a piece lies in one block; only counts are exchanged,
summed before they are. Most of them are ones, of phrases that are rare: a task hands them on as a
sorted list for each range of hashes, which takes two or three bytes a slot. The second pass and the
semi-join read a bitmap of the frequent slots and phrases, sized by their number. What passes it by
chance costs some counts and no more: a longer phrase is never more frequent than its parts, and the
phrases that are returned are joined exactly. The parts of a phrase are told once, by the part of the
relation of least number that holds it. Phrases are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import binary, buckets, stored
from tidegauge.llm.textscan import LOWER, batches_of, byte_table, bytes_of, mix, span_hashes, word_spans

# The characters that end a piece, and the blanks between words of a piece.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_BYTES = byte_table(ENDS + b"\x20\x09")
END_BYTES = ~byte_table(ENDS)

LEAST = 100
LONGEST = 5
TOP = 2000
# Partial counts a task holds before it hands them on.
MOST_COUNTS = 1 << 21
# A bitmap has this many slots per phrase, within these bounds (128 KB to 32 MB).
SLOTS_PER_PHRASE, LEAST_SLOTS, MOST_SLOTS = 16, 1 << 20, 1 << 28
BLOCK_SLOTS = 1 << 20
SALTS = 64
# Blocks are numbered by the task that wrote them, a part of the relation, and within it.
PART_BITS = 32
# Bits that an id has beyond its slot. Bitmaps read the low bits of ids, no more than a slot has.
HALF = 32

_LEFT, _RIGHT, _LANG = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0x8EBC6AF09C88C6E3)

COUNTED = "range BIGINT, part BIGINT, size BIGINT, counts BINARY"
FREQUENT = "id BIGINT, a BIGINT, part BIGINT"
WORDS = "block BIGINT, pos BINARY, gram BINARY, id BIGINT, word STRING, lang STRING, n BIGINT"
LONGER = "block BIGINT, pos BINARY, gram BINARY, id BIGINT, first BIGINT, rest BIGINT"


def _packed(pos: np.ndarray) -> bytes:
    return np.diff(pos, prepend=0).astype(np.int32).tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, dtype=np.int32), dtype=np.int64)


class Bitmap:
    """Which phrases are frequent, by hash slot."""

    def __init__(self, blob: bytes):
        self.bits = np.frombuffer(blob, dtype=np.uint8)

    def has(self, ids: np.ndarray) -> np.ndarray:
        slot = ids & (8 * len(self.bits) - 1)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _packed_counts(ids: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending ids and their counts: steps between ids, all first bytes before all second ones and so on."""
    columns = np.stack([np.diff(ids, prepend=np.uint64(0)), n.astype(np.uint64)])
    return pa.compress(columns.view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1).tobytes(), "zstd", asbytes=True)


def _unpacked_counts(blob: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob, 16 * size, "zstd", asbytes=True), dtype=np.uint8)
    steps, n = np.ascontiguousarray(raw.reshape(2, 8, size).transpose(0, 2, 1)).view(np.uint64).reshape(2, size)
    return np.cumsum(steps, dtype=np.uint64), n.astype(np.int64)


class Counts:
    """Partial counts of a task, handed on in ``2**bits`` ranges of ids at the end of a part of the relation
    and when there are too many."""

    def __init__(self, bits: int):
        self.bits, self.part, self.parts, self.size = bits, 0, [], 0

    def add(self, ids: np.ndarray, part: int = 0):
        if not len(ids):
            return
        if part != self.part:
            yield from self.rest()
            self.part = part
        found, n = np.unique(ids.view(np.uint64), return_counts=True)
        self.parts.append((found, n))
        self.size += len(found)
        if self.size > MOST_COUNTS:
            self.parts = [self._merged()]
            self.size = len(self.parts[0][0])
            if self.size > MOST_COUNTS // 2:
                yield from self.rest()

    def _merged(self):
        return _added(*(np.concatenate(column) for column in zip(*self.parts)))

    def rest(self):
        if self.parts:
            (ids, n), self.parts, self.size = self._merged(), [], 0
            ranges, low = np.unique(ids >> np.uint64(64 - self.bits), return_index=True)
            high = np.append(low[1:], len(ids))
            packed = binary([_packed_counts(ids[i:j], n[i:j]) for i, j in zip(low.tolist(), high.tolist())])
            columns = [pa.array(ranges.astype(np.int64)), pa.array(np.full(len(low), self.part)), pa.array(high - low), packed]
            yield pa.RecordBatch.from_arrays(columns, names=["range", "part", "size", "counts"])


def _added(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    return ids[first], np.add.reduceat(n[order], first)


def range_bits(spark: SparkSession) -> int:
    """Ranges of ids, a power of two and two at least, are as many as the session's partitions ask for."""
    return max(1, (buckets(spark, 4) - 1).bit_length())


def added_up(partial: DataFrame, least: int) -> DataFrame:
    """``(id, a, part)`` of the phrases counted ``least`` times or more, with the least part that holds each."""

    def add(rows):
        sizes = rows.column("size").to_numpy()
        ids, n = (np.concatenate(column) for column in zip(*(_unpacked_counts(b.as_py(), s) for b, s in zip(rows.column("counts"), sizes.tolist()))))
        part = np.repeat(rows.column("part").to_numpy(), sizes)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        a = np.add.reduceat(n[order], first)
        kept = a >= least
        return pa.table({"id": ids[first][kept].view(np.int64), "a": a[kept], "part": np.minimum.reduceat(part[order], first)[kept]})

    return partial.groupBy("range").applyInArrow(add, FREQUENT)


def told_by(ids: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The slots of phrases that these parts (or one) tell of."""
    return mix(ids.view(np.uint64) + mix(parts.view(np.uint64))).view(np.int64)


class Once:
    """Tells the ids that a task hasn't shown yet; it may forget some, so that they are shown again."""

    def __init__(self):
        self.shown = np.zeros(0, dtype=np.int64)

    def new(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The new ids and where each stands first."""
        found, at = np.unique(ids, return_index=True)
        fresh = ~np.isin(found, self.shown, assume_unique=True)
        if len(self.shown) > MOST_COUNTS:
            self.shown = self.shown[:0]
        self.shown = np.union1d(self.shown, found[fresh])
        return found[fresh], at[fresh]


class Words:
    """The words of a block of texts: ids, which also tell languages apart, and positions."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        self.data, offsets = bytes_of(texts)
        self.starts, self.ends, first = word_spans(self.data, offsets, WORD_BYTES)
        self.sizes = np.diff(first)
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        lang_data, lang_at = bytes_of(langs)
        lang_ids = span_hashes(lang_data, lang_at[:-1], lang_at[1:])
        self.ids = mix(span_hashes(self.data, self.starts, self.ends, LOWER) + lang_ids[self.row] * _LANG).view(np.int64)

    def positions(self) -> np.ndarray:
        ended = np.cumsum(END_BYTES[self.data])[self.starts]
        apart = np.ones(len(self.starts), dtype=np.int64)
        apart[1:] += (ended[1:] != ended[:-1]) | (self.row[1:] != self.row[:-1])
        return np.cumsum(apart)

    def text(self, at: np.ndarray) -> pa.Array:
        lowered = [LOWER[self.data[s:e]].tobytes() for s, e in zip(self.starts[at].tolist(), self.ends[at].tolist())]
        return pa.array(lowered, pa.binary()).cast(pa.string())


def _blocks(batches):
    """``(langs, words)`` of blocks of whole texts."""
    for batch in batches:
        for low, high in batches_of(batch.column(1)):
            langs = batch.column(0).slice(low, high - low)
            words = Words(langs, batch.column(1).slice(low, high - low))
            if len(words.ids):
                yield langs, words


def word_counts(docs: DataFrame) -> DataFrame:
    """Partial counts of words."""
    bits = range_bits(docs.sparkSession)

    def count(batches):
        counts = Counts(bits)
        for _, words in _blocks(batches):
            yield from counts.add(words.ids)
        yield from counts.rest()

    return docs.select("lang", "text").mapInArrow(count, COUNTED)


def _batch(schema: pa.Schema, size: int, /, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)


def word_relation(docs: DataFrame, frequent: bytes) -> DataFrame:
    """The relation of frequent words in blocks, the text of each such word, and words per language."""
    schema = pa.schema([("block", pa.int64()), ("pos", pa.binary()), ("gram", pa.binary()), ("id", pa.int64()), ("word", pa.string()), ("lang", pa.string()), ("n", pa.int64())])

    def split(batches):
        bitmap, once, block = Bitmap(frequent), Once(), TaskContext.get().partitionId() << PART_BITS
        for langs, words in _blocks(batches):
            yield _batch(schema, len(langs), lang=langs, n=pa.array(words.sizes, pa.int64()))
            kept = np.flatnonzero(bitmap.has(words.ids))
            ids, at = once.new(words.ids[kept])
            yield _batch(schema, len(ids), id=pa.array(ids), word=words.text(kept[at]), lang=langs.take(pa.array(words.row[kept[at]])))
            yield _batch(schema, 1, block=pa.array([block]), pos=binary([_packed(words.positions()[kept])]), gram=binary([words.ids[kept].tobytes()]))
            block += 1

    return docs.select("lang", "text").mapInArrow(split, WORDS)


def part_of(block: int) -> int:
    return block >> PART_BITS


def _joined(batches):
    """Merge-join of each block with itself: ``(block, positions, longer phrases, first part, remaining part)``."""
    for batch in batches:
        for block, pos, gram in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            pos, gram = _unpacked(pos.as_py()), np.frombuffer(gram.as_py(), dtype=np.int64)
            next_to = np.flatnonzero(pos[1:] == pos[:-1] + 1)
            if len(next_to):
                first, rest = gram[next_to], gram[next_to + 1]
                yield block, pos[next_to], mix(first.view(np.uint64) * _LEFT + mix(rest.view(np.uint64)) * _RIGHT).view(np.int64), first, rest


def _longer(relation: DataFrame, keys) -> DataFrame:
    bits = range_bits(relation.sparkSession)

    def count(batches):
        counts = Counts(bits)
        for block, _, phrases, _, _ in _joined(batches):
            yield from counts.add(keys(phrases), part_of(block))
        yield from counts.rest()

    return relation.where("pos IS NOT NULL").select("block", "pos", "gram").mapInArrow(count, COUNTED)


def slot_counts(relation: DataFrame) -> DataFrame:
    """Partial counts of the slots of the phrases that are longer by one word: the low half of an id, as the high half."""
    return _longer(relation, lambda phrases: phrases << HALF)


def longer_counts(relation: DataFrame, likely: bytes | None = None) -> DataFrame:
    """Partial counts of the phrases that are longer by one word, or of those in the bitmap ``likely``."""
    return _longer(relation, lambda phrases: phrases if likely is None else phrases[Bitmap(likely).has(phrases)])


def longer_relation(relation: DataFrame, frequent: bytes, tellers: bytes) -> DataFrame:
    """The next relation in blocks, and the two parts ``(id, first, rest)`` of each phrase in it."""
    schema = pa.schema([("block", pa.int64()), ("pos", pa.binary()), ("gram", pa.binary()), ("id", pa.int64()), ("first", pa.int64()), ("rest", pa.int64())])

    def extend(batches):
        bitmap, told, once = Bitmap(frequent), Bitmap(tellers), Once()
        for block, pos, phrases, first, rest in _joined(batches):
            kept = np.flatnonzero(bitmap.has(phrases))
            if not len(kept):
                continue
            own = kept[told.has(told_by(phrases[kept], np.array([part_of(block)])))]
            ids, at = once.new(phrases[own])
            at = own[at]
            yield _batch(schema, len(ids), id=pa.array(ids), first=pa.array(first[at]), rest=pa.array(rest[at]))
            yield _batch(schema, 1, block=pa.array([block]), pos=binary([_packed(pos[kept])]), gram=binary([phrases[kept].tobytes()]))

    return relation.where("pos IS NOT NULL").select("block", "pos", "gram").mapInArrow(extend, LONGER)


def tellers(counted: DataFrame) -> DataFrame:
    """The slots ``id`` of ``told_by`` of all frequent phrases and their parts."""

    def slots(batches):
        for batch in batches:
            told = told_by(*(batch.column(i).to_numpy() for i in (0, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(told)], names=["id"])

    return counted.select("id", "part").mapInArrow(slots, "id BIGINT")


def frequent_bitmap(phrases: DataFrame) -> bytes:
    """A bit for every hash slot of an ``id``; at most MOST_SLOTS bits, put together from blocks."""
    slots, wanted = LEAST_SLOTS, min(SLOTS_PER_PHRASE * phrases.count(), MOST_SLOTS)
    while slots < wanted:
        slots *= 2

    def block(key, rows):
        bits = np.zeros(BLOCK_SLOTS, dtype=bool)
        bits[rows.column("slot").to_numpy() & (BLOCK_SLOTS - 1)] = True
        return pa.table({"block": [key[0].as_py()], "bits": binary([np.packbits(bits, bitorder="little").tobytes()])})

    slot = F.col("id").bitwiseAND(F.lit(slots - 1)).alias("slot")
    rows = phrases.select(slot).distinct().select((F.col("slot") / BLOCK_SLOTS).cast("bigint").alias("block"), "slot")
    bitmap = bytearray(slots // 8)
    for row in rows.groupBy("block").applyInArrow(block, "block BIGINT, bits BINARY").collect():
        at = row["block"] * BLOCK_SLOTS // 8
        bitmap[at : at + BLOCK_SLOTS // 8] = row["bits"]
    return bytes(bitmap)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """``(words per language, [phrases of length 1, 2, ...])``.

    Phrases are ``id, lang, phrase, last, a, heads, tails`` and, beyond one word, ``first`` and
    ``rest``: the ids without the last and without the first word. ``heads[j - 1]`` is the count of
    the first j words, ``tails[j - 1]`` that of the last j. Null texts are empty, and a null language
    is ``und``; every row counts, equal ones too. No texts give no phrases.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def frequent(partial):
        return stored(added_up(partial, least), "frequent")

    counted = frequent(word_counts(docs))
    relation = stored(word_relation(docs, frequent_bitmap(counted)), "words")
    totals = relation.where("n IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    told = relation.where("id IS NOT NULL").groupBy("id").agg(F.min("lang").alias("lang"), F.min("word").alias("phrase"))
    words = told.join(counted.select("id", "a"), "id")
    known = stored(words.select("id", "lang", "phrase", F.col("phrase").alias("last"), "a", F.array("a").alias("heads"), F.array("a").alias("tails")), "phrases")
    levels = [known]
    for length in range(2, longest + 1):
        slots = stored(added_up(slot_counts(relation), least).select(F.shiftrightunsigned("id", HALF).alias("id")), "slots")
        if slots.isEmpty():
            break
        counted = frequent(longer_counts(relation, frequent_bitmap(slots)))
        if counted.isEmpty():
            break
        relation = stored(longer_relation(relation, frequent_bitmap(counted), frequent_bitmap(tellers(counted))), f"phrases{length}")
        parts = relation.where("id IS NOT NULL").select("id", "first", "rest").dropDuplicates(["id"]).join(counted.select("id", "a"), "id")
        head = known.select(F.col("id").alias("first"), "lang", F.col("phrase").alias("head"), "heads")
        tail = known.select(F.col("id").alias("rest"), "last", "tails")
        whole = parts.join(head, "first").join(tail, "rest")
        known = stored(
            whole.select(
                "id", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "a", F.concat("heads", F.array("a")).alias("heads"),
                F.concat("tails", F.array("a")).alias("tails"), "first", "rest",
            ),
            "phrases",
        )
        levels.append(known)
    return totals, levels


def lowest_cut(length: int) -> F.Column:
    """The cut of a phrase of ``length`` words that scores lowest: ``(score, cut, l, r)``.

    Products of three or two counts need up to 38 digits, so they are decimals.
    """
    def wide(column):
        return column.cast("decimal(19,0)")

    cuts = []
    for k in range(1, length):
        left, right = F.get("heads", F.lit(k - 1)), F.get("tails", F.lit(length - k - 1))
        above = (F.lit(1000).cast("decimal(4,0)") * wide(F.col("a"))).cast("decimal(19,0)") * wide(F.col("n"))
        score = F.call_function("div", above, wide(left) * wide(right))
        cuts.append(F.struct(score.cast("bigint").alias("score"), F.lit(k).alias("cut"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of each language.

    A phrase is left out if a phrase that is longer by one word holds it and is as frequent. A longer
    one that is as frequent has such phrases in between, so this covers every length. Ties go by
    count, then by the bytes of the phrase. Very long texts are one block of their own; other columns
    of the table play no part.
    """
    totals, levels = frequent_phrases(docs, least, longest)
    candidates = None
    for k in range(2, len(levels) + 1):
        rows = levels[k - 1]
        if k < len(levels):
            holding = levels[k].select(F.explode(F.array("first", "rest")).alias("id"), F.col("a").alias("held")).groupBy("id").agg(F.max("held").alias("held"))
            rows = rows.join(holding, "id", "left").where("held IS NULL OR held < a")
        scored = rows.join(totals, "lang").select("lang", "phrase", "a", "n", lowest_cut(k).alias("cut"))
        candidates = scored if candidates is None else candidates.unionByName(scored)
    if candidates is None:
        none = levels[0].where("false")
        zero = F.lit(0).cast("bigint")
        candidates = none.select("lang", "phrase", "a", zero.alias("n"), F.struct(zero.alias("score"), zero.alias("l"), zero.alias("r")).alias("cut"))
    rows = candidates.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # A language may hold most phrases: the best of each part first, then the best of those.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    best = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = best.where(F.col("rank") <= top).drop("rank", "part")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


# Lengths are counted by plain grouping of word lists; parts of a phrase are looked up by their text.
ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
grams AS (
    SELECT lang, k, w[i : i + k - 1] AS g, count(*) AS a
    FROM lists, range(1, 6) AS lengths(k), unnest(range(1, len(w) - k + 2)) AS places(i)
    GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
    SELECT c.lang, c.g, c.a, j, h.a AS l, t.a AS r, t2.n, 1000 * c.a::HUGEINT * t2.n // (h.a::HUGEINT * t.a) AS score
    FROM grams c, unnest(range(1, c.k)) AS cut(j)
    JOIN grams h ON h.lang = c.lang AND h.k = j AND h.g = c.g[1 : j]
    JOIN grams t ON t.lang = c.lang AND t.k = c.k - j AND t.g = c.g[j + 1 :]
    JOIN totals t2 ON t2.lang = c.lang),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
inner_parts AS (
    SELECT lang, g[i : i + m - 1] AS g, max(a) AS held
    FROM grams, unnest(range(2, k)) AS sizes(m), unnest(range(1, k - m + 2)) AS spots(i) GROUP BY ALL),
ranked AS (
    SELECT lowest.*, array_to_string(lowest.g, ' ') AS phrase FROM lowest LEFT JOIN inner_parts p ON p.lang = lowest.lang AND p.g = lowest.g
    WHERE held IS NULL OR held < a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked QUALIFY rank <= 2000
"""
